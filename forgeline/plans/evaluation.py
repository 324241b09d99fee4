"""Evaluation queries over scored labels.

Input: ``labels`` joined to ``documents``; y = quality, score =
n_chars / (n_chars + 1000) -- a fixed monotone score, so every metric is
deterministic and checkable."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluation as ev
from ..operators.sequences import decide
from . import fixed as fx
from . import views as v
from .registry import r6, register

SQL = v.with_sql(v.SCORED_SQL)
METRICS_SQL = """
SELECT CAST(SUM(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
       CAST(SUM(CASE WHEN y <> 1 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
       CAST(SUM(CASE WHEN y = 1 AND p <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
       CAST(SUM(CASE WHEN y <> 1 AND p <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn
FROM {src}"""


def _rates(prefix: str = "") -> str:
    return f"""
SELECT {prefix}tp, fp, fn, tn,
       ROUND(CASE WHEN tp + fp + fn + tn = 0 THEN 0.0 ELSE CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) END, 6) AS accuracy,
       ROUND(CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END, 6) AS precision,
       ROUND(CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END, 6) AS recall,
       ROUND(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END, 6) AS f1
FROM counts"""


def scored(spark, sf_dir):
    return v.scored_labels(spark, sf_dir)


def _round_metrics(df):
    return df.select(*[r6(c).alias(c) if c in ("accuracy", "precision", "recall", "f1") else F.col(c)
                       for c in df.columns])


@register("q_confusion", SQL + """
, pr AS (SELECT y, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred FROM scored),
grid AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(y, pred)),
c AS (SELECT y, pred, COUNT(*) AS count FROM pr GROUP BY y, pred)
SELECT g.y, g.pred, coalesce(c.count, 0) AS count FROM grid g LEFT JOIN c ON g.y = c.y AND g.pred = c.pred""")
def q_confusion(spark, sf_dir):
    """H1 at threshold 0.5 (G3: score >= threshold)."""
    return ev.confusion(decide(scored(spark, sf_dir), "score", fx.DECISION_THRESHOLD), "y", "pred")


@register("q_metrics", SQL + ", p AS (SELECT y, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS p FROM scored),"
          " counts AS (" + METRICS_SQL.format(src="p") + ")" + _rates())
def q_metrics(spark, sf_dir):
    """H2: accuracy, precision, recall, F1 (zero division -> 0)."""
    return _round_metrics(ev.classification_metrics(decide(scored(spark, sf_dir), "score", fx.DECISION_THRESHOLD),
                                                    "y", "pred"))


@register("q_roc_auc", SQL + """
, st AS (SELECT score, SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, SUM(CASE WHEN y <> 1 THEN 1 ELSE 0 END) AS neg
         FROM scored GROUP BY score),
cum AS (SELECT *, coalesce(SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM st)
SELECT ROUND(CASE WHEN SUM(pos) > 0 AND SUM(neg) > 0 THEN
             SUM(pos * below + pos * neg * 0.5) / (CAST(SUM(pos) AS DOUBLE) * SUM(neg)) END, 6) AS auc FROM cum""")
def q_roc_auc(spark, sf_dir):
    """H3: exact ROC-AUC with ties counted one half."""
    return ev.roc_auc(scored(spark, sf_dir), "y", "score").select(r6("auc").alias("auc"))


_CUM_DESC = """
, st AS (SELECT score, SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, SUM(CASE WHEN y <> 1 THEN 1 ELSE 0 END) AS neg
         FROM scored GROUP BY score),
tot AS (SELECT SUM(pos) AS P, SUM(neg) AS N FROM st),
cum AS (SELECT score, SUM(pos) OVER (ORDER BY score DESC) AS tp, SUM(neg) OVER (ORDER BY score DESC) AS fp FROM st)"""


@register("q_roc_curve", SQL + _CUM_DESC + """
SELECT CAST('Infinity' AS DOUBLE) AS threshold, CAST(0.0 AS DOUBLE) AS fpr, CAST(0.0 AS DOUBLE) AS tpr
UNION ALL
SELECT score, ROUND(CASE WHEN N = 0 THEN 0.0 ELSE CAST(fp AS DOUBLE) / N END, 6),
       ROUND(CASE WHEN P = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / P END, 6) FROM cum, tot""")
def q_roc_curve(spark, sf_dir):
    """H4: ROC points at every distinct score (descending) plus the origin."""
    rc = ev.roc_curve(scored(spark, sf_dir), "y", "score")
    return rc.select("threshold", r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


@register("q_pr_curve", SQL + _CUM_DESC + """
SELECT score AS threshold, ROUND(CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END, 6) AS precision,
       ROUND(CASE WHEN P = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / P END, 6) AS recall FROM cum, tot
UNION ALL SELECT NULL, 1.0, 0.0""")
def q_pr_curve(spark, sf_dir):
    """H5: precision/recall at every distinct score plus the (1, 0) end point."""
    pc = ev.pr_curve(scored(spark, sf_dir), "y", "score")
    return pc.select("threshold", r6("precision").alias("precision"), r6("recall").alias("recall"))


@register("q_best_f1", SQL + _CUM_DESC + """
, pr AS (SELECT score, CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS p,
                CASE WHEN P = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / P END AS r FROM cum, tot),
f AS (SELECT score, 2.0 * p * r / (p + r + 1e-8) AS f1 FROM pr)
SELECT ROUND(MIN(score) FILTER (WHERE f1 = (SELECT MAX(f1) FROM f)), 6) AS threshold,
       ROUND(MAX(f1), 6) AS f1 FROM f""")
def q_best_f1(spark, sf_dir):
    """H6: the F1-maximising threshold (lowest on ties)."""
    b = ev.best_f1_threshold(scored(spark, sf_dir), "y", "score", eps=fx.F1_EPSILON)
    return b.select(r6("threshold").alias("threshold"), r6("f1").alias("f1"))


@register("q_sweep", SQL + """
, g AS (SELECT CAST(i AS INTEGER) AS i,
               CASE WHEN i = 99 THEN CAST(1.0 AS DOUBLE) ELSE i * (CAST(1.0 AS DOUBLE) / 99) + CAST(0.0 AS DOUBLE) END
               AS threshold FROM range(100) t(i)),
c AS (SELECT g.i, g.threshold,
             SUM(CASE WHEN s.y = 1 AND s.score > g.threshold THEN 1 ELSE 0 END) AS tp,
             SUM(CASE WHEN s.y <> 1 AND s.score > g.threshold THEN 1 ELSE 0 END) AS fp,
             SUM(CASE WHEN s.y = 1 THEN 1 ELSE 0 END) AS P
      FROM g, scored s GROUP BY g.i, g.threshold),
m AS (SELECT i, threshold, CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
             CASE WHEN P = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / P END AS recall FROM c),
mg AS (SELECT *, abs(precision - recall) AS gap FROM m)
SELECT i, ROUND(threshold, 6) AS threshold, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall,
       ROUND(gap, 6) AS gap, i = (SELECT i FROM mg ORDER BY gap, i LIMIT 1) AS chosen,
       i = (SELECT i FROM mg ORDER BY gap, i LIMIT 1) AND recall = 0 AND precision = 0 AS degenerate FROM mg""")
def q_sweep(spark, sf_dir):
    """H7: 100-point threshold grid on [0, 1], strict >, first minimum of |P - R|."""
    s = ev.sweep_thresholds(scored(spark, sf_dir), "y", "score", 0.0, 1.0, 100)
    return s.select("i", *[r6(c).alias(c) for c in ("threshold", "precision", "recall", "gap")], "chosen",
                    "degenerate")


@register("q_errors_by_class", SQL + """
, b AS (SELECT MIN(score) AS lo, MAX(score) AS hi FROM scored),
w AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / 50 ELSE 1.0 END AS width FROM b)
SELECT y, CAST(least(floor((score - lo) / width), 49) AS INTEGER) AS bin, COUNT(*) AS count
FROM scored, w WHERE score IS NOT NULL GROUP BY ALL""")
def q_errors_by_class(spark, sf_dir):
    """H8: score distribution split by class (shared 50-bin edges)."""
    h = ev.errors_by_class(scored(spark, sf_dir), "y", "score", bins=50)
    return h.select("y", "bin", "count")


@register("q_errors_by_class_own", SQL + """
, w AS (SELECT y, MIN(score) AS lo, CASE WHEN MAX(score) > MIN(score) THEN (MAX(score) - MIN(score)) / 50 ELSE 1.0 END AS width
        FROM scored WHERE score IS NOT NULL GROUP BY y),
h AS (SELECT w.y, CAST(least(floor((score - lo) / width), 49) AS INTEGER) AS bin, COUNT(*) AS count, lo, width
      FROM scored s JOIN w ON s.y IS NOT DISTINCT FROM w.y WHERE score IS NOT NULL GROUP BY ALL)
SELECT y, bin, count, ROUND(lo + bin * width, 6) AS lo, ROUND(lo + (bin + 1) * width, 6) AS hi FROM h""")
def q_errors_by_class_own(spark, sf_dir):
    """H8: score distribution by class, 50 bins from each class's least to largest score."""
    h = ev.errors_by_class(scored(spark, sf_dir), "y", "score", bins=50, own_edges=True)
    return h.select("y", "bin", "count", r6("lo").alias("lo"), r6("hi").alias("hi"))


@register("q_compare", SQL + _CUM_DESC + """
, pr AS (SELECT score, CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS p,
                CASE WHEN P = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / P END AS r FROM cum, tot),
f AS (SELECT score, 2.0 * p * r / (p + r + 1e-8) AS f1 FROM pr),
best AS (SELECT MIN(score) FILTER (WHERE f1 = (SELECT MAX(f1) FROM f)) AS thr FROM f),
runs AS (
  SELECT 'baseline' AS run, y, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS p FROM scored
  UNION ALL SELECT 'improved', y, CASE WHEN score >= (SELECT thr FROM best) THEN 1 ELSE 0 END FROM scored),
cnt AS (SELECT run, SUM(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END) AS tp,
               SUM(CASE WHEN y <> 1 AND p = 1 THEN 1 ELSE 0 END) AS fp,
               SUM(CASE WHEN y = 1 AND p <> 1 THEN 1 ELSE 0 END) AS fn,
               SUM(CASE WHEN y <> 1 AND p <> 1 THEN 1 ELSE 0 END) AS tn FROM runs GROUP BY run),
met AS (SELECT run,
          CASE WHEN tp + fp + fn + tn = 0 THEN 0.0 ELSE CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) END AS accuracy,
          CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
          CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
          CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1
        FROM cnt),
lng AS (UNPIVOT met ON accuracy, precision, recall, f1 INTO NAME metric VALUE val)
SELECT a.metric, ROUND(a.val, 6) AS baseline, ROUND(b.val, 6) AS improved, ROUND(b.val - a.val, 6) AS delta,
       CASE WHEN a.metric = 'f1' THEN b.val >= 0.70 END AS goal_met
FROM lng a JOIN lng b ON a.metric = b.metric AND a.run = 'baseline' AND b.run = 'improved'""")
def q_compare(spark, sf_dir):
    """H9: baseline (0.5) vs improved (best-F1 threshold) metric table."""
    sc = scored(spark, sf_dir)
    thr = ev.best_f1_threshold(sc, "y", "score").first()["threshold"]
    cols = ["accuracy", "precision", "recall", "f1"]
    a = ev.classification_metrics(decide(sc, "score", 0.5), "y", "pred").select(*cols)
    b = ev.classification_metrics(decide(sc, "score", thr), "y", "pred").select(*cols)
    c = ev.compare_runs(a, b)
    return c.select("metric", *[r6(x).alias(x) for x in ("baseline", "improved", "delta")], "goal_met")


@register("q_log_loss", """
WITH z AS (SELECT l.quality AS y, (d.n_chars - CAST(1000.0 AS DOUBLE)) / CAST(500.0 AS DOUBLE) AS z
           FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
SELECT ROUND(AVG(greatest(z, 0.0) + ln(1 + exp(-abs(z))) - y * z), 6) AS log_loss,
       ROUND(AVG(pow(1.0 / (1.0 + exp(-z)) - y, 2)), 6) AS mse FROM z""")
def q_log_loss(spark, sf_dir):
    """Mean binary cross-entropy of a fixed logit and the MSE of its sigmoid."""
    lab = v.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y"))
    doc = v.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    z = lab.join(doc, "doc_id").select("y", ((F.col("n_chars") - F.lit(1000.0)) / F.lit(500.0)).alias("z"))
    ll = ev.log_loss(z, "y", "z")
    return ll.select(r6("log_loss").alias("log_loss"), r6("mse").alias("mse"))


@register("q_holdout_threshold", SQL + """
, rk AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5(CAST(doc_id AS VARCHAR) || '42')) AS r,
                COUNT(*) OVER (PARTITION BY y) AS n FROM scored),
sp AS (SELECT *, CASE WHEN r <= (n * 50 + 99) // 100 THEN 'test' ELSE 'valid' END AS part FROM rk),
st AS (SELECT score, SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, SUM(CASE WHEN y <> 1 THEN 1 ELSE 0 END) AS neg
       FROM sp WHERE part = 'valid' GROUP BY score),
tot AS (SELECT SUM(pos) AS P FROM st),
cum AS (SELECT score, SUM(pos) OVER (ORDER BY score DESC) AS tp, SUM(neg) OVER (ORDER BY score DESC) AS fp FROM st),
f AS (SELECT score, 2.0 * p * r / (p + r + 1e-8) AS f1 FROM (
        SELECT score, CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS p,
               CASE WHEN P = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / P END AS r FROM cum, tot)),
best AS (SELECT MIN(score) FILTER (WHERE f1 = (SELECT MAX(f1) FROM f)) AS thr FROM f),
p AS (SELECT y, CASE WHEN score >= (SELECT thr FROM best) THEN 1 ELSE 0 END AS p FROM sp WHERE part = 'test'),
counts AS (""" + METRICS_SQL.format(src="p") + ")" + _rates("ROUND((SELECT thr FROM best), 6) AS threshold, "))
def q_holdout_threshold(spark, sf_dir):
    """H6 without threshold leakage: stratified 50/50 hash split, best-F1
    threshold fitted on the validation half, metrics (H2) on the test half."""
    from ..operators import features as fe
    sp = fe.stratified_split(scored(spark, sf_dir), "y", "doc_id", test_percent=50, seed=fx.SEED)
    thr = ev.best_f1_threshold(sp.where(F.col("split") == "train"), "y", "score", eps=fx.F1_EPSILON).first()["threshold"]
    m = ev.classification_metrics(decide(sp.where(F.col("split") == "test"), "score", thr), "y", "pred")
    return _round_metrics(m).select(F.round(F.lit(thr), 6).alias("threshold"), "*")

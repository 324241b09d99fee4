"""Exact binary-classification evaluation (H1-H9).

Every curve is computed from a table aggregated by distinct score
(score, positives, negatives).  Running totals over that table use the
range-partitioned prefix sums of ``functions.ordinals.running_totals``, so
neither raw rows nor the score table ever pass through a single task.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.joins import join_on_keys
from ..functions.metadata import CLASS_LIMIT, collect_bounded
from ..functions.ordinals import running_totals


def _ratio(num: Column, den: Column) -> Column:
    """Zero-division -> 0."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den)


def confusion(df: DataFrame, y: str, pred: str) -> DataFrame:
    """H1: all four cells (y, pred, count), zero cells included."""
    counts = df.groupBy(F.col(y).cast("int").alias("y"), F.col(pred).cast("int").alias("pred")).agg(
        F.count("*").alias("count"))
    grid = df.sparkSession.createDataFrame([(a, b) for a in (0, 1) for b in (0, 1)], "y int, pred int")
    return grid.join(counts, ["y", "pred"], "left").fillna(0, subset=["count"])


def metrics_from_counts(tp: Column, fp: Column, fn: Column, tn: Column) -> list[Column]:
    n = tp + fp + fn + tn
    prec = _ratio(tp, tp + fp)
    rec = _ratio(tp, tp + fn)
    return [_ratio(tp + tn, n).alias("accuracy"), prec.alias("precision"), rec.alias("recall"),
            _ratio(2 * tp, 2 * tp + fp + fn).alias("f1")]


def classification_metrics(df: DataFrame, y: str, pred: str) -> DataFrame:
    """H2: one row tp, fp, fn, tn, accuracy, precision, recall, f1."""
    yy, pp = F.col(y) == 1, F.col(pred) == 1
    c = df.agg(F.sum((yy & pp).cast("long")).alias("tp"), F.sum((~yy & pp).cast("long")).alias("fp"),
               F.sum((yy & ~pp).cast("long")).alias("fn"), F.sum((~yy & ~pp).cast("long")).alias("tn"))
    c = c.fillna(0)
    return c.select("tp", "fp", "fn", "tn", *metrics_from_counts(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")))


def score_table(df: DataFrame, y: str, score: str) -> DataFrame:
    """(score, pos, neg) per distinct score; partial aggregation map-side."""
    return (df.where(F.col(score).isNotNull())
            .groupBy(F.col(score).cast("double").alias("score"))
            .agg(F.sum((F.col(y) == 1).cast("long")).alias("pos"),
                 F.sum((F.col(y) != 1).cast("long")).alias("neg")))


def _totals(cum: DataFrame) -> tuple[int, int]:
    """(positives, negatives) of the cumulative table: a one-row action on the
    distinct scores, not on the source."""
    r = cum.agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("p"), F.coalesce(F.sum("neg"), F.lit(0)).alias("n")).first()
    return int(r["p"]), int(r["n"])


def _cumulative_desc(df: DataFrame, y: str, score: str) -> DataFrame:
    """Per distinct score: tp/fp = positives/negatives with score >= s."""
    st = score_table(df, y, score)
    cum = running_totals(st, [F.col("score").desc()], ["pos", "neg"])
    return cum.withColumnRenamed("cum_pos", "tp").withColumnRenamed("cum_neg", "fp")


def roc_auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """H3: exact ROC-AUC, ties counted one half (trapezoid over distinct
    scores).  Needs P > 0 and N > 0, else NULL."""
    st = score_table(df, y, score)
    cum = running_totals(st, [F.col("score").asc()], ["neg"])  # negatives with score <= s
    return auc_of_table(cum)


def auc_of_table(cum: DataFrame) -> DataFrame:
    """AUC of a (pos, neg, cum_neg) table by ascending score.  Products are taken
    in double: counts of billions would overflow a LONG."""
    pos, neg, upto = (F.col(c).cast("double") for c in ("pos", "neg", "cum_neg"))
    contrib = pos * (upto - neg) + pos * neg * F.lit(0.5)
    tot = cum.agg(F.sum(contrib).alias("u"), F.sum(pos).alias("p"), F.sum(neg).alias("n"))
    return tot.select(F.when((F.col("p") > 0) & (F.col("n") > 0),
                             F.col("u") / (F.col("p") * F.col("n"))).alias("auc"))


def roc_curve(df: DataFrame, y: str, score: str) -> DataFrame:
    """H4: (threshold, fpr, tpr) at every distinct score, descending, plus
    the starting point (threshold +inf, 0, 0)."""
    cum = _cumulative_desc(df, y, score)
    P, N = _totals(cum)
    pts = cum.select(F.col("score").alias("threshold"), _ratio(F.col("fp"), F.lit(N)).alias("fpr"),
                     _ratio(F.col("tp"), F.lit(P)).alias("tpr"))
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return start.unionByName(pts)


def pr_curve(df: DataFrame, y: str, score: str) -> DataFrame:
    """H5: (threshold, precision, recall) with ``score >= threshold`` at every
    distinct score, plus the final point (NULL, 1, 0)."""
    cum = _cumulative_desc(df, y, score)
    P, _n = _totals(cum)
    pts = cum.select(F.col("score").alias("threshold"),
                     _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                     (F.lit(1.0) if P == 0 else F.col("tp") / F.lit(float(P))).alias("recall"))
    end = df.sparkSession.createDataFrame([(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return pts.unionByName(end)


def best_f1_threshold(df: DataFrame, y: str, score: str, eps: float = 1e-8) -> DataFrame:
    """H6: threshold maximising 2pr/(p+r+eps); the lowest threshold wins ties.
    ``max_by`` is an aggregation, so no ordering of the curve is needed."""
    pr = pr_curve(df, y, score).where(F.col("threshold").isNotNull())
    f1 = (F.lit(2.0) * F.col("precision") * F.col("recall")) / (F.col("precision") + F.col("recall") + F.lit(eps))
    scored = pr.withColumn("f1", f1)
    return scored.agg(F.max_by("threshold", F.struct("f1", -F.col("threshold"))).alias("threshold"),
                      F.max("f1").alias("f1"))


def grid_points(lo: float, hi: float, n: int) -> list[float]:
    """linspace(lo, hi, n): i * step + lo, the last point exactly hi."""
    step = (hi - lo) / (n - 1) if n > 1 else 0.0
    pts = [i * step + lo for i in range(n)]
    if n > 1:
        pts[-1] = hi
    return pts


def sweep_thresholds(df: DataFrame, y: str, score: str, lo: float, hi: float, n: int = 100) -> DataFrame:
    """H7: thresholds linspace(lo, hi, n); prediction ``score > t``; the
    chosen threshold is the first (lowest) minimum of |precision - recall|.

    One pass, not n: every distinct score is mapped to the number of grid
    points strictly below it (an exact comparison against the n literals),
    so the counts collapse to at most n + 1 cells before any ordering."""
    spark = df.sparkSession
    pts = grid_points(lo, hi, n)
    arr = F.array(*[F.lit(float(t)) for t in pts])
    st = score_table(df, y, score)
    cells = (st.select(F.size(F.filter(arr, lambda t: t < F.col("score"))).alias("cell"), "pos", "neg")
             .groupBy("cell").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    grid = spark.createDataFrame([(i, float(t)) for i, t in enumerate(pts)], "i int, threshold double")
    # positives predicted at grid point i = scores in cells > i; window over <= n + 1 rows
    all_cells = spark.range(n + 1).select(F.col("id").cast("int").alias("cell")).join(cells, "cell", "left").fillna(0)
    w = Window.orderBy(F.col("cell").desc()).rowsBetween(Window.unboundedPreceding, -1)
    acc = all_cells.select(F.col("cell").alias("i"),
                           F.coalesce(F.sum("pos").over(w), F.lit(0)).alias("tp"),
                           F.coalesce(F.sum("neg").over(w), F.lit(0)).alias("fp"),
                           F.sum("pos").over(Window.partitionBy()).alias("P"))
    res = (grid.join(acc, "i")
           .select("i", "threshold", _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                   _ratio(F.col("tp"), F.col("P")).alias("recall")))
    res = res.withColumn("gap", F.abs(F.col("precision") - F.col("recall")))
    best = Window.partitionBy()  # over the n grid rows only
    # a first minimum where precision = recall = 0 is kept (parity) but flagged
    return (res.withColumn("_best", F.min_by("i", F.struct("gap", "i")).over(best))
            .withColumn("chosen", F.col("i") == F.col("_best"))
            .withColumn("degenerate", F.col("chosen") & (F.col("recall") == 0.0) & (F.col("precision") == 0.0))
            .drop("_best"))


def errors_by_class(df: DataFrame, y: str, error: str, bins: int = 50, own_edges: bool = False) -> DataFrame:
    """H8: error distribution per class as a histogram (y, bin, count, lo, hi).

    All classes share the edges, or each has its own, from its least to its largest
    error.  A class without errors has no bins; NULL is a class."""
    from .profiling import histogram
    if not own_edges:
        return histogram(df, error, bins=bins, by=y)
    there = df.where(F.col(error).isNotNull())
    ends = collect_bounded(there.groupBy(y).agg(F.min(error).alias("_lo"), F.max(error).alias("_hi")), CLASS_LIMIT, f"classes of {y}")
    schema = T.StructType([df.schema[y], T.StructField("_lo", T.DoubleType()), T.StructField("_width", T.DoubleType())])
    edges = df.sparkSession.createDataFrame(
        [(r[y], float(r["_lo"]), (r["_hi"] - r["_lo"]) / bins if r["_hi"] > r["_lo"] else 1.0) for r in ends], schema)
    placed = join_on_keys(there.select(y, error), edges, [y], broadcast_right=True)  # one row per class
    at = F.least(F.floor((F.col(error) - F.col("_lo")) / F.col("_width")), F.lit(bins - 1)).cast("int")
    return (placed.groupBy(y, at.alias("bin"), "_lo", "_width").agg(F.count("*").alias("count"))
            .select(y, "bin", "count", (F.col("_lo") + F.col("bin") * F.col("_width")).alias("lo"),
                    (F.col("_lo") + (F.col("bin") + 1) * F.col("_width")).alias("hi")))


def compare_runs(a: DataFrame, b: DataFrame, names: Sequence[str] = ("baseline", "improved"),
                 goal_metric: str = "f1", goal: float = 0.70) -> DataFrame:
    """H9: metric table (metric, a, b, delta, goal_met) from two one-row
    metric frames with the same columns."""
    metrics = [c for c in a.columns if c in b.columns]
    la = a.unpivot([], metrics, "metric", names[0])
    lb = b.unpivot([], metrics, "metric", names[1])
    out = la.join(lb, "metric").withColumn("delta", F.col(names[1]) - F.col(names[0]))
    return out.withColumn("goal_met", F.when(F.col("metric") == goal_metric, F.col(names[1]) >= goal))


def log_loss(df: DataFrame, y: str, logit: str) -> DataFrame:
    """Mean binary cross-entropy from logits, and the MSE of the probability."""
    from ..functions.exprs import sigmoid, softplus
    z = F.col(logit)
    return df.agg(F.avg(softplus(z) - F.col(y) * z).alias("log_loss"),
                  F.avg(F.pow(sigmoid(z) - F.col(y), 2)).alias("mse"))

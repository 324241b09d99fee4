"""Profiling queries over the driver tables: value counts, class ratio,
flag totals, column profile, correlation, histogram and density
(D9-D15)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profiling as pr
from . import views as v
from .registry import r6, register


@register("q_value_counts", """
SELECT event_type, COUNT(*) AS count FROM events GROUP BY event_type""")
def q_value_counts(spark, sf_dir):
    """D9 on the event type."""
    return pr.value_counts(v.table(spark, sf_dir, "events"), "event_type")


@register("q_class_ratio", """
SELECT quality, COUNT(*) AS count, ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 6) AS percent
FROM labels GROUP BY quality""")
def q_class_ratio(spark, sf_dir):
    """D9 + D10: class counts and percentages of the quality label."""
    cr = pr.class_ratio(v.table(spark, sf_dir, "labels"), "quality")
    return cr.select("quality", "count", r6("percent").alias("percent"))


@register("q_flag_totals", """
SELECT 'quality' AS flag, CAST(SUM(quality) AS BIGINT) AS total FROM labels
UNION ALL SELECT 'toxic', CAST(SUM(toxic) AS BIGINT) FROM labels""")
def q_flag_totals(spark, sf_dir):
    """Totals of the 0/1 flag columns."""
    return pr.flag_totals(v.table(spark, sf_dir, "labels"), ["quality", "toxic"])


PROFILE_COLS = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"}


def _profile_sql(c: str, dtype: str) -> str:
    numeric = dtype in ("bigint", "double")
    ends = [(f"CAST({f}({c}) AS DOUBLE) AS {f.lower()}" if numeric else f"CAST(NULL AS DOUBLE) AS {f.lower()}") for f in ("MIN", "MAX")]
    texts = [(f"CAST(NULL AS VARCHAR) AS {f.lower()}_text" if numeric else f"CAST({f}({c}) AS VARCHAR) AS {f.lower()}_text") for f in ("MIN", "MAX")]
    return f"SELECT '{c}' AS \"column\", '{dtype}' AS dtype, COUNT(*) AS n_rows, COUNT({c}) AS non_null, {', '.join(ends + texts)} FROM events"


@register("q_profile", "\nUNION ALL\n".join(_profile_sql(c, t) for c, t in PROFILE_COLS.items()))
def q_profile(spark, sf_dir):
    """Dtype, row count, non-NULL count, min and max of every column."""
    return pr.profile(v.table(spark, sf_dir, "events"), list(PROFILE_COLS))


@register("q_sample_rows", """
SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id LIMIT 5""")
def q_sample_rows(spark, sf_dir):
    """D12 sample: the first five events by id (the limit is the feature)."""
    ev = v.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return pr.sample_rows(ev.orderBy("event_id"), 5)


CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("q_correlation", "\nUNION ALL\n".join(
    (f"SELECT '{a}' AS col_a, '{b}' AS col_b, CAST(1.0 AS DOUBLE) AS corr" if a == b else
     f"SELECT '{a}' AS col_a, '{b}' AS col_b, ROUND(corr({a}, {b}), 6) AS corr FROM lineitem")
    for a in CORR_COLS for b in CORR_COLS))
def q_correlation(spark, sf_dir):
    """Pearson correlation matrix (long form) of four line measures."""
    c = pr.correlation_matrix(v.table(spark, sf_dir, "lineitem"), CORR_COLS)
    return c.select("col_a", "col_b", r6("corr").alias("corr"))


@register("q_correlation_wide", f"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings),
r AS (SELECT vec_id, unnest([{", ".join(v.wide_column(j, "x[{}+1]") for j in range(v.WIDE_COLUMNS))}]) AS v, unnest(range({v.WIDE_COLUMNS})) AS j FROM e),
l AS (SELECT vec_id, j, v FROM r WHERE (vec_id + j) % 29 <> 0)
SELECT 'c' || a.j AS col_a, 'c' || b.j AS col_b, ROUND(corr(a.v, b.v), 6) AS corr FROM l a JOIN l b ON a.vec_id = b.vec_id AND a.j < b.j GROUP BY a.j, b.j""")
def q_correlation_wide(spark, sf_dir):
    """D13 at sensor-table width: 512 columns with missing cells, every pair once."""
    emb = v.table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    cells = [F.expr(f"CASE WHEN (vec_id + {j}) % 29 <> 0 THEN {v.wide_column(j, 'x[{}]')} END").alias(f"c{j}") for j in range(v.WIDE_COLUMNS)]
    c = pr.correlation_matrix(emb.select(*cells), [f"c{j}" for j in range(v.WIDE_COLUMNS)])
    place = lambda name: F.substring(name, 2, 9).cast("int")
    return c.where(place("col_a") < place("col_b")).select("col_a", "col_b", r6("corr").alias("corr"))


@register("q_histogram", """
WITH b AS (SELECT MIN(value) AS lo, MAX(value) AS hi FROM events),
w AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / 50 ELSE 1.0 END AS width FROM b),
h AS (SELECT event_type, CAST(least(floor((value - lo) / width), 49) AS INTEGER) AS bin, COUNT(*) AS count
      FROM events, w WHERE value IS NOT NULL GROUP BY ALL)
SELECT event_type, bin, count, ROUND(lo + bin * width, 6) AS lo, ROUND(lo + (bin + 1) * width, 6) AS hi,
       ROUND(count / (SUM(count) OVER (PARTITION BY event_type) * width), 9) AS density
FROM h, w""")
def q_histogram(spark, sf_dir):
    """50 equal-width bins of the event value per event type, with density."""
    h = pr.histogram(v.table(spark, sf_dir, "events"), "value", bins=50, by="event_type", density=True)
    return h.select("event_type", "bin", "count", r6("lo").alias("lo"), r6("hi").alias("hi"),
                    F.round("density", 9).alias("density"))


@register("q_density", """
WITH s AS (SELECT COUNT(value) AS n, stddev_samp(value) AS sd, MIN(value) AS lo, MAX(value) AS hi FROM events),
p AS (SELECT n, lo, hi, sd * pow(n, -1.0 / 5.0) AS bw, (hi - lo) / 99 AS step FROM s),
g AS (SELECT CAST(i AS INTEGER) AS i, CASE WHEN i = 99 THEN hi ELSE i * step + lo END AS x, bw, n
      FROM p, range(100) t(i)),
vals AS (SELECT value AS v, COUNT(*) AS w FROM events WHERE value IS NOT NULL GROUP BY value)
SELECT g.i, ROUND(g.x, 6) AS x,
       ROUND(SUM(w * exp(-0.5 * pow((g.x - v) / g.bw, 2))) / (any_value(g.n) * any_value(g.bw) * sqrt(2 * pi())), 9)
         AS density
FROM g, vals GROUP BY g.i, g.x""")
def q_density(spark, sf_dir):
    """Exact Gaussian KDE of the event value on a 100-point grid."""
    d = pr.density_curve(v.table(spark, sf_dir, "events"), "value", points=100)
    return d.select("i", r6("x").alias("x"), F.round("density", 9).alias("density"))

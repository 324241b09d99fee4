"""Wide sensor table queries: missing rates, sparse rows, median fill, Inf
repair, constant columns, IQR fences / outliers / clipping, label domain and
the MDQI score (B7, B8, B15-B17, D4-D8, E1-E7).

Spark side: one ``WideCascade`` per query over the dirtied ``lineitem``
view.  Oracle side: the same cascade in SQL, where "column dropped" is a
boolean flag per column computed from the data, so no decision is hard-coded.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.quantiles import unpivot
from ..operators import outliers as ou
from ..operators import profiling as pr
from ..operators.cleansing import clip_columns
from ..operators.quality import WideCascade
from . import fixed as fx
from . import views as v
from .registry import r6, register

S = v.WIDE_SENSORS


def cascade(spark, sf_dir) -> WideCascade:
    order = [F.abs(F.col("row_id")), -F.col("row_id"), F.col("part"), F.col("supp")]
    return WideCascade(v.wide_raw(spark, sf_dir), S, "label", order, label_domain=fx.LABEL_DOMAIN,
                       col_threshold=fx.SPARSE_SHARE, row_threshold=fx.SPARSE_SHARE, k=fx.IQR_K)


def before_after(df, cols, repair):
    """Long (row_id, sensor, before, after) of a column-wise repair in one
    pass: the original values ride along in the same row, so no join of a
    "before" table with an "after" table is needed."""
    tagged = df.select("row_id", *cols, *[F.col(c).alias(f"_b_{c}") for c in cols])
    fixed = repair(tagged)
    pairs = [F.struct(F.col(f"_b_{c}").alias("before"), F.col(c).alias("after")).alias(c) for c in cols]
    return (fixed.select("row_id", *pairs).unpivot(["row_id"], list(cols), "sensor", "v")
            .select("row_id", "sensor", "v.before", "v.after"))


def _plus(parts) -> str:
    return " + ".join(parts)


def _stages_sql() -> str:
    part = ", ".join(S)
    nulls = _plus(f"CASE WHEN k_{c} AND {c} IS NULL THEN 1 ELSE 0 END" for c in S)
    ctes = [
        v.WIDE_RAW_SQL,
        f"w_d AS (SELECT * FROM wide_raw QUALIFY row_number() OVER (PARTITION BY {part} "
        "ORDER BY abs(row_id), -row_id, part, supp) = 1)",
        "w_rates AS (SELECT COUNT(*) AS n_d, " + ", ".join(
            f"CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS r_{c}" for c in S)
        + " FROM w_d)",
        "w_live AS (SELECT " + ", ".join(f"NOT (r_{c} > 0.5) AS k_{c}" for c in S) + ", "
        + _plus(f"CASE WHEN NOT (r_{c} > 0.5) THEN 1 ELSE 0 END" for c in S) + " AS n_live FROM w_rates)",
        f"w_flag AS (SELECT w_d.*, w_live.*, CAST({nulls} AS DOUBLE) / n_live > 0.5 AS sparse_row, "
        f"{nulls} AS row_nulls FROM w_d, w_live)",
        "w_r AS (SELECT * FROM w_flag WHERE NOT sparse_row)",
        "w_med AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in S) + " FROM w_r)",
        "w_f AS (SELECT w_r.* REPLACE (" + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in S)
        + ") FROM w_r, w_med)",
        "w_einf AS (SELECT " + _plus(f"SUM(CASE WHEN k_{c} AND isinf({c}) THEN 1 ELSE 0 END)" for c in S)
        + " AS e_inf FROM w_f)",
        "w_infn AS (SELECT w_f.* REPLACE (" + ", ".join(f"CASE WHEN isinf({c}) THEN NULL ELSE {c} END AS {c}" for c in S)
        + ") FROM w_f)",
        "w_med2 AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m2_{c}" for c in S) + " FROM w_infn)",
        "w_v AS (SELECT w_infn.* REPLACE (" + ", ".join(f"coalesce({c}, m2_{c}) AS {c}" for c in S)
        + ") FROM w_infn, w_med2)",
        "w_const AS (SELECT " + ", ".join(f"(COUNT({c}) >= 2 AND MIN({c}) = MAX({c})) AS z_{c}" for c in S)
        + ", " + ", ".join(f"COUNT({c}) AS cnt_{c}" for c in S) + " FROM w_v)",
        "w_keep AS (SELECT " + ", ".join(f"k_{c} AND NOT z_{c} AS g_{c}" for c in S) + ", "
        + _plus(f"CASE WHEN k_{c} AND NOT z_{c} THEN 1 ELSE 0 END" for c in S) + " AS n_valid, "
        + _plus(f"CASE WHEN k_{c} AND z_{c} THEN 1 ELSE 0 END" for c in S) + " AS n_const FROM w_live, w_const)",
        "w_q AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}"
                                      for c in S) + " FROM w_v)",
        "w_b AS (SELECT w_q.*, " + ", ".join(
            f"q1_{c} - CAST(3.0 AS DOUBLE) * (q3_{c} - q1_{c}) AS lo_{c}, "
            f"q3_{c} + CAST(3.0 AS DOUBLE) * (q3_{c} - q1_{c}) AS hi_{c}" for c in S) + " FROM w_q)",
        "w_c AS (SELECT w_v.* REPLACE (" + ", ".join(
            f"CASE WHEN g_{c} AND {c} IS NOT NULL THEN least(greatest({c}, lo_{c}), hi_{c}) ELSE {c} END AS {c}"
            for c in S) + ") FROM w_v, w_b, w_keep)",
    ]
    return "WITH " + ",\n".join(c.strip() for c in ctes)


STAGES_SQL = _stages_sql()


def _long_sql(source: str, flag: str, where: str = "TRUE") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT row_id, '{c}' AS sensor, {c} AS value FROM {source}, w_keep WHERE {flag}_{c} AND ({where.format(c=c)})"
        for c in S)


@register("q_missing_rates", STAGES_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing, "
    f"CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS missing_rate FROM w_d" for c in S))
def q_missing_rates(spark, sf_dir):
    """D4 on the deduplicated table: the input of the drop decision."""
    return pr.missing_rates(cascade(spark, sf_dir).deduped(), S)


@register("q_sparse_rows", STAGES_SQL + """
SELECT row_id, CAST(row_nulls AS DOUBLE) / n_live AS row_missing_rate FROM w_r""")
def q_sparse_rows(spark, sf_dir):
    """B7 after the sparse-column drop: kept rows and their missing share."""
    from ..operators.cleansing import row_missing_rate
    c = cascade(spark, sf_dir)
    return c.rows_kept().select("row_id", row_missing_rate(c.live()).alias("row_missing_rate"))


@register("q_missing_summary", STAGES_SQL + """
SELECT COUNT(*) AS n_rows, CAST(SUM(row_nulls) AS BIGINT) AS missing_cells,
       ROUND(CAST(SUM(row_nulls) AS DOUBLE) / (COUNT(*) * any_value(n_live)), 6) AS overall_rate,
       ROUND(greatest(""" + ", ".join(
    f"CASE WHEN any_value(k_{c}) THEN AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) END" for c in S) + """), 6)
       AS max_column_rate
FROM w_r""")
def q_missing_summary(spark, sf_dir):
    """D5 over the live sensors of the row-filtered table."""
    c = cascade(spark, sf_dir)
    ms = pr.missing_summary(c.rows_kept(), c.live())
    return ms.select("n_rows", "missing_cells", r6("overall_rate").alias("overall_rate"),
                     r6("max_column_rate").alias("max_column_rate"))


@register("q_impute_median", STAGES_SQL + "\n" + _long_sql("w_f", "k"))
def q_impute_median(spark, sf_dir):
    """Every live cell after the exact median fill, long form."""
    c = cascade(spark, sf_dir)
    return unpivot(c.filled(), c.live(), ["row_id"])


@register("q_inf_repair", STAGES_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT row_id, '{c}' AS sensor, m2_{c} AS value FROM w_f, w_med2 WHERE k_{c} AND isinf({c})" for c in S))
def q_inf_repair(spark, sf_dir):
    """The cells that held +-Inf and their repaired (median) value."""
    c = cascade(spark, sf_dir)
    cells = before_after(c.filled(), c.live(), c.repair)
    return cells.where(F.abs(F.col("before")) == float("inf")).select("row_id", "sensor", F.col("after").alias("value"))


@register("q_constant_columns", STAGES_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", cnt_{c} AS n, z_{c} AS is_constant FROM w_const, w_live WHERE k_{c}" for c in S))
def q_constant_columns(spark, sf_dir):
    """D6 over the live sensors after the Inf repair."""
    c = cascade(spark, sf_dir)
    return pr.constant_column_table(c.repaired(), c.live())


@register("q_iqr_fences", STAGES_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", ROUND(q1_{c}, 6) AS q1, ROUND(q3_{c}, 6) AS q3, "
    f"ROUND(q3_{c} - q1_{c}, 6) AS iqr, ROUND(lo_{c}, 6) AS lower, ROUND(hi_{c}, 6) AS upper "
    f"FROM w_b, w_keep WHERE g_{c}" for c in S))
def q_iqr_fences(spark, sf_dir):
    """Exact quartiles and 3*IQR fences of the valid sensors."""
    c = cascade(spark, sf_dir)
    f = ou.iqr_fences(c.nonconstant(), c.valid_cols(), fx.IQR_K)
    c.release()  # the fence table is a local frame of collected quantiles
    return f.select("column", *[r6(x).alias(x) for x in ("q1", "q3", "iqr", "lower", "upper")])


@register("q_outlier_cells", STAGES_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST(SUM(CASE WHEN {c} < lo_{c} OR {c} > hi_{c} THEN 1 ELSE 0 END) AS BIGINT) "
    f"AS outliers, COUNT(*) AS cells, CAST(SUM(CASE WHEN {c} < lo_{c} OR {c} > hi_{c} THEN 1 ELSE 0 END) AS DOUBLE)"
    f" / COUNT(*) AS outlier_rate FROM w_v, w_b, w_keep WHERE g_{c} GROUP BY 1" for c in S))
def q_outlier_cells(spark, sf_dir):
    """Outlier cells per sensor against the fences."""
    c = cascade(spark, sf_dir)
    return ou.outlier_cells(c.nonconstant(), c.bounds())


@register("q_outlier_clip", STAGES_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT row_id, '{c}' AS sensor, ROUND(CASE WHEN {c} < lo_{c} THEN lo_{c} ELSE hi_{c} END, 6) AS value "
    f"FROM w_v, w_b, w_keep WHERE g_{c} AND ({c} < lo_{c} OR {c} > hi_{c})" for c in S))
def q_outlier_clip(spark, sf_dir):
    """The clipped cells and their new value (the fence)."""
    c = cascade(spark, sf_dir)
    cells = before_after(c.nonconstant(), c.valid_cols(), lambda d: clip_columns(d, c.bounds()))
    return cells.where(F.col("before") != F.col("after")).select("row_id", "sensor", r6("after").alias("value"))


@register("q_label_domain", STAGES_SQL + """
SELECT row_id, label FROM w_c WHERE label IN (-1, 1)""")
def q_label_domain(spark, sf_dir):
    """Rows whose label is in {-1, 1} (NULL and 0 are invalid)."""
    return cascade(spark, sf_dir).final().select("row_id", "label")


SCORE_SQL = """q AS (
  SELECT *,
    CAST(n_original - e_uni AS DOUBLE) / n_original * 100 AS q_uni,
    CAST(n_original * n_sensors - (e_com_cols * n_original + e_com_rows * n_live + e_com_cells) AS DOUBLE)
      / (n_original * n_sensors) * 100 AS q_com,
    CAST(n_original * n_sensors - (e_val_inf + e_val_const * n_original) AS DOUBLE) / (n_original * n_sensors) * 100 AS q_val,
    CAST(n_con - e_con AS DOUBLE) / n_con * 100 AS q_con,
    CAST(n_original - e_acc AS DOUBLE) / n_original * 100 AS q_acc
  FROM parts)
SELECT n_original, CAST(n_sensors AS BIGINT) AS n_sensors, e_uni, ROUND(q_uni, 6) AS q_uni,
       CAST(e_com_cols AS BIGINT) AS e_com_cols, e_com_rows, e_com_cells, ROUND(q_com, 6) AS q_com,
       e_val_inf, CAST(e_val_const AS BIGINT) AS e_val_const, ROUND(q_val, 6) AS q_val,
       e_con, CAST(n_con AS BIGINT) AS n_con, ROUND(q_con, 6) AS q_con, e_acc, ROUND(q_acc, 6) AS q_acc,
       ROUND((q_uni + q_com + q_val + q_con + q_acc) / 5, 6) AS mdqi,
       CASE WHEN (q_uni + q_com + q_val + q_con + q_acc) / 5 >= 99 THEN 'S'
            WHEN (q_uni + q_com + q_val + q_con + q_acc) / 5 >= 95 THEN 'A'
            WHEN (q_uni + q_com + q_val + q_con + q_acc) / 5 >= 80 THEN 'B' ELSE 'C' END AS grade,
       rows_final, CAST(sensors_final AS BIGINT) AS sensors_final
FROM q"""


@register("q_mdqi", STAGES_SQL + """
, u AS (SELECT COUNT(*) AS c FROM wide_raw GROUP BY """ + ", ".join(S) + """),
n0 AS (SELECT COUNT(*) AS n FROM wide_raw),
parts AS (
  SELECT n0.n AS n_original, """ + str(len(S)) + """ AS n_sensors,
    (SELECT CAST(coalesce(SUM(c) FILTER (WHERE c > 1), 0) AS BIGINT) FROM u) AS e_uni,
    (SELECT """ + str(len(S)) + """ - n_live FROM w_live) AS e_com_cols,
    (SELECT COUNT(*) FROM w_flag WHERE sparse_row) AS e_com_rows,
    (SELECT CAST(coalesce(SUM(row_nulls), 0) AS BIGINT) FROM w_r) AS e_com_cells,
    (SELECT n_live FROM w_live) AS n_live,
    (SELECT CAST(e_inf AS BIGINT) FROM w_einf) AS e_val_inf,
    (SELECT n_const FROM w_keep) AS e_val_const,
    (SELECT CAST(""" + _plus(f"SUM(CASE WHEN g_{c} AND ({c} < lo_{c} OR {c} > hi_{c}) THEN 1 ELSE 0 END)" for c in S)
    + """ AS BIGINT) FROM w_v, w_b, w_keep) AS e_con,
    (SELECT COUNT(*) * any_value(n_valid) FROM w_v, w_keep) AS n_con,
    (SELECT COUNT(*) FROM w_c WHERE NOT coalesce(label IN (-1, 1), FALSE)) AS e_acc,
    (SELECT COUNT(*) FROM w_c WHERE label IN (-1, 1)) AS rows_final,
    (SELECT n_valid FROM w_keep) AS sensors_final
  FROM n0),
""" + SCORE_SQL)
def q_mdqi(spark, sf_dir):
    """The five indicators, MDQI and grade of the wide table."""
    return _scored(cascade(spark, sf_dir))


def _scored(c: WideCascade):
    s = c.score()  # built from collected metadata only
    c.release()
    dbl = ["q_uni", "q_com", "q_val", "q_con", "q_acc", "mdqi"]
    return s.select(*[r6(c).alias(c) if c in dbl else F.col(c) for c in s.columns])


@register("q_mdqi_wide", f"""
WITH {v.SENSOR_ARRAY_SQL},
vec AS (SELECT row_id, any_value(label) AS label, string_agg(coalesce(CAST(v AS VARCHAR), '-'), ',' ORDER BY j) AS vec FROM sensor_array GROUP BY row_id),
firsts AS (SELECT row_id, label, COUNT(*) OVER (PARTITION BY vec) AS copies FROM vec QUALIFY row_number() OVER (PARTITION BY vec ORDER BY abs(row_id), -row_id) = 1),
d AS (SELECT a.* FROM sensor_array a SEMI JOIN firsts USING (row_id)),
live AS (SELECT j FROM d GROUP BY j HAVING NOT (CAST(COUNT(*) - COUNT(v) AS DOUBLE) / COUNT(*) > {fx.SPARSE_SHARE})),
dl AS (SELECT d.* FROM d SEMI JOIN live USING (j)),
rows_ok AS (SELECT row_id FROM dl GROUP BY row_id HAVING NOT (CAST(COUNT(*) - COUNT(v) AS DOUBLE) / COUNT(*) > {fx.SPARSE_SHARE})),
r AS (SELECT dl.* FROM dl SEMI JOIN rows_ok USING (row_id)),
med AS (SELECT j, quantile_cont(v, 0.5) AS m FROM r GROUP BY j),
f AS (SELECT row_id, label, j, coalesce(v, m) AS v FROM r JOIN med USING (j)),
fn AS (SELECT row_id, label, j, CASE WHEN NOT isinf(v) THEN v END AS v FROM f),
med2 AS (SELECT j, quantile_cont(v, 0.5) AS m FROM fn GROUP BY j),
w AS (SELECT row_id, label, j, coalesce(v, m) AS v FROM fn JOIN med2 USING (j)),
valid AS (SELECT j, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM w GROUP BY j HAVING NOT (COUNT(v) >= 2 AND MIN(v) = MAX(v))),
parts AS (
  SELECT (SELECT COUNT(*) FROM vec) AS n_original, {v.WIDE_COLUMNS} AS n_sensors,
    (SELECT CAST(coalesce(SUM(copies) FILTER (WHERE copies > 1), 0) AS BIGINT) FROM firsts) AS e_uni,
    (SELECT {v.WIDE_COLUMNS} - COUNT(*) FROM live) AS e_com_cols,
    (SELECT COUNT(*) FROM firsts) - (SELECT COUNT(*) FROM rows_ok) AS e_com_rows,
    (SELECT COUNT(*) - COUNT(v) FROM r) AS e_com_cells,
    (SELECT COUNT(*) FROM live) AS n_live,
    (SELECT COUNT(*) FROM f WHERE isinf(v)) AS e_val_inf,
    (SELECT COUNT(*) FROM live) - (SELECT COUNT(*) FROM valid) AS e_val_const,
    (SELECT COUNT(*) FROM w JOIN valid USING (j) WHERE v < q1 - {fx.IQR_K} * (q3 - q1) OR v > q3 + {fx.IQR_K} * (q3 - q1)) AS e_con,
    (SELECT COUNT(*) FROM rows_ok) * (SELECT COUNT(*) FROM valid) AS n_con,
    (SELECT COUNT(*) FROM firsts SEMI JOIN rows_ok USING (row_id) WHERE NOT coalesce(label IN (-1, 1), FALSE)) AS e_acc,
    (SELECT COUNT(*) FROM firsts SEMI JOIN rows_ok USING (row_id) WHERE label IN (-1, 1)) AS rows_final,
    (SELECT COUNT(*) FROM valid) AS sensors_final),
""" + SCORE_SQL)
def q_mdqi_wide(spark, sf_dir):
    """E1-E7 at sensor-table width: 512 columns."""
    return _scored(WideCascade(v.sensor_array(spark, sf_dir), [f"c{j}" for j in range(v.WIDE_COLUMNS)], "label",
                               [F.abs(F.col("row_id")), -F.col("row_id")], label_domain=fx.LABEL_DOMAIN,
                               col_threshold=fx.SPARSE_SHARE, row_threshold=fx.SPARSE_SHARE, k=fx.IQR_K))

"""Sensor-feed and rule-cascade queries; importing this module also loads
every other plan module, so ``QUERIES`` / ``ORACLE`` hold the full catalog.

Registered driver queries: each has a Spark plan built from the library
operators and (where SQL can say it) an equivalent DuckDB query.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> str``.
Floating aggregates are rounded to 6 decimals on both sides; timestamps stay
``timestamp_ntz``; integer sums are cast to BIGINT.
"""
from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleansing as cl
from ..operators import duplicates as du
from ..operators import quality as qu
from . import fixed as fx
from . import views as v

from .registry import ORACLE, QUERIES, r6, register  # noqa: F401


# ------------------------------------------------------------ sensor pipeline
SENSOR_LIMITS = fx.SENSOR_LIMITS


def sensor_rule():
    return (F.col("temperature") >= fx.STATUS_MIN_TEMPERATURE) | (F.col("pressure") >= fx.STATUS_MIN_PRESSURE)


def sensor_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 -> D3 -> B6 -> B5 -> B13 -> B14 (the stage order of the source)."""
    raw = cl.na_normalise(v.sensor_raw(spark, sf_dir))
    dedup = du.dedupe(raw, ["machine_id", "ts"], order_by=["seq"], unique_order=True)
    kept = cl.keep_in_range(cl.drop_missing(dedup), SENSOR_LIMITS)
    rounded = cl.round_columns(kept, ["temperature", "pressure"], fx.ROUND_DIGITS)
    return cl.label_by_rule(rounded, sensor_rule(), "status_label")


@register("q_sensor_clean", v.with_sql(v.SENSOR_CLEAN_SQL) + """
SELECT seq, machine_id, ts, temperature, pressure, status_label FROM sensor_clean""")
def q_sensor_clean(spark, sf_dir):
    return sensor_clean(spark, sf_dir).select("seq", "machine_id", "ts", "temperature", "pressure", "status_label")


@register("q_quality_report", v.with_sql(v.SENSOR_CLEAN_SQL) + """
, rep_in AS (
  SELECT 'raw' AS stage, machine_id, ts, temperature, pressure, CAST(NULL AS INTEGER) AS status_label,
         FALSE AS has_label FROM sensor_norm
  UNION ALL
  SELECT 'clean', machine_id, ts, temperature, pressure, status_label, TRUE FROM sensor_clean),
dups AS (
  SELECT stage, SUM(c - 1) AS excess FROM (
    SELECT stage, machine_id, ts, COUNT(*) AS c FROM rep_in GROUP BY stage, machine_id, ts) GROUP BY stage),
body AS (
  SELECT stage, COUNT(*) AS n_rows,
         greatest(AVG(CASE WHEN temperature IS NULL THEN 1.0 ELSE 0.0 END),
                  AVG(CASE WHEN pressure IS NULL THEN 1.0 ELSE 0.0 END)) AS missing_ratio,
         AVG(CASE WHEN (temperature IS NOT NULL AND NOT (temperature BETWEEN 0 AND 100))
                    OR (pressure IS NOT NULL AND NOT (pressure BETWEEN 0 AND 5)) THEN 1.0 ELSE 0.0 END)
           AS validity_ratio,
         CASE WHEN bool_and(has_label) THEN
           AVG(CASE WHEN coalesce(temperature >= 28.0 OR pressure >= 1.4, FALSE)
                         <> coalesce(status_label = 1, FALSE) THEN 1.0 ELSE 0.0 END) END AS consistency_ratio
  FROM rep_in GROUP BY stage)
SELECT b.stage, b.n_rows, CAST(d.excess AS DOUBLE) / b.n_rows AS duplicate_ratio,
       b.missing_ratio, b.validity_ratio, b.consistency_ratio, 'Pass' AS accuracy
FROM body b JOIN dups d ON b.stage = d.stage""")
def q_quality_report(spark, sf_dir):
    raw = cl.na_normalise(v.sensor_raw(spark, sf_dir))
    clean = sensor_clean(spark, sf_dir)
    args = dict(key_cols=["machine_id", "ts"], limits=SENSOR_LIMITS, rule=sensor_rule(),
                label_col="status_label", time_col="ts")
    return qu.quality_report(raw, "raw", **args).unionByName(qu.quality_report(clean, "clean", **args))


# ------------------------------------------------------ injection rule cascade
CYCLE_KEY = ["ts", "equip_cd", "part_name"]
CRITICAL = ["injection_time", "cycle_time", "barrel_temperature"]
def cycle_order():
    """File order of the cycle feed: a copy sorts right after its original."""
    return [F.abs(F.col("cycle_id")), -F.col("cycle_id")]
CYCLE_ORDER_SQL = "abs(cycle_id), -cycle_id"


def cycle_rules() -> dict:
    return {
        "missing": cl.missing_any(CRITICAL),
        "non_positive": cl.non_positive(["cycle_time", "injection_time"]),
        "label_contradiction": cl.label_reason_contradiction("pass_or_fail", fx.PASS_TOKEN, "reason",
                                                             fx.NO_REASON_TOKEN),
        "time_contradiction": cl.order_contradiction("injection_time", "cycle_time"),
        "out_of_limits": cl.out_of_limits({"barrel_temperature": fx.BARREL_LIMITS}),
    }


@register("q_rule_cleanse", v.with_sql(v.CYCLES_RAW_SQL) + f"""
, d AS (SELECT * FROM cycles_raw
        QUALIFY row_number() OVER (PARTITION BY ts, equip_cd, part_name ORDER BY {CYCLE_ORDER_SQL}) = 1)
SELECT * FROM d
WHERE injection_time IS NOT NULL AND cycle_time IS NOT NULL AND barrel_temperature IS NOT NULL
  AND NOT coalesce(cycle_time <= 0 OR injection_time <= 0, FALSE)
  AND NOT coalesce(pass_or_fail = 'Y' AND reason IS NOT NULL AND reason <> 'None', FALSE)
  AND NOT coalesce(injection_time >= cycle_time, FALSE)
  AND NOT coalesce(barrel_temperature < 50 OR barrel_temperature > 400, FALSE)""")
def q_rule_cleanse(spark, sf_dir):
    """D3 -> B6 -> B1 -> B2 -> B3 -> B4, in the source's order."""
    df = du.dedupe(v.cycles_raw(spark, sf_dir), CYCLE_KEY, cycle_order())
    df = cl.drop_missing(df, CRITICAL)
    df = cl.drop_non_positive(df, ["cycle_time", "injection_time"])
    df = cl.drop_contradiction(df, cl.label_reason_contradiction("pass_or_fail", fx.PASS_TOKEN, "reason",
                                                                 fx.NO_REASON_TOKEN))
    df = cl.drop_contradiction(df, cl.order_contradiction("injection_time", "cycle_time"))
    return cl.drop_out_of_limits(df, {"barrel_temperature": fx.BARREL_LIMITS})


@register("q_rule_audit", v.with_sql(v.CYCLES_RAW_SQL) + f"""
, firsts AS (SELECT *, row_number() OVER (PARTITION BY ts, equip_cd, part_name ORDER BY {CYCLE_ORDER_SQL}) AS rn
             FROM cycles_raw),
tagged AS (
  SELECT CASE WHEN rn > 1 THEN 0
              WHEN injection_time IS NULL OR cycle_time IS NULL OR barrel_temperature IS NULL THEN 1
              WHEN cycle_time <= 0 OR injection_time <= 0 THEN 2
              WHEN pass_or_fail = 'Y' AND reason IS NOT NULL AND reason <> 'None' THEN 3
              WHEN injection_time >= cycle_time THEN 4
              WHEN barrel_temperature < 50 OR barrel_temperature > 400 THEN 5 END AS stage_order
  FROM firsts),
stages AS (SELECT * FROM (VALUES (0, 'duplicates'), (1, 'missing'), (2, 'non_positive'),
                                 (3, 'label_contradiction'), (4, 'time_contradiction'), (5, 'out_of_limits'))
           t(stage_order, stage)),
removed AS (SELECT s.stage_order, s.stage, COUNT(t.stage_order) AS removed
            FROM stages s LEFT JOIN tagged t ON s.stage_order = t.stage_order GROUP BY s.stage_order, s.stage),
total AS (SELECT COUNT(*) AS n FROM tagged),
cum AS (SELECT r.*, CAST(total.n - coalesce(SUM(removed) OVER (ORDER BY stage_order
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rows_before
        FROM removed r, total)
SELECT stage, CAST(stage_order AS INTEGER) AS stage_order, rows_before, removed,
       rows_before - removed AS rows_after,
       CASE WHEN rows_before > 0 THEN CAST(removed AS DOUBLE) / rows_before END AS removed_share
FROM cum""")
def q_rule_audit(spark, sf_dir):
    """Every rule of the cascade audited in one aggregation over the
    keep-first rows; the duplicate stage is the row-count difference across
    the (map-side combined) deduplication, so nothing is joined back."""
    from ..operators.profiling import audit
    raw = v.cycles_raw(spark, sf_dir)
    dedup = du.dedupe(raw, CYCLE_KEY, cycle_order())
    return audit(dedup, cycle_rules(), upstream=raw, upstream_stage="duplicates")


@register("q_duplicate_count", v.with_sql(v.CYCLES_RAW_SQL) + """
, k AS (SELECT COUNT(*) AS c FROM cycles_raw GROUP BY ts, equip_cd, part_name)
SELECT 'members' AS mode, CAST(SUM(c) AS BIGINT) AS n_rows,
       CAST(SUM(CASE WHEN c > 1 THEN c ELSE 0 END) AS BIGINT) AS duplicates,
       SUM(CASE WHEN c > 1 THEN c ELSE 0 END) / SUM(c) AS ratio FROM k
UNION ALL
SELECT 'excess', CAST(SUM(c) AS BIGINT), CAST(SUM(c - 1) AS BIGINT), SUM(c - 1) / SUM(c) FROM k""")
def q_duplicate_count(spark, sf_dir):
    """D1 (all members of a repeated key) and D2 (excess rows only)."""
    raw = v.cycles_raw(spark, sf_dir)
    return (du.duplicate_count(raw, CYCLE_KEY, "members").select(F.lit("members").alias("mode"), "*")
            .unionByName(du.duplicate_count(raw, CYCLE_KEY, "excess").select(F.lit("excess").alias("mode"), "*")))


# load the other plan modules (they register on import)
from . import wide, profiles, evaluation, features, telemetry, streams, models  # noqa: E402,F401

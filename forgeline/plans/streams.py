"""Streaming queries: the ``events`` file is consumed as a stream with
``availableNow`` and the sink table is read back, so every result can be
checked against the batch SQL of the same operators (A4, A9, I1, I7, I8)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.bundles import LinearBundle
from ..streaming import changes as ch
from ..streaming import live as lv
from ..streaming import pipelines as st
from . import catalog as cat
from . import views as v
from .registry import r6, register


def _feed(spark, sf_dir):
    return v.sensor_feed(st.sensor_stream(spark, sf_dir, "events"))


@register("q_landing", v.with_sql(v.SENSOR_RAW_SQL) + """
SELECT seq, machine_id, ts, temperature, pressure, CAST(ts AS DATE) AS date FROM sensor_raw""")
def q_landing(spark, sf_dir):
    """A9 + A4: the raw feed landed as date-partitioned parquet."""
    path = st.land_raw(_feed(spark, sf_dir))
    return spark.read.parquet(path).select("seq", "machine_id", "ts", "temperature", "pressure", "date")


@register("q_clean_stream", v.with_sql(v.SENSOR_CLEAN_SQL) + """
SELECT seq, machine_id, ts, temperature, pressure, status_label FROM sensor_clean""")
def q_clean_stream(spark, sf_dir):
    """Streaming keep-first (watermarked min_by state) + cleanse + label;
    equals the batch ``q_sensor_clean``."""
    path = st.clean_stream(_feed(spark, sf_dir), cat.SENSOR_LIMITS, cat.sensor_rule())
    clean = st.clean_table(spark, path, cat.SENSOR_LIMITS, cat.sensor_rule())
    return clean.select("seq", "machine_id", "ts", "temperature", "pressure", "status_label")


@register("q_quality_stream", v.with_sql(v.SENSOR_RAW_SQL) + """
SELECT date_trunc('day', ts) AS window_start, COUNT(*) AS n_rows,
       ROUND(greatest(AVG(CASE WHEN temperature IS NULL THEN 1.0 ELSE 0.0 END),
                      AVG(CASE WHEN pressure IS NULL THEN 1.0 ELSE 0.0 END)), 6) AS missing_ratio,
       ROUND(AVG(CASE WHEN (temperature IS NOT NULL AND NOT (temperature BETWEEN 0 AND 100))
                        OR (pressure IS NOT NULL AND NOT (pressure BETWEEN 0 AND 5)) THEN 1.0 ELSE 0.0 END), 6)
         AS validity_ratio
FROM sensor_norm GROUP BY 1""")
def q_quality_stream(spark, sf_dir):
    """I8: daily windowed quality indicators of the live feed (update mode,
    newest version of each window kept)."""
    from ..operators.cleansing import na_normalise
    q = st.quality_stream(na_normalise(_feed(spark, sf_dir)), "ts", cat.SENSOR_LIMITS, "1 day")
    path = st.run_batches(q, "quality", st.write_latest_per_key(["window_start"]))
    out = st.read_latest(spark, path, ["window_start"])
    return out.select("window_start", "n_rows", r6("missing_ratio").alias("missing_ratio"),
                      r6("validity_ratio").alias("validity_ratio"))


@register("q_change_stream", """
WITH r AS (SELECT event_id, user_id AS machine_id, ts, round(value / CAST(10.0 AS DOUBLE), 0) AS level FROM events),
l AS (SELECT *, lag(level) OVER (PARTITION BY machine_id ORDER BY ts, event_id) AS prev_value,
             row_number() OVER (PARTITION BY machine_id ORDER BY ts, event_id) AS rn FROM r)
SELECT event_id, machine_id, ts, level, prev_value FROM l WHERE rn = 1 OR level IS DISTINCT FROM prev_value""")
def q_change_stream(spark, sf_dir):
    """I1 (stream): report-by-exception with the last value per machine as state."""
    ev = st.sensor_stream(spark, sf_dir, "events")
    r = ev.select("event_id", F.col("user_id").alias("machine_id"), "ts",
                  F.round(F.col("value") / F.lit(10.0), 0).alias("level"))
    path = st.run_to_table(st.change_stream(r, "machine_id", ["ts", "event_id"], "level"), "changes")
    return spark.read.parquet(path).select("event_id", "machine_id", "ts", "level", "prev_value")


@register("q_latest_stream", """
SELECT user_id AS machine_id, value, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def q_latest_stream(spark, sf_dir):
    """I6 (stream): periodic monitoring read -- the newest value per machine,
    maintained in update mode and resolved to the newest version per key."""
    ev = st.sensor_stream(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("machine_id"), "ts", "value")
    q = st.latest_stream(ev, "machine_id", "ts", "value", tiebreak="event_id")
    path = st.run_batches(q, "latest", st.write_latest_per_key(["machine_id"]))
    return st.read_latest(spark, path, ["machine_id"]).select("machine_id", "value", "ts")


@register("q_change_stream_late", """
WITH r AS (SELECT event_id, user_id AS machine_id, ts,
                  CASE WHEN event_id % 13 = 4 THEN NULL WHEN event_id % 17 = 3 THEN CAST('NaN' AS DOUBLE) ELSE round(value / CAST(10.0 AS DOUBLE), 0) END AS level FROM events),
l AS (SELECT *, lag(level) OVER (PARTITION BY machine_id ORDER BY ts, event_id) AS prev_value,
             row_number() OVER (PARTITION BY machine_id ORDER BY ts, event_id) AS rn FROM r)
SELECT event_id, machine_id, ts, level, prev_value FROM l WHERE rn = 1 OR level IS DISTINCT FROM prev_value""")
def q_change_stream_late(spark, sf_dir):
    """I1 (stream): the feed arrives in four files that cut across time, one a
    micro-batch, with NULL and NaN readings; equals the changes in time order."""
    ev = v.table(spark, sf_dir, "events")
    level = F.when(F.col("event_id") % 13 == 4, F.lit(None)).when(F.col("event_id") % 17 == 3, F.lit(float("nan"))).otherwise(F.round(F.col("value") / F.lit(10.0), 0))
    rows = ev.select("event_id", F.col("user_id").alias("machine_id"), "ts", level.cast("double").alias("level"))
    source = st.stream_dir(spark, "late-feed")
    rows.repartition(4, F.col("event_id") % 4).write.parquet(f"{source}/events.parquet")
    feed = st.sensor_stream(spark, source, "events", files_per_trigger=1)
    chunks = ch.reading_chunks(feed, "machine_id", "ts", ["ts", "event_id"], "1 day", "36500 days")
    path = st.run_batches(chunks, "late-changes", st.write_latest_per_key(["machine_id", "start"]))
    return ch.changes(spark, path, "machine_id", "level").select("event_id", "machine_id", "ts", "level", "prev_value")


BUNDLE = LinearBundle(("value", "k"), (50.0, 40.0), (25.0, 30.0), (0.8, -0.5), -0.2, 0.5)
SCORE_SQL = "1.0 / (1.0 + exp(-(-0.2 + 0.8 * ((value - 50.0) / 25.0) + -0.5 * ((k - 40.0) / 30.0))))"
EVENT_SQL = "SELECT event_id, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events"


def _events(df):
    return df.select("event_id", "value", F.get_json_object("props", "$.k").cast("double").alias("k"))


@register("q_bundle_scores", f"""
WITH e AS ({EVENT_SQL}), p AS (SELECT event_id, {SCORE_SQL} AS p FROM e)
SELECT event_id, ROUND(p, 9) AS probability, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS pred FROM p""")
def q_bundle_scores(spark, sf_dir):
    """A8 + G2 + G3: a bundle of fixed weights saved, loaded and applied to all events."""
    path = f"{st.stream_dir(spark, 'bundle')}/bundle"
    BUNDLE.save(spark, path)
    bundle = LinearBundle.load(spark, path)
    told = _events(v.table(spark, sf_dir, "events")).withColumn("p", bundle.probability())
    return told.select("event_id", F.round("p", 9).alias("probability"), bundle.verdict(F.col("p")).alias("pred"))


@register("q_live_scores", f"""
WITH e AS ({EVENT_SQL}),
r AS (SELECT *, CASE WHEN event_id % 37 = 5 OR event_id % 43 = 9 THEN 'unreadable' WHEN event_id % 41 = 7 THEN 'lacks k' WHEN event_id % 47 = 2 THEN 'lacks value, k' END AS reason FROM e),
p AS (SELECT event_id, reason, CASE WHEN reason IS NULL THEN {SCORE_SQL} END AS p FROM r)
SELECT event_id, ROUND(p, 9) AS probability, CASE WHEN reason IS NULL THEN CASE WHEN p >= 0.5 THEN 1 ELSE 0 END END AS pred,
       CASE WHEN reason IS NULL THEN CASE WHEN p >= 0.5 THEN 'FAILURE RISK' ELSE 'normal' END END AS status, reason FROM p""")
def q_live_scores(spark, sf_dir):
    """Events as JSON records, some cut short, mistyped or incomplete, scored live
    by a saved bundle; scores and dead letters together hold every record once."""
    whole = F.to_json(F.struct("value", "k"))
    payload = (F.when((F.col("event_id") % 37 == 5), F.substring(whole, 1, 9)).when(F.col("event_id") % 43 == 9, F.lit('{"value": "high", "k": 1}'))
               .when(F.col("event_id") % 41 == 7, F.to_json(F.struct("value"))).when(F.col("event_id") % 47 == 2, F.lit("{}")).otherwise(whole))
    feed = _events(st.sensor_stream(spark, sf_dir, "events")).select("event_id", payload.alias("payload"))
    path = st.stream_dir(spark, "live")
    BUNDLE.save(spark, f"{path}/bundle")
    lv.score_live(feed, "payload", LinearBundle.load(spark, f"{path}/bundle"), path)
    scores = lv.read_scores(spark, path).select("event_id", F.round("probability", 9).alias("probability"), "pred", "status", F.lit(None).cast("string").alias("reason"))
    dead = lv.read_dead_letters(spark, path)
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    return scores.unionByName(dead.select("event_id", none("double", "probability"), none("int", "pred"), none("string", "status"), "reason"))

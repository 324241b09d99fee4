"""Telemetry history queries over ``events`` (I1-I6) and the vector
anomaly score over ``embeddings`` (the G8/G9/G11 analogue)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleansing as cl
from ..operators import history as hi
from ..operators.history_table import HistoryTable
from ..operators import images as im
from . import fixed as fx
from . import views as v
from .registry import register


def _readings(spark, sf_dir):
    """Temperature-like reading per machine: value / 10 (2-3 decimals)."""
    ev = v.table(spark, sf_dir, "events")
    return ev.select("event_id", F.col("user_id").alias("machine_id"), "ts", "value",
                     F.round(F.col("value") / F.lit(10.0), 0).alias("level"))


@register("q_value_changes", """
WITH r AS (SELECT event_id, user_id AS machine_id, ts, value, round(value / CAST(10.0 AS DOUBLE), 0) AS level
           FROM events),
l AS (SELECT *, lag(level) OVER (PARTITION BY machine_id ORDER BY ts, event_id) AS prev_value,
             row_number() OVER (PARTITION BY machine_id ORDER BY ts, event_id) AS rn FROM r)
SELECT event_id, machine_id, ts, level, prev_value FROM l
WHERE rn = 1 OR level IS DISTINCT FROM prev_value""")
def q_value_changes(spark, sf_dir):
    """I1 (batch): deliver a reading only when its level changed."""
    r = _readings(spark, sf_dir).select("event_id", "machine_id", "ts", "level")
    return hi.value_changes(r, "machine_id", ["ts", "event_id"], "level").select(
        "event_id", "machine_id", "ts", "level", "prev_value")


ALARM_TEMPLATE = "ALARM machine %d: temperature %.2f above 330.00"


@register("q_alarms", """
SELECT event_id, user_id AS machine_id, ts, value,
       printf('ALARM machine %d: temperature %.2f above 330.00', user_id, value) AS message
FROM events WHERE value > 330.0""")
def q_alarms(spark, sf_dir):
    """Threshold alarm with a formatted message."""
    ev = v.table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("machine_id"), "ts", "value")
    return hi.alarms(ev, "value", 330.0, "machine_id", ALARM_TEMPLATE)


HIST_START, HIST_END = "2024-01-05 00:00:00", "2024-01-20 00:00:00"


@register("q_history", f"""
SELECT event_id, user_id AS machine_id, ts, value FROM events
WHERE ts BETWEEN TIMESTAMP '{HIST_START}' AND TIMESTAMP '{HIST_END}'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) <= 5""")
def q_history(spark, sf_dir):
    """Raw values of each machine in a time range, oldest five."""
    ev = v.table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("machine_id"), "ts", "value")
    start = F.lit(HIST_START).cast("timestamp_ntz")
    end = F.lit(HIST_END).cast("timestamp_ntz")
    return hi.read_history(ev, "machine_id", "ts", start, end, fx.HISTORY_VALUES, tiebreak="event_id")


@register("q_retain", """
WITH t AS (SELECT event_id, user_id AS machine_id, ts, value,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rk,
                  MAX(ts) OVER (PARTITION BY user_id) AS newest FROM events)
SELECT event_id, machine_id, ts, value FROM t WHERE rk <= 10 AND ts >= newest - INTERVAL 3 DAY""")
def q_retain(spark, sf_dir):
    """I4: per machine keep the newest 10 values that are within 3 days of
    its newest value (retention compaction)."""
    ev = v.table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("machine_id"), "ts", "value")
    return hi.retain(ev, "machine_id", "ts", 10, "3 days", tiebreak="event_id")


@register("q_local_time", """
SELECT event_id, ts + INTERVAL 9 HOUR AS ts_local, strftime(ts + INTERVAL 9 HOUR, '%H:%M:%S') AS clock FROM events""")
def q_local_time(spark, sf_dir):
    """UTC -> Asia/Seoul wall time and its HH:MM:SS text."""
    ev = v.table(spark, sf_dir, "events").select("event_id", "ts")
    return hi.to_local(ev, "ts", fx.LOCAL_TIME_ZONE).select("event_id", "ts_local", "clock")


@register("q_latest", """
SELECT user_id AS machine_id, value, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def q_latest(spark, sf_dir):
    """The newest reading of every machine."""
    ev = v.table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("machine_id"), "ts", "value")
    return hi.latest_values(ev, "machine_id", "ts", "value", tiebreak="event_id")


@register("q_vector_anomaly", """
WITH e AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
c AS (SELECT pos, AVG(CAST(x AS DOUBLE)) AS mu FROM e WHERE label = 0 GROUP BY pos),
err AS (SELECT e.vec_id, any_value(e.label) AS label, AVG(pow(CAST(e.x AS DOUBLE) - c.mu, 2)) AS error
        FROM e JOIN c ON e.pos = c.pos GROUP BY e.vec_id),
thr AS (SELECT MAX(error) AS t FROM err WHERE label = 0)
SELECT vec_id, label, ROUND(error, 9) AS error, CASE WHEN error >= t THEN 1 ELSE 0 END AS verdict FROM err, thr""")
def q_vector_anomaly(spark, sf_dir):
    """G8/G9/G11/G12 on vectors: the normal (label 0) centroid is the
    reconstruction, the mean squared difference the error, and the verdict
    is error >= the largest error seen on normal vectors."""
    emb = v.table(spark, sf_dir, "embeddings")
    return im.vector_anomaly(emb, "vec_id", "embedding", "label", normal_label=0).select(
        "vec_id", "label", F.round("error", 9).alias("error"), "verdict")


@register("q_map_anomaly", """
WITH e AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings),
c AS (SELECT pos, AVG(CAST(x AS DOUBLE)) AS mu FROM e WHERE label = 0 GROUP BY pos),
m AS (SELECT vec_id, label, e.pos // 8 AS y, e.pos % 8 AS x, pow(CAST(e.x AS DOUBLE) - mu, 2) AS v FROM e JOIN c ON e.pos = c.pos),
taps AS (SELECT d, exp(-(d * d) / (2 * 2.6 * 2.6)) AS g FROM range(-7, 8) t(d)),
g AS (SELECT d, g / (SELECT SUM(g) FROM taps) AS g FROM taps),
places AS (SELECT i, d, g, CASE WHEN i + d < 0 THEN -(i + d) WHEN i + d > 7 THEN 14 - (i + d) ELSE i + d END AS j FROM range(8) t(i), g),
down AS (SELECT vec_id, any_value(label) AS label, p.i AS y, m.x, SUM(v * g) AS v FROM m JOIN places p ON m.y = p.j GROUP BY vec_id, p.i, m.x),
across AS (SELECT vec_id, any_value(label) AS label, y, p.i AS x, SUM(v * g) AS v FROM down JOIN places p ON down.x = p.j GROUP BY vec_id, y, p.i),
s AS (SELECT vec_id, any_value(label) AS label, MAX(v) AS score, MIN(v) AS low, AVG(v) AS mean FROM across GROUP BY vec_id),
t AS (SELECT MAX(score) AS t FROM s WHERE label = 0)
SELECT vec_id, label, ROUND(score, 9) AS score, CASE WHEN score >= t - 1e-12 THEN 'NG' ELSE 'OK' END AS verdict,
       ROUND((mean - low) / CASE WHEN score > low THEN score - low ELSE 1.0 END * 255.0, 6) AS heat_mean FROM s, t""")
def q_map_anomaly(spark, sf_dir):
    """G8-G13 on the embeddings as 8 x 8 maps: mean, error map, smoothing,
    maximum, verdict and rescaled map (its mean is returned)."""
    emb = v.table(spark, sf_dir, "embeddings")
    out = im.map_anomaly(emb, "vec_id", "embedding", "label", size=8)
    return out.select("vec_id", "label", F.round("score", 9).alias("score"), "verdict",
                      F.round(F.aggregate("heatmap", F.lit(0.0), lambda a, x: a + x) / 64.0, 6).alias("heat_mean"))


@register("q_map_resize", """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS m FROM embeddings),
raw AS (SELECT size, o, i, greatest(1 - abs((i + 0.5 - (o + 0.5) * 8 / size) / greatest(8 / size, 1.0)), 0) AS w
        FROM (SELECT unnest([12.0, 5.0]) AS size) s, range(12) a(o), range(8) b(i) WHERE o < size),
t AS (SELECT size, o, i, w / SUM(w) OVER (PARTITION BY size, o) AS w FROM raw),
cells AS (SELECT vec_id, unnest(m) AS v, generate_subscripts(m, 1) - 1 AS pos FROM e),
down AS (SELECT vec_id, t.o AS y, pos % 8 AS x, SUM(v * w) AS v FROM cells JOIN t ON t.size = 12 AND t.i = pos // 8 AND w > 0 GROUP BY vec_id, t.o, pos % 8),
across AS (SELECT vec_id, y, t.o AS x, SUM(v * w) AS v FROM down JOIN t ON t.size = 5 AND t.i = x AND w > 0 GROUP BY vec_id, y, t.o)
SELECT vec_id, CAST(y * 5 + x AS INTEGER) AS cell, ROUND(v, 9) AS v FROM across""")
def q_map_resize(spark, sf_dir):
    """the embeddings as 8 x 8 maps, resampled to 12 rows of 5."""
    emb = v.table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("m"))
    out = im.resize_maps(emb, "m", 8, 8, 12, 5)
    return out.select("vec_id", F.posexplode("resized").alias("cell", "v")).select("vec_id", "cell", F.round("v", 9).alias("v"))


@register("q_history_table", """
WITH t AS (SELECT event_id, user_id AS machine_id, ts, value,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rk,
                  MAX(ts) OVER (PARTITION BY user_id) AS newest FROM events)
SELECT event_id, machine_id, ts, value FROM t WHERE rk <= 10 AND ts >= newest - INTERVAL 3 DAY""")
def q_history_table(spark, sf_dir):
    """I4 as a table: two landings, each followed by an incremental compaction; the
    table read back equals the retention of all rows."""
    ev = v.table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("machine_id"), "ts", "value")
    table = HistoryTable(spark, _scratch(spark, "history"), "machine_id", "ts", 10, "3 days", "event_id")
    table.add(ev.where(F.col("event_id") % 3 != 0))
    table.add(ev.where(F.col("event_id") % 3 == 0))
    return table.read().select("event_id", "machine_id", "ts", "value")


@register("q_constant_column", "SELECT event_id, event_type, 'line-1' AS site FROM events")
def q_constant_column(spark, sf_dir):
    """A constant column on every row."""
    ev = v.table(spark, sf_dir, "events").select("event_id", "event_type")
    return cl.with_constant(ev, "site", "line-1")


def _scratch(spark, name: str) -> str:
    """A folder of this run below the shared checkpoint folder."""
    import uuid

    from ..session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@register("q_csv_round_trip", """
SELECT event_id, event_type, CASE WHEN event_id % 11 = 3 THEN NULL ELSE value END AS value FROM events""")
def q_csv_round_trip(spark, sf_dir):
    """A1 + A2 + A3: write a CSV with missing tokens and NaN, read it back with a
    declared schema; missing marks become NULL."""
    from ..sources import io
    ev = v.table(spark, sf_dir, "events").select("event_id", "event_type", F.when(F.col("event_id") % 11 == 3, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))
    path = _scratch(spark, "csv")
    io.write_table(ev, path, "csv")
    return io.read_table(spark, path, "event_id long, event_type string, value double")


@register("q_write_splits", """
SELECT event_id, value, CASE WHEN event_id % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM events""")
def q_write_splits(spark, sf_dir):
    """Rows persisted by split, read back with the split as partition column."""
    from ..sources import io
    ev = v.table(spark, sf_dir, "events").select("event_id", "value", F.when(F.col("event_id") % 5 == 0, "test").otherwise("train").alias("split"))
    path = _scratch(spark, "splits")
    io.write_splits(ev, path)
    return spark.read.parquet(path).select("event_id", "value", F.col("split").cast("string").alias("split"))


@register("q_metrics_sink", """
SELECT CAST(COUNT(*) AS DOUBLE) AS n, ROUND(AVG(value), 6) AS mean, MIN(value) AS low, MAX(value) AS high FROM events""")
def q_metrics_sink(spark, sf_dir):
    """A one-row metric record written as JSON and read back."""
    from ..sources import io
    r = v.table(spark, sf_dir, "events").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.min("value").alias("low"), F.max("value").alias("high")).first()
    path = _scratch(spark, "metrics")
    io.write_metrics(io.metrics_row(spark, **r.asDict()), path)
    return spark.read.schema("n double, mean double, low double, high double").json(path)

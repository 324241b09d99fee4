"""Structured Streaming versions of the telemetry pipeline.

* ``sensor_stream`` reads arriving parquet files with a declared schema (a
  Kafka topic in production uses the same downstream code).
* ``land_raw`` appends the raw feed to a date-partitioned landing table.
* ``clean_stream`` keeps the first reading of each (machine, ts) with a
  streaming ``min_by`` aggregation (JVM, state evicted by the watermark);
  the row rules of the batch cleanse run on the first row of every key
  (minimum over the appended versions, so a late row cannot displace it).
* ``change_stream`` delivers a reading only when its value changed; the
  state is the last value per machine.
* ``quality_stream`` computes windowed quality indicators with a watermark.
* ``latest_stream`` keeps the newest reading per machine (update mode).
Every sink writes to a folder under the shared checkpoint directory with its
own checkpoint location, so a restarted query resumes exactly once.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators import cleansing as cl
from ..session import ensure_checkpoint_dir


def _is_dir(spark: SparkSession, path: str) -> bool:
    """Ask the Hadoop file system (local, HDFS or an object store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(p).isDirectory()


def sensor_stream(spark: SparkSession, source_dir: str, name: str, schema: T.StructType | None = None,
                  files_per_trigger: int | None = None) -> DataFrame:
    """Stream the table ``name.parquet`` of ``source_dir``: a folder of
    part files arriving over time, or a single file in the folder."""
    path = f"{source_dir.rstrip('/')}/{name}.parquet"
    if schema is None:
        schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    if _is_dir(spark, path):
        return r.parquet(path)
    return r.option("pathGlobFilter", f"{name}.parquet").parquet(source_dir)


def stream_dir(spark: SparkSession, name: str) -> str:
    """A fresh output folder (and checkpoint) under the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:12]}"


def run_to_table(df: DataFrame, name: str, partition_by: list[str] | None = None,
                 output_mode: str = "append") -> str:
    """Run a streaming frame over everything available, into parquet; return the path."""
    path = stream_dir(df.sparkSession, name)
    w = (df.writeStream.format("parquet").outputMode(output_mode)
         .option("checkpointLocation", f"{path}/_checkpoint").trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start(f"{path}/data")
    q.awaitTermination()
    return f"{path}/data"


def run_batches(df: DataFrame, name: str, fn: Callable[[DataFrame, int, str], None],
                output_mode: str = "update") -> str:
    """Run with ``foreachBatch``; ``fn(batch_df, batch_id, out_path)``."""
    path = stream_dir(df.sparkSession, name)
    out = f"{path}/data"
    q = (df.writeStream.outputMode(output_mode).option("checkpointLocation", f"{path}/_checkpoint")
         .foreachBatch(lambda b, i: fn(b, i, out)).trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def event_time(spark: SparkSession, ts: str):
    """The instant whose UTC wall time is the ``timestamp_ntz`` value, for
    watermarks and windows.  Independent of the session time zone (a plain
    cast would read the wall time in the session zone, and DST overlaps could
    map two readings to one instant)."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), F.col(ts)).cast("timestamp")


def utc_wall(spark: SparkSession, instant):
    """Inverse of ``event_time``: the UTC wall time of an instant, as ntz."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), instant.cast("timestamp_ntz"))


def land_raw(stream: DataFrame, ts: str = "ts", name: str = "landing") -> str:
    """A4: persist the raw feed before any cleansing, partitioned by date."""
    return run_to_table(stream.withColumn("date", F.to_date(F.col(ts))), name, ["date"])


def keep_first_stream(stream: DataFrame, keys: list[str], order_col: str, ts: str,
                      delay: str = "1 hour") -> DataFrame:
    """I7 (dedupe part) as a JVM streaming aggregation: per key the row with
    the smallest ``order_col`` seen so far (``min_by``, combined map-side).
    The event time is part of the key, so the watermark evicts the state.
    Run it in update mode; each micro-batch emits the keys whose first row
    changed, and ``read_first`` gives the first row of every key."""
    w = stream.withColumn("_event_ts", event_time(stream.sparkSession, ts)).withWatermark("_event_ts", delay)
    payload = [c for c in stream.columns if c not in keys]
    return (w.groupBy(*keys, "_event_ts")
            .agg(F.min_by(F.struct(*[F.col(c) for c in payload]), F.col(order_col)).alias("_row"))
            .select(*keys, "_row.*"))


def clean_stream(stream: DataFrame, limits: dict, rule, label: str = "status_label",
                 keys: tuple = ("machine_id", "ts"), order_col: str = "seq") -> str:
    """NaN -> NULL and keep-first per (machine, ts) run as a stream whose
    versions land in a table; returns the table path.  ``clean_table``
    applies the row rules (drop missing, range, round half-even, label) to
    the current first row of every key."""
    first = keep_first_stream(cl.na_normalise(stream), list(keys), order_col, "ts")
    return run_batches(first, "first_rows", write_latest_per_key(list(keys)))


def clean_table(spark: SparkSession, path: str, limits: dict, rule, label: str = "status_label",
                keys: tuple = ("machine_id", "ts"), order_col: str = "seq") -> DataFrame:
    first = read_first(spark, path, list(keys), order_col)
    kept = cl.keep_in_range(cl.drop_missing(first), limits)
    rounded = cl.round_columns(kept, list(limits), 2)
    return cl.label_by_rule(rounded, rule, label)


def _change_fn(order: list[str], value: str):
    def fn(key, batches, state):
        parts = [b for b in batches if not b.empty]
        if not parts:
            return
        pdf = pd.concat(parts, ignore_index=True).sort_values(order, kind="mergesort")
        vals = [None if pd.isna(x) else x for x in pdf[value].tolist()]  # pandas reads NULL numbers as NaN
        prev = [state.get[0] if state.exists else None] + vals[:-1]
        first_ever = [not state.exists] + [False] * (len(vals) - 1)
        changed = [f or a != b for f, a, b in zip(first_ever, vals, prev)]
        state.update((vals[-1],))
        out = pdf.assign(prev_value=prev)[changed]
        if not out.empty:
            yield out
    return fn


def change_stream(stream: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """I1 (stream): deliver a reading only when its value differs from the
    previous reading of the same key (first reading included); missing readings
    (NULL, NaN) are one value, delivered as NULL."""
    schema = T.StructType(stream.schema.fields + [T.StructField("prev_value", stream.schema[value].dataType)])
    state = T.StructType([T.StructField("last", stream.schema[value].dataType)])
    return stream.groupBy(key).applyInPandasWithState(
        _change_fn(order, value), schema, state, "append", GroupStateTimeout.NoTimeout)


def quality_stream(stream: DataFrame, ts: str, limits: dict, window: str = "1 day",
                   delay: str = "1 hour") -> DataFrame:
    """I8: per event-time window: rows, largest missing share, share of
    present values outside their closed range.  The watermark bounds the
    state: windows that end before it are evicted.  Rows within ``delay`` are
    always counted; Spark does not promise to drop rows beyond it (in update
    mode they may re-open an evicted window), so readers needing a hard cut
    filter on the window end."""
    spark = stream.sparkSession
    w = stream.withColumn("_event_ts", event_time(spark, ts)).withWatermark("_event_ts", delay)
    invalid = None
    for c, (lo, hi) in limits.items():
        t = ~F.col(c).between(lo, hi) & F.col(c).isNotNull()
        invalid = t if invalid is None else invalid | t
    miss = [F.avg(F.col(c).isNull().cast("double")) for c in limits]
    return (w.groupBy(F.window("_event_ts", window).alias("w"))
            .agg(F.count("*").alias("n_rows"),
                 (F.greatest(*miss) if len(miss) > 1 else miss[0]).alias("missing_ratio"),
                 F.avg(F.coalesce(invalid, F.lit(False)).cast("double")).alias("validity_ratio"))
            .select(utc_wall(spark, F.col("w.start")).alias("window_start"), "n_rows",
                    "missing_ratio", "validity_ratio"))


def write_latest_per_key(keys: list[str]):
    """foreachBatch writer for update-mode aggregates: append each batch with
    its id; readers take the newest version of every key."""
    def fn(batch: DataFrame, batch_id: int, out: str):
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("append").parquet(out)
    return fn


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    df = spark.read.parquet(path)
    cols = [c for c in df.columns if c not in keys and c != "_batch"]
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col("_batch")).alias("_v"))
            .select(*keys, "_v.*"))


def latest_stream(stream: DataFrame, key: str, ts: str, value: str, tiebreak: str | None = None) -> DataFrame:
    """I6 (stream): newest reading per key as an update-mode aggregation
    (state: one row per key, machine-count sized)."""
    order = F.struct(F.col(ts), F.col(tiebreak)) if tiebreak else F.col(ts)
    return stream.groupBy(key).agg(F.max_by(value, order).alias(value), F.max(ts).alias(ts))


def read_first(spark: SparkSession, path: str, keys: list[str], order_col: str) -> DataFrame:
    """Keep-first versions -> the first row per key: the smallest
    ``order_col`` over all versions, which stays right even when a late row
    re-opened a key whose state the watermark had already evicted."""
    df = spark.read.parquet(path)
    cols = [c for c in df.columns if c not in keys and c != "_batch"]
    return (df.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.col(order_col)).alias("_v"))
            .select(*keys, "_v.*"))


def score_stream(stream: DataFrame, model) -> DataFrame:
    """Apply a fitted ``PipelineModel`` to a live feed (micro-batches,
    no per-record driver code)."""
    return model.transform(stream)

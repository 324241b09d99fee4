"""Value changes of a stream whose rows arrive out of order.

The stream is held as time chunks: per key and chunk the readings so far, one streaming
aggregation on the JVM whose state the watermark evicts.  A key with a third of all rows
is many chunks.  Each micro-batch appends the chunks it changed; readers merge a chunk's
versions, so a late row is linked into its place, and rows after it get a new previous
value.  Between chunks the link is the last value of the chunk before, one row per chunk."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .pipelines import event_time


def reading_chunks(stream: DataFrame, key: str, ts: str, order: Sequence[str], chunk: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """(key, start, readings) per key and chunk, in update mode; rows later than
    ``delay`` may be dropped, as with every watermark.  ``order`` begins with ``ts``
    and tells a key's rows apart."""
    rest = [c for c in stream.columns if c != key and c not in order]
    timed = stream.withColumn("_event_ts", event_time(stream.sparkSession, ts)).withWatermark("_event_ts", delay)
    told = timed.groupBy(key, F.window("_event_ts", chunk).alias("w")).agg(F.collect_list(F.struct(*order, *rest)).alias("readings"))
    return told.select(key, F.col("w.start").alias("start"), "readings")


def changes(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """The readings whose value differs from the one before (NULL and NaN are values;
    a key's first reading counts), with ``prev_value``."""
    versions = spark.read.parquet(path)
    chunks = versions.groupBy(key, "start").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("readings")))).alias("readings"))  # versions of one chunk
    before = Window.partitionBy(key).orderBy("start")  # one row per chunk
    linked = chunks.withColumn("_before", F.lag(F.struct(F.element_at("readings", -1)[value].alias("value"))).over(before))
    each = linked.select(key, "_before", "readings", F.posexplode("readings").alias("_i", "_r"))
    prev = F.when(F.col("_i") > 0, F.get("readings", F.col("_i") - 1)[value]).otherwise(F.col("_before.value"))
    first = (F.col("_i") == 0) & F.col("_before").isNull()
    told = each.select(key, "_r.*", prev.alias("prev_value"), first.alias("_first"))
    return told.where(F.col("_first") | ~F.col(value).eqNullSafe(F.col("prev_value"))).drop("_first")

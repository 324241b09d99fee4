"""Distributed ordinals and running totals.

A plain ``row_number() over (partition by key order by t)`` sends every row of
a key to one task, and a window without ``partitionBy`` sends the whole table
to one task.  Both fail when one key holds a third of the data.  Here rows are
range-partitioned on (key, order), so a hot key spreads over many partitions;
each partition numbers its rows locally and a small per-(partition, key)
table (at most partitions + keys rows) supplies the offsets.

The locally numbered table is checkpointed to the shared checkpoint folder:
partition ids and in-partition positions must not be recomputed differently
after an executor loss.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .joins import join_on_keys

BROADCAST_ROWS = 2_000_000  # offsets and boundary tables at most this long are broadcast


def _n_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _materialise(df: DataFrame) -> DataFrame:
    """Persist, then checkpoint (reliable, cuts lineage), then drop the cache."""
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def join_small(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Attach a small table (NULL-safe on the keys); broadcast only below a checked size."""
    n = small.count()
    return join_on_keys(big, small, on, how, broadcast_right=n <= BROADCAST_ROWS)


def with_ordinal(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                 name: str = "ordinal", partitions: int | None = None) -> DataFrame:
    """Add a 0-based ordinal of each row within its key, in ``order``.

    ``order`` must make rows unique within a key (add an id as tiebreaker)."""
    keys = list(keys)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    n = partitions or _n_partitions(df)
    ranged = (df.repartitionByRange(n, *[F.col(k) for k in keys], *order_cols)
              .sortWithinPartitions(*[F.col(k) for k in keys], *order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()))
    ranged = _materialise(ranged)
    per_part = (ranged.groupBy("_pid", *keys)
                .agg(F.count("*").alias("_cnt"), F.min("_pos").alias("_first")))
    w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0))).drop("_cnt")
    out = join_small(ranged, offsets, ["_pid", *keys])
    return (out.withColumn(name, F.col("_off") + F.col("_pos") - F.col("_first"))
            .drop("_pid", "_pos", "_first", "_off"))


def running_totals(df: DataFrame, order: Sequence[str | Column], sums: Sequence[str],
                   prefix: str = "cum_", partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``sums`` over a global order (rows unique in it).

    Range partitioning spreads the order over all tasks; per-partition totals
    (one row per partition, a proven bound) are broadcast as offsets."""
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    n = partitions or _n_partitions(df)
    ranged = df.repartitionByRange(n, *order_cols).withColumn("_pid", F.spark_partition_id())
    ranged = _materialise(ranged)
    totals = ranged.groupBy("_pid").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    wt = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # <= n rows
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_t_{s}").over(wt), F.lit(0)).alias(f"_o_{s}")
                                      for s in sums])
    wl = Window.partitionBy("_pid").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("*", *[F.sum(s).over(wl).alias(f"_l_{s}") for s in sums])
    out = local.join(F.broadcast(offsets), "_pid")
    for s in sums:
        out = out.withColumn(f"{prefix}{s}", F.col(f"_l_{s}") + F.col(f"_o_{s}"))
    return out.drop("_pid", *[f"_l_{s}" for s in sums], *[f"_o_{s}" for s in sums])

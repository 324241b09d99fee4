"""Null-safe equi-joins.

``groupBy`` treats NULL as a key value, but a plain equi-join drops rows
whose key is NULL.  Joins that attach per-key metadata back to the rows
use ``<=>`` so a NULL key keeps its rows."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
                 broadcast_right: bool = False) -> DataFrame:
    """Join on ``keys`` with NULL-safe equality; the key columns appear once."""
    keys = list(keys)
    r = right.select(*[F.col(c).alias(f"_jk_{c}") if c in keys else F.col(c) for c in right.columns])
    if broadcast_right:
        r = F.broadcast(r)
    cond = None
    for c in keys:
        t = left[c].eqNullSafe(r[f"_jk_{c}"])
        cond = t if cond is None else cond & t
    return left.join(r, cond, how).drop(*[f"_jk_{c}" for c in keys])


HOT_ROWS, HOT_KEYS = 100_000, 1_000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` left-joined with the one row that ``groups`` has of each key; its
    column ``size`` is how many rows join the key.  NULL keys match nothing.

    A key is hot when it joins more than HOT_ROWS rows and more than the HOT_KEYS-th
    part of all: at most HOT_KEYS keys are, which are broadcast while their rows stay
    where they are dealt; the others meet in one shuffle by key."""
    ensure_checkpoint_dir(rows.sparkSession)
    names = [c for c in groups.columns if c not in (key, size)]
    groups = groups.checkpoint()
    total = groups.agg(F.sum(size)).first()[0] or 0
    least = max(HOT_ROWS, total // HOT_KEYS)
    value = F.struct(*names)
    hot = groups.where(F.col(size) > least).select(F.col(key).alias("_hot"), value.alias("_hot_value"))
    cold = groups.where(F.col(size) <= least).select(F.col(key).alias("_cold"), F.lit(0).cast("long").alias("_zero"), value.alias("_cold_value"))
    alone = F.col("_hot").isNotNull() | F.col(key).isNull()
    found = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn("_by", F.when(alone, F.monotonically_increasing_id() + 1).otherwise(0))
    found = found.join(cold, (F.col(key) == F.col("_cold")) & (F.col("_by") == F.col("_zero")), "left")
    return found.select(*rows.columns, *[F.coalesce(F.col(f"_hot_value.{c}"), F.col(f"_cold_value.{c}")).alias(c) for c in names])

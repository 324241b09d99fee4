"""Duplicate counting and keep-first deduplication.

Keep-first is an aggregation, not a window: ``min_by(row, order)`` per key is
combined map-side, so a key holding a third of the table is reduced to one
candidate per input partition before the shuffle.  A window
``row_number() over (partition by key)`` would instead sort the whole hot key
in one task.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("_n"))


def duplicate_count(df: DataFrame, keys: Sequence[str], mode: str = "members") -> DataFrame:
    """D1/D2 as a one-row DataFrame ``(n_rows, duplicates, ratio)``.

    ``members``: every row of a repeated key counts (keep=False);
    ``excess``: only the rows beyond the first (default ``duplicated()``)."""
    kc = key_counts(df, keys)
    if mode == "members":
        dup = F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(F.lit(0)))
    elif mode == "excess":
        dup = F.sum(F.col("_n") - 1)
    else:
        raise ValueError(mode)
    return (kc.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_rows"),
                   F.coalesce(dup, F.lit(0)).cast("long").alias("duplicates"))
            .withColumn("ratio", F.when(F.col("n_rows") > 0, F.col("duplicates") / F.col("n_rows"))))


FIXED_WIDTH = {"int", "bigint", "smallint", "tinyint", "double", "float", "boolean", "date",
               "timestamp", "timestamp_ntz"}


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None,
           unique_order: bool = False) -> DataFrame:
    """D3: keep the first row of each key in ``order_by`` order.

    Without ``order_by`` the key must be the full row (any copy is the same).
    With ``unique_order`` (one order column, unique within a key) and
    fixed-width columns, each column is taken by its own ``min_by`` -- the
    same row, but a hash aggregation with primitive buffers instead of a
    sort aggregation over a struct."""
    if not order_by:
        if set(keys) != set(df.columns):
            raise ValueError("keep-first needs an explicit order unless the key is the whole row")
        return df.dropDuplicates()
    cols = df.columns
    types = dict(df.dtypes)
    if (unique_order and len(order_by) == 1 and isinstance(order_by[0], str)
            and all(types[c] in FIXED_WIDTH for c in cols)):
        o = order_by[0]
        rest = [c for c in cols if c not in keys]
        picked = df.groupBy(*keys).agg(*[F.min_by(c, o).alias(c) for c in rest])
        return picked.select(*cols)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order_by]
    order_key = order_cols[0] if len(order_cols) == 1 else F.struct(*order_cols)
    payload = F.struct(*[F.col(c) for c in cols])
    picked = df.groupBy(*[F.col(k) for k in keys]).agg(F.min_by(payload, order_key).alias("_row"))
    return picked.select("_row.*")


def dedupe_wide(df: DataFrame, sensors: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """D3 for a key of hundreds of columns: group by a 64-bit hash of the
    sensor vector plus the vector itself (the hash only narrows the shuffle
    key; equality is still decided on the columns)."""
    hashed = df.withColumn("_h", F.xxhash64(*sensors))
    return dedupe(hashed, ["_h", *sensors], order_by).drop("_h")

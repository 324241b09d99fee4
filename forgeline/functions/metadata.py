"""Bounded driver collects.

The only rows that reach the driver are metadata: one per class, per
column, per dimension or per quantile target.  ``collect_bounded`` makes
that bound explicit -- it fetches at most ``limit + 1`` rows and fails
loudly instead of pulling an unexpectedly large result."""
from __future__ import annotations

from pyspark.sql import DataFrame, Row

CLASS_LIMIT = 10_000      # distinct labels / classes
DIM_LIMIT = 100_000       # vector dimensions, columns


def collect_bounded(df: DataFrame, limit: int, what: str) -> list[Row]:
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows; this is metadata and must stay small")
    return rows


def class_counts(df: DataFrame, label: str) -> dict:
    """{class: rows} -- one aggregation, at most CLASS_LIMIT classes."""
    return {r[label]: r["count"] for r in collect_bounded(df.groupBy(label).count(), CLASS_LIMIT, f"classes of {label}")}

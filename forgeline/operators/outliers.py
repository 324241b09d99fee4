"""IQR fences, outlier cells and clipping.

Quartiles are exact (linear interpolation) and come from the distributed
selection in ``functions.quantiles``; the fences are a per-column table that
is broadcast back to the rows (C1), never the other way round.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import any_of
from ..functions.quantiles import exact_quantiles, unpivot
from .cleansing import clip_columns


def iqr_fences(df: DataFrame, cols: Sequence[str], k: float = 3.0) -> DataFrame:
    """Per column q1, q3, iqr, lower = q1 - k*iqr, upper = q3 + k*iqr."""
    q = exact_quantiles(unpivot(df, cols), ["sensor"], "value", [0.25, 0.75])
    piv = (q.groupBy("sensor")
           .agg(F.max(F.when(F.col("prob") == 0.25, F.col("quantile"))).alias("q1"),
                F.max(F.when(F.col("prob") == 0.75, F.col("quantile"))).alias("q3")))
    return (piv.withColumn("iqr", F.col("q3") - F.col("q1"))
            .withColumn("lower", F.col("q1") - F.lit(k) * F.col("iqr"))
            .withColumn("upper", F.col("q3") + F.lit(k) * F.col("iqr"))
            .withColumnRenamed("sensor", "column"))


def fences_dict(fences: DataFrame) -> dict[str, tuple[float, float]]:
    """Collect the fence table (one row per column: bounded metadata)."""
    return {r["column"]: (r["lower"], r["upper"]) for r in fences.collect()}  # one row per column


def outlier_cells(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Per column (column, outliers, cells, outlier_rate) in one pass."""
    aggs = []
    for c, (lo, hi) in bounds.items():
        hit = ((F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi)))
        aggs.append(F.struct(F.lit(c).alias("column"),
                             F.coalesce(F.sum(F.coalesce(hit, F.lit(False)).cast("long")), F.lit(0)).alias("outliers"),
                             F.count("*").alias("cells")).alias(c))
    wide = df.agg(*aggs)
    out = wide.select(F.explode(F.array(*[F.col(c) for c in bounds])).alias("s")).select("s.*")
    return out.withColumn("outlier_rate", F.when(F.col("cells") > 0, F.col("outliers") / F.col("cells")))


def outlier_row_flag(bounds: Mapping[str, tuple[float, float]]):
    return any_of([(F.col(c) < lo) | (F.col(c) > hi) for c, (lo, hi) in bounds.items()])


def clip_outliers(df: DataFrame, cols: Sequence[str], k: float = 3.0) -> tuple[DataFrame, DataFrame]:
    """D7 + B15: fit fences on ``df`` and clip to them; returns (clipped, fences)."""
    fences = iqr_fences(df, cols, k)
    return clip_columns(df, fences_dict(fences)), fences

"""Reconstruction by a low-rank subspace of the normal rows.

The normal rows' mean and covariance come from one scan; the leading eigenvectors span
the subspace.  A row is reconstructed as the mean plus its projection, and its error is
the mean squared difference.  Rank 0 is the mean alone."""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.moments import vector_moments


@dataclass
class Subspace:
    mean: np.ndarray
    axes: np.ndarray  # one per row, orthonormal
    kept: float  # share of the variance inside


def fit_subspace(normal: DataFrame, col: str, width: int, rank: int) -> Subspace:
    """Mean and ``rank`` principal axes of vectors of ``width`` present numbers; rows
    with other vectors take no part."""
    x = F.col(col).cast("array<double>")
    usable = normal.select(x.alias("v")).where((F.size("v") == width) & F.forall("v", lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf"))))
    m = vector_moments(usable, "v", width)
    if m is None:
        raise ValueError("no usable normal row")
    values, axes = np.linalg.eigh(m.products / m.n)
    values, axes = values[::-1], axes.T[::-1]
    total = float(values.sum())
    return Subspace(m.mean, axes[:rank].copy(), float(values[:rank].sum()) / total if total > 0 else 1.0)


def reconstruction_error(df: DataFrame, col: str, model: Subspace, name: str = "error") -> DataFrame:
    """Adds the mean squared distance to the subspace; NULL for unusable vectors."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # rank x width numbers

    @F.pandas_udf("double")
    def run(rows: pd.Series) -> pd.Series:
        m = shared.value
        out = np.full(len(rows), np.nan)
        arrays = [None if r is None else np.asarray(r, np.float64) for r in rows]
        some = [i for i, r in enumerate(arrays) if r is not None and len(r) == len(m.mean) and np.isfinite(r).all()]
        if some:
            x = np.stack([arrays[i] for i in some]) - m.mean
            out[some] = ((x - (x @ m.axes.T) @ m.axes) ** 2).mean(1)
        return pd.Series(out)

    return df.withColumn(name, F.nanvl(run(F.col(col)), F.lit(None).cast("double")))


__all__ = ["Subspace", "fit_subspace", "reconstruction_error"]

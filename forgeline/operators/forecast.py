"""Window forecaster by one Gram matrix.

Every target step of every feature is a ridge regression on the same input steps, so
all of them come from one table of co-moments: one scan of the training windows, then
one solve of a small system on the driver (inputs by inputs, whatever the rows)."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.moments import vector_moments


@dataclass
class Forecaster:
    """target = mean_y + (input - mean_x) @ weights; both flattened step by step."""
    cols: tuple[str, ...]
    steps: tuple[int, ...]
    horizon: int
    mean_x: np.ndarray
    mean_y: np.ndarray
    weights: np.ndarray


def flat(arr: str, cols: Sequence[str], steps: Sequence[int] | None = None) -> Column:
    """A window array of step structs as one array of numbers, step by step; only
    the given steps if any."""
    told = F.transform(F.col(arr), lambda s: F.array(*[s[c].cast("double") for c in cols]))
    return F.flatten(told if steps is None else F.array(*[F.get(told, F.lit(i)) for i in steps]))


def fit_forecaster(windows: DataFrame, cols: Sequence[str], length: int, horizon: int, steps: Sequence[int] | None = None, ridge: float = 0.0) -> Forecaster:
    """Fitted on windows without missing numbers.  ``steps``: the input steps
    used (from 0; default all ``length``).  ``ridge`` is added to the diagonal of the
    inputs' co-moments; inputs that depend on others share their weight."""
    cols, steps = tuple(cols), tuple(range(length) if steps is None else steps)
    p, q = len(steps) * len(cols), horizon * len(cols)
    both = windows.select(F.concat(flat("input", cols, steps), flat("target", cols)).alias("z"))
    both = both.where(F.forall("z", lambda x: x.isNotNull() & ~F.isnan(x)) & (F.size("z") == p + q))
    m = vector_moments(both, "z", p + q)
    if m is None:
        raise ValueError("no window without missing numbers to fit the forecaster on")
    weights = np.linalg.lstsq(m.products[:p, :p] + ridge * np.eye(p), m.products[:p, p:], rcond=1e-12)[0]
    return Forecaster(cols, steps, horizon, m.mean[:p], m.mean[p:], weights)


def forecast(windows: DataFrame, model: Forecaster, name: str = "forecast") -> DataFrame:
    """Adds the forecast of all target steps, flattened; NULL where an input is
    missing."""
    shared = windows.sparkSession.sparkContext.broadcast(model)  # inputs x targets numbers

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(inputs: pd.Series) -> pd.Series:
        m = shared.value
        out = pd.Series([None] * len(inputs), dtype=object)
        some = [i for i, x in enumerate(inputs) if x is not None and len(x) == len(m.mean_x) and not np.isnan(np.asarray(x, np.float64)).any()]
        if some:
            x = np.stack([np.asarray(inputs.iloc[i], np.float64) for i in some])
            for i, y in zip(some, m.mean_y + (x - m.mean_x) @ m.weights, strict=True):
                out.iloc[i] = y
        return out

    return windows.withColumn(name, run(flat("input", model.cols, model.steps)))


def step_errors(windows: DataFrame, model: Forecaster, forecast_col: str = "forecast", last: str = "error", every: str = "error_all") -> DataFrame:
    """``last``: mean squared error over the features at the last target step;
    ``every``: over all target steps."""
    squares = F.transform(F.arrays_zip(flat("target", model.cols).alias("a"), F.col(forecast_col).alias("b")), lambda z: F.pow(z["a"] - z["b"], 2))
    c = len(model.cols)
    mean = lambda x, n: F.aggregate(x, F.lit(0.0), lambda a, v: a + v) / F.lit(float(n))
    told = windows.withColumn("_squares", F.when(F.col(forecast_col).isNotNull(), squares))
    return told.withColumn(last, mean(F.slice("_squares", F.lit((model.horizon - 1) * c + 1), F.lit(c)), c)).withColumn(every, mean(F.col("_squares"), model.horizon * c)).drop("_squares")


__all__ = ["Forecaster", "fit_forecaster", "forecast", "step_errors"]

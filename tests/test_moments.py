"""Sums of products in one scan, and what is built on them, against numpy/pandas."""
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from forgeline.functions import moments as mm
from forgeline.operators import forecast as fo
from forgeline.operators import profiling as pr
from forgeline.operators import subspace as su


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(mm, "BLOCK_ROWS", 16)
    monkeypatch.setattr(mm, "GROUP", 2)


def test_moments_are_stable_about_large_means(spark, small_blocks):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (700, 3)) @ rng.normal(0, 1, (3, 3)) + [1e9, -1e8, 0]
    m = mm.moments(spark.createDataFrame(pd.DataFrame(x, columns=list("abc"))).repartition(6), list("abc"))
    assert m.n == 700 and np.allclose(m.mean, x.mean(0), rtol=1e-13)
    assert np.allclose(m.products / 700, np.cov(x.T, bias=True), rtol=1e-6, atol=1e-6)
    assert mm.moments(spark.createDataFrame([], "a double"), ["a"]) is None


def test_correlation_leaves_out_missing_pairs(spark, small_blocks):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(0, 1, (300, 6)), columns=list("abcdef"))
    pdf["b"] = pdf["a"] * 2 + 1e7
    pdf["e"] = 5.0
    pdf = pdf.mask(rng.random(pdf.shape) < 0.2)
    pdf["f"] = np.nan
    want = pdf.corr()
    for r in pr.correlation_matrix(spark.createDataFrame(pdf).repartition(5), list("abcdef")).collect():
        a, b = r["col_a"], r["col_b"]
        w = 1.0 if a == b else want.loc[a, b]
        assert (r["corr"] is None and np.isnan(w)) or abs(r["corr"] - w) < 1e-6, (a, b)


def test_correlation_plan_does_not_grow_with_the_columns(spark):
    wide = spark.range(50).select(*[(F.col("id") * (i % 7 + 1) % 11).alias(f"c{i}") for i in range(520)])
    assert pr.correlation_matrix(wide, wide.columns).count() == 520 * 520


def windows_of(spark, x, length, horizon, gap=1):
    rows, span = [], length + gap + horizon
    for i in range(len(x) - span):
        step = lambda a: [tuple(map(float, r)) for r in a]
        rows.append((i, step(x[i:i + length]), step(x[i + length + gap:i + span])))
    s = "array<struct<a:double,b:double>>"
    return spark.createDataFrame(rows, f"i long, input {s}, target {s}")


@pytest.mark.parametrize("steps", [None, [0, 3]])
def test_forecaster_equals_least_squares(spark, steps):
    rng = np.random.default_rng(3)
    x = np.cumsum(rng.normal(0, 1, (150, 2)), 0) + 100
    w = windows_of(spark, x, 4, 3)
    model = fo.fit_forecaster(w, ["a", "b"], 4, 3, steps)
    got = {r["i"]: r for r in fo.step_errors(fo.forecast(w, model), model).collect()}
    use = range(4) if steps is None else steps
    n = len(got)
    inputs = np.array([np.concatenate([[1.0], *(x[i + s] for s in use)]) for i in range(n)])
    targets = np.array([x[i + 5:i + 8].ravel() for i in range(n)])
    fit = inputs @ np.linalg.lstsq(inputs, targets, rcond=None)[0]
    for i, r in got.items():
        assert np.allclose(r["forecast"], fit[i], atol=1e-6)
        sq = (fit[i] - targets[i]) ** 2
        assert math.isclose(r["error"], sq[-2:].mean(), abs_tol=1e-6) and math.isclose(r["error_all"], sq.mean(), abs_tol=1e-6)


def test_forecaster_missing_and_dependent_inputs(spark):
    x = np.arange(80.0)
    w = windows_of(spark, np.stack([x, 2 * x], 1), 4, 2)  # every input is a multiple of another
    gap = w.withColumn("input", F.when(F.col("i") == 3, F.transform("input", lambda s: F.struct(F.lit(None).cast("double").alias("a"), s["b"].alias("b")))).otherwise(F.col("input")))
    model = fo.fit_forecaster(gap, ["a", "b"], 4, 2)
    told = {r["i"]: r for r in fo.step_errors(fo.forecast(gap, model), model).collect()}
    assert told[3]["forecast"] is None and told[3]["error"] is None and told[3]["error_all"] is None
    assert all(r["error_all"] < 1e-12 for i, r in told.items() if i != 3)
    with pytest.raises(ValueError):
        fo.fit_forecaster(w.where("i < 0"), ["a", "b"], 4, 2)


def test_subspace_equals_svd_and_rank_zero_is_the_mean(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (200, 3)) @ rng.normal(0, 1, (3, 8)) + rng.normal(0, 0.01, (200, 8)) + 5
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)] + [(900, None), (901, [1.0]), (902, [float("nan")] * 8)], "i long, v array<double>")
    c = x - x.mean(0)
    _, s, vt = np.linalg.svd(c, full_matrices=False)
    for rank in (0, 2, 3, 8):
        model = su.fit_subspace(df, "v", 8, rank)
        got = {r["i"]: r["error"] for r in su.reconstruction_error(df, "v", model).collect()}
        want = ((c - c @ vt[:rank].T @ vt[:rank]) ** 2).mean(1)
        assert np.allclose([got[i] for i in range(200)], want, atol=1e-9) and got[900] is got[901] is got[902] is None
        # the errors add up to the variance outside the subspace
        assert math.isclose(sum(want) * 8, (s[rank:] ** 2).sum(), rel_tol=1e-9, abs_tol=1e-9) and math.isclose(model.kept, (s[:rank] ** 2).sum() / (s ** 2).sum(), abs_tol=1e-9)


def test_density_reaches_few_grid_points(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 1, 3000), [60.0, -40.0]])
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    got = {r["i"]: r for r in pr.density_curve(df, "x", 100).collect()}
    bw, grid = x.std(ddof=1) * len(x) ** -0.2, np.linspace(x.min(), x.max(), 100)
    want = np.exp(-0.5 * ((grid[:, None] - x) / bw) ** 2).sum(1) / (len(x) * bw * math.sqrt(2 * math.pi))
    assert sorted(got) == list(range(100)) and np.allclose([got[i]["density"] for i in range(100)], want, rtol=1e-9, atol=1e-15)
    reach = 2 * pr.KERNEL_REACH * bw / (grid[1] - grid[0]) + 2
    assert reach < 50  # grid points of a value, where there were 100

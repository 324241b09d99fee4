"""MDQI cascade against a direct pandas computation of the same steps."""
import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from forgeline.functions.quantiles import order_statistics, summarise
from forgeline.operators import quality
from forgeline.operators.quality import ColumnOrder, Run, WideCascade

S = ["s0", "s1", "s2", "s3", "s4"]


def fixture():
    rng = np.random.default_rng(3)
    n = 120
    d = {c: rng.normal(50, 10, n) for c in S}
    d["s2"][:] = 7.0                              # constant column
    d["s3"][: n // 2] = np.nan                    # exactly 50 % missing: kept
    d["s4"][: int(n * 0.6)] = np.nan              # above 50 %: dropped
    d["s0"][5] = np.inf
    d["s1"][6] = -np.inf
    d["s0"][7] = 10_000.0                         # beyond 3 IQR
    for c in ("s0", "s1", "s3"):
        d[c][10] = np.nan                         # sparse row
    pdf = pd.DataFrame(d)
    pdf["label"] = np.where(np.arange(n) % 2 == 0, 1, -1)
    pdf.loc[11, "label"] = 0
    pdf.loc[12, "label"] = np.nan
    pdf["seq"] = np.arange(n)
    dup = pdf.iloc[[20]].copy()
    dup["seq"] = 1000
    return pd.concat([pdf, dup], ignore_index=True)


def pandas_mdqi(df, S=S):
    qi = lambda n, e: (n - e) / n * 100 if n else 0.0
    n0, nc = len(df), len(S)
    sensors = list(S)
    e_uni = int(df.duplicated(subset=sensors, keep=False).sum())
    df = df.drop_duplicates(subset=sensors, keep="first")
    rate = df[sensors].isnull().mean()
    drop = rate[rate > 0.5].index.tolist()
    df = df.drop(columns=drop)
    sensors = [c for c in sensors if c not in drop]
    rr = df[sensors].isnull().mean(axis=1)
    e_rows = int((rr > 0.5).sum())
    df = df[~(rr > 0.5)]
    rem = int(df[sensors].isnull().sum().sum())
    df[sensors] = df[sensors].fillna(df[sensors].median())
    q_com = qi(n0 * nc, len(drop) * n0 + e_rows * len(sensors) + rem)
    e_inf = int(np.isinf(df[sensors].values).sum())
    df[sensors] = df[sensors].replace([np.inf, -np.inf], np.nan)
    df[sensors] = df[sensors].fillna(df[sensors].median())
    const = [c for c in sensors if df[c].min() == df[c].max()]
    df = df.drop(columns=const)
    sensors = [c for c in sensors if c not in const]
    q_val = qi(n0 * nc, e_inf + len(const) * n0)
    q1, q3 = df[sensors].quantile(0.25), df[sensors].quantile(0.75)
    lo, hi = q1 - 3 * (q3 - q1), q3 + 3 * (q3 - q1)
    e_con = int(((df[sensors] < lo) | (df[sensors] > hi)).values.sum())
    q_con = qi(df[sensors].size, e_con)
    bad = ~df["label"].isin([-1, 1]) | df["label"].isnull()
    q_acc = qi(n0, int(bad.sum()))
    q_uni = qi(n0, e_uni)
    return {"q_uni": q_uni, "q_com": q_com, "q_val": q_val, "q_con": q_con, "q_acc": q_acc,
            "mdqi": (q_uni + q_com + q_val + q_con + q_acc) / 5, "rows_final": int((~bad).sum())}


def test_mdqi_matches_pandas(spark):
    pdf = fixture()
    sdf = spark.createDataFrame(pdf.astype({"label": "float64"}))
    sdf = sdf.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in S + ["label"]}) \
             .withColumn("label", F.col("label").cast("int"))
    c = WideCascade(sdf, S, "label", ["seq"])
    got = c.score().first().asDict()
    exp = pandas_mdqi(pdf)
    for k, v in exp.items():
        assert abs(got[k] - v) < 1e-9, (k, got[k], v)
    assert c.dropped_columns() == ["s4"] and c.constant() == ["s2"]
    assert got["grade"] in {"S", "A", "B", "C"}


def test_mdqi_at_the_source_width(spark, tmp_path):
    """1,567 rows x 590 sensors from a CSV, as the source workload has them."""
    from forgeline.workflows import read_secom, secom_mdqi
    rng = np.random.default_rng(8)
    rows, width = 1567, 590
    x = np.round(rng.normal(10, 3, (rows, width)), 3)
    x[:, :116] = np.arange(116)                                   # constant sensors
    x[rng.random(x.shape) < 0.045] = np.nan
    x[: int(rows * 0.6), 560:] = np.nan                           # sparse sensors
    x[3, 130], x[4, 131], x[5, 132] = np.inf, -np.inf, 1e6
    x[9, 100:560] = np.nan                                        # sparse row
    x[20] = x[21]                                                 # repeated sensor vector
    names = [str(i) for i in range(width)]
    pdf = pd.DataFrame(x, columns=names)
    label = np.where(rng.random(rows) < 0.07, 1.0, -1.0)
    label[[30, 31]] = [0, np.nan]
    out = pdf.copy()
    out.insert(0, "Time", [f"t{i}" for i in range(rows)])
    out["Pass/Fail"] = pd.array(np.where(np.isnan(label), None, label), dtype="Int64")
    out.replace({np.inf: "Infinity", -np.inf: "-Infinity"}).to_csv(tmp_path / "secom.csv", index=False)
    score, clean = secom_mdqi(read_secom(spark, str(tmp_path / "secom.csv"), width))
    got = score.first().asDict()
    pdf["label"] = label
    want = pandas_mdqi(pdf, names)
    for k, v in want.items():
        assert abs(got[k] - v) < 1e-9, (k, got[k], v)
    assert clean.count() == want["rows_final"]


def interpolated(values, p):
    """The quantile as functions.quantiles has it: NaN is the largest value."""
    ordered = sorted(values, key=lambda v: (v != v, v))
    if not ordered:
        return None
    pos = p * (len(ordered) - 1)
    a, b = ordered[int(pos)], ordered[min(int(pos) + 1, len(ordered) - 1)]
    return a + (pos - int(pos)) * (b - a) if pos > int(pos) else a


def same(a, b):
    return a is b or a is not None and b is not None and (a == b or a != a and b != b)


def test_column_order_matches_the_repairs_one_after_another():
    """Median fill, infinities to NULL, median fill, quartiles: from ranks alone."""
    rng = random.Random(5)
    for _ in range(3000):
        finite = sorted(rng.choice([rng.randint(-3, 3) * 1.0, rng.gauss(0, 9), 1.5e308]) for _ in range(rng.choice([0, 1, 2, 5, 9])))
        minus, plus, nans, nulls = (rng.choice([0, 0, 1, 2, 6]) for _ in range(4))
        cells = [*finite, *[-math.inf] * minus, *[math.inf] * plus, *[math.nan] * nans]
        median = interpolated(cells, 0.5)
        cells += [median] * nulls if median is not None else []
        finite_cells = [v for v in cells if not math.isinf(v)]
        repair = interpolated(finite_cells, 0.5)
        lost = len(finite) + minus + plus + nans + nulls - len(finite_cells)
        repaired = finite_cells + ([repair] * lost if repair is not None else [])
        want = (median, repair, interpolated(repaired, 0.25), interpolated(repaired, 0.75))
        known = {}
        for turn in range(4):
            asked = set()
            order = ColumnOrder([Run(minus, value=-math.inf), Run(len(finite), first=0), Run(plus, value=math.inf), Run(nans, value=math.nan)], known, asked)
            m1, filled = order.median_filled(nulls)
            left = filled.without_infinities()
            m2, full = left.median_filled(len(finite) + minus + plus + nans + nulls - left.size())
            got = (m1, m2, full.quantile(0.25), full.quantile(0.75))
            if not asked:
                break
            known |= {k: finite[k] for k in asked}
        assert all(same(a, b) for a, b in zip(got, want)), (cells, got, want)


def test_cascade_finds_all_quantiles_in_two_passes(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(quality, "summarise", lambda *a: calls.append("counts") or summarise(*a))
    monkeypatch.setattr(quality, "order_statistics", lambda *a: calls.append("ranks") or order_statistics(*a))
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.normal(0, 5, (300, 3)), columns=["s0", "s1", "s2"])
    pdf.loc[3, "s0"], pdf.loc[4, "s1"], pdf.loc[5, "s2"] = np.inf, -np.inf, 900.0
    rows = [(i, *[None if rng.random() < 0.05 else float(v) for v in r], 1 if i % 2 else -1) for i, r in enumerate(pdf.itertuples(index=False))]
    c = WideCascade(spark.createDataFrame(rows, "seq int, s0 double, s1 double, s2 double, label int"), ["s0", "s1", "s2"], "label", ["seq"])
    bounds = c.bounds()
    c.release()
    assert calls == ["counts", "ranks"]
    want = pd.DataFrame([r[1:4] for r in rows if r[1:4].count(None) < 2], columns=["s0", "s1", "s2"], dtype=float)  # no sparse rows
    want = want.fillna(want.median()).replace([np.inf, -np.inf], np.nan)
    want = want.fillna(want.median())
    q1, q3 = want.quantile(0.25), want.quantile(0.75)
    for s, (lo, hi) in bounds.items():
        np.testing.assert_allclose((lo, hi), (q1[s] - 3 * (q3[s] - q1[s]), q3[s] + 3 * (q3[s] - q1[s])), rtol=1e-12)


def test_order_statistics_of_sketched_columns(spark):
    n = 4000
    df = spark.range(n).select(F.pmod(F.hash("id"), F.lit(9973)).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b"),
                               F.when(F.col("id") % 4 == 0, float("inf")).otherwise(F.col("id").cast("double")).alias("c"))
    pdf = df.toPandas().replace(np.inf, np.nan)
    for kw in ({"rank_limit": 50}, {"rank_limit": 20, "sketch_k": 8}):
        found = summarise(df, ["a", "b", "c"], **kw)
        wanted = {(c, k) for c in "abc" for k in (0, 700, 1500, 1501, 2250, 2999)}
        got = order_statistics(df, found, wanted, buckets=8, **kw)
        assert got == {(c, k): float(np.sort(pdf[c].dropna())[k]) for c, k in wanted}
        assert (found["c"].plus, found["c"].finite, found["a"].nulls) == (n // 4, n - n // 4, 0)


def test_sensor_array_is_dealt_before_it_is_widened(spark, tmp_path):
    from forgeline.plans import views
    rows = [(i, [float(i + j) for j in range(64)], i % 10) for i in range(40)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    wide = views.sensor_array(spark, str(tmp_path)).select("row_id", "c0")
    assert wide.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert wide.count() == 41  # id 7 has a copy

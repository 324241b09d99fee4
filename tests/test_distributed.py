"""The distributed building blocks against brute force, with one key
holding most rows (the skew case) and tiny buckets / chunks so every code
path (histogram passes, rank finish, halo copies) runs."""
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from forgeline.functions.ordinals import running_totals, with_ordinal
from forgeline.functions.quantiles import exact_quantiles
from forgeline.operators.history import top_k_per_key, value_changes
from forgeline.operators.sequences import sequence_windows


def skewed(spark, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 0.6, 0, rng.integers(1, 20, n))  # key 0 holds ~60 %
    val = np.round(rng.normal(10, 5, n), 1)  # many ties
    val[rng.random(n) < 0.05] = np.nan
    pdf = pd.DataFrame({"id": np.arange(n), "k": key.astype("int64"), "v": val})
    return pdf, spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))


def test_exact_quantiles_match_linear_interpolation(spark):
    pdf, df = skewed(spark)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    for kw in ({}, {"buckets": 4, "rank_limit": 10}, {"buckets": 2, "rank_limit": 1}):
        got = {(r["k"], r["prob"]): r["quantile"] for r in exact_quantiles(df, ["k"], "v", probs, **kw).collect()}
        for (k, p), q in got.items():
            exp = pdf[pdf.k == k].v.dropna().quantile(p)
            assert abs(q - exp) < 1e-9, (kw, k, p, q, exp)


def test_exact_quantiles_with_infinities(spark):
    vals = [1.0, 2.0, 3.0, float("inf"), float("-inf"), 2.5, 2.5]
    df = spark.createDataFrame([(0, x) for x in vals], "k int, v double")
    got = {r["prob"]: r["quantile"] for r in exact_quantiles(df, ["k"], "v", [0.25, 0.5, 0.75], buckets=3,
                                                             rank_limit=1).collect()}
    exp = pd.Series(vals).quantile([0.25, 0.5, 0.75])
    assert got == {0.25: exp[0.25], 0.5: exp[0.5], 0.75: exp[0.75]}


def test_exact_quantiles_when_the_sketch_misses(spark):
    """A sketch of 8 is often wrong by more than its bracket: the counts send those
    targets to their gap.  NaN is the largest value, a group of NaN alone has no other."""
    rng = np.random.default_rng(3)
    vals = {0: rng.normal(0, 1, 4000), 1: np.exp(rng.normal(0, 9, 2500)), 2: np.round(rng.normal(0, 1, 2000), 1),
            3: np.r_[rng.random(500), [np.nan] * 500], 4: [np.nan] * 3, 5: [7.0] * 400, 6: [-np.inf] * 300 + [1.0, 2.0, np.inf]}
    df = spark.createDataFrame([(k, float(v)) for k, vs in vals.items() for v in vs], "k int, v double")
    probs = [0.0, 0.01, 0.25, 0.3, 0.5, 0.9, 1.0]
    for kw in ({"sketch_k": 8, "rank_limit": 5}, {"sketch_k": 8, "rank_limit": 5, "buckets": 3}, {"rank_limit": 50}):
        got = {(r["k"], r["prob"]): (r["quantile"], r["n"]) for r in exact_quantiles(df, ["k"], "v", probs, **kw).collect()}
        assert len(got) == len(vals) * len(probs)
        for k, vs in vals.items():
            ordered = sorted(vs, key=lambda v: (v != v, v))
            for p in probs:
                pos = p * (len(ordered) - 1)
                at, frac = int(pos), pos - int(pos)
                a, b = ordered[at], ordered[min(at + 1, len(ordered) - 1)]
                exp = a + frac * (b - a) if frac else a
                assert got[(k, p)][1] == len(ordered)
                np.testing.assert_allclose(got[(k, p)][0], exp, rtol=1e-12, err_msg=str((kw, k, p)))


def test_exact_quantiles_scan_the_source_twice(spark):
    seen = spark.sparkContext.accumulator(0)

    def watch(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    n = 60_000
    df = spark.range(n).selectExpr("id % 2 AS k", "CAST(pmod(hash(id), 1000003) AS double) AS v").mapInPandas(watch, "k long, v double")
    got = {(r["k"], r["prob"]): r["quantile"] for r in exact_quantiles(df, ["k"], "v", [0.25, 0.5, 0.75], rank_limit=500).collect()}
    assert seen.value == 2 * n
    pdf = df.toPandas()
    for (k, p), q in got.items():
        assert abs(q - pdf[pdf.k == k].v.quantile(p)) < 1e-6


def test_exact_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(1, None)], "k int, v double")
    assert exact_quantiles(df, ["k"], "v", [0.5]).collect() == []


def test_with_ordinal_under_skew(spark):
    pdf, df = skewed(spark)
    got = {r["id"]: r["ordinal"] for r in with_ordinal(df, ["k"], ["v", "id"], partitions=7).collect()}
    exp = pdf.assign(vv=pdf.v.fillna(-np.inf)).sort_values(["k", "vv", "id"]).groupby("k").cumcount()
    assert got == {int(i): int(o) for i, o in zip(pdf.loc[exp.index, "id"], exp)}


def test_running_totals(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(100)], "o int, x int")
    got = {r["o"]: r["cum_x"] for r in running_totals(df, ["o"], ["x"], partitions=5).collect()}
    assert got == {i: sum(j % 3 for j in range(i + 1)) for i in range(100)}


def test_top_k_per_key_matches_sort(spark):
    pdf, df = skewed(spark)
    got = sorted((r["k"], r["id"]) for r in top_k_per_key(df, ["k"], [F.col("id").desc()], 3, salts=8).collect())
    exp = sorted((int(k), int(i)) for k, g in pdf.groupby("k") for i in g.id.nlargest(3))
    assert got == exp


def test_value_changes(spark):
    df = spark.createDataFrame([(1, 0, 5.0), (2, 0, 5.0), (3, 0, 6.0), (4, 0, None), (5, 0, None), (6, 0, 6.0),
                                (7, 1, 1.0)], "t int, k int, v double")
    got = sorted((r["t"], r["prev_value"]) for r in value_changes(df, "k", ["t"], "v").collect())
    assert got == [(1, None), (3, 5.0), (4, 6.0), (6, None), (7, None)]


def brute_windows(pdf, length=20, gap=20, horizon=20):
    span = length + gap + horizon
    out = []
    for k, g in pdf.sort_values(["k", "t"]).groupby("k"):
        v = g.v.tolist()
        for i in range(len(v) - span):
            out.append((k, i, sum(v[i:i + length]), v[i + span - 1], int(g.lab.iloc[i + span])))
    return sorted(out)


def test_sequence_windows_counts_and_halo(spark):
    rows = []
    for k, n in [(0, 60), (1, 61), (2, 200), (3, 10)]:
        rows += [(k, t, float(t * (k + 1) % 17), int(t % 5 == 0)) for t in range(n)]
    pdf = pd.DataFrame(rows, columns=["k", "t", "v", "lab"])
    df = spark.createDataFrame(pdf)
    for chunk in (61, 64, 4096):
        w = sequence_windows(df, "k", ["t"], ["v"], label="lab", chunk=chunk)
        got = sorted((r["k"], r["start_ordinal"], sum(s["v"] for s in r["input"]), r["target"][-1]["v"], r["label"])
                     for r in w.collect())
        assert got == brute_windows(pdf)
        counts = {r["k"]: r["count"] for r in w.groupBy("k").count().collect()}
        assert counts == {1: 1, 2: 140}


def test_no_single_partition_exchange_in_hot_paths(spark):
    _, df = skewed(spark)
    plan = with_ordinal(df, ["k"], ["v", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_purge_overlapping_windows_matches_brute_force(spark):
    from forgeline.operators.sequences import purge_overlaps
    rows = [(k, s, "valid" if (k == 1 and s < 30) or k == 0 else "test") for k in (0, 1, 2) for s in range(100)]
    df = spark.createDataFrame(rows, "k int, start_ordinal long, split string")
    got = sorted((r["k"], r["start_ordinal"]) for r in purge_overlaps(df, "k", "start_ordinal", 60).collect())
    valid = {(k, s) for k, s, sp in rows if sp == "valid"}
    exp = sorted((k, s) for k, s, sp in rows
                 if sp == "valid" or not any(vk == k and abs(vs - s) < 60 for vk, vs in valid))
    assert got == exp


def test_null_keys_keep_their_rows(spark):
    from forgeline.operators import features as fe
    df = spark.createDataFrame([(1, None, 1.0), (2, None, 2.0), (3, None, 2.0), (4, 7, 1.0), (5, 7, 1.0)],
                               "id int, k int, v double")
    assert with_ordinal(df, ["k"], ["id"]).count() == 5
    got = sorted((r["id"], r["prev_value"]) for r in value_changes(df, "k", ["id"], "v").collect())
    assert got == [(1, None), (2, 1.0), (4, None)]
    assert fe.with_row_weight(df, "k").count() == 5
    sp = fe.stratified_split(df, "k", "id", test_percent=50)
    assert sp.count() == 5 and sp.where("k IS NULL AND split = 'test'").count() == 2


def test_offsets_broadcast_only_below_the_bound(spark, monkeypatch):
    """The broadcast hint is given only when the counted offsets table is
    within the bound (above it Spark's own size-based choice applies)."""
    import forgeline.functions.ordinals as o
    _, df = skewed(spark, n=500)

    def hinted(frame):
        return "broadcast" in frame._jdf.queryExecution().logical().toString().lower()
    assert hinted(o.with_ordinal(df, ["k"], ["id"]))
    monkeypatch.setattr(o, "BROADCAST_ROWS", 1)
    big = o.with_ordinal(df, ["k"], ["id"])
    assert not hinted(big) and big.count() == 500

"""Feature preparation and sampling."""
import numpy as np
from pyspark.sql import functions as F

from forgeline.operators import features as fe


def labelled(spark, n=1000, pos=90):
    return spark.createDataFrame([(i, int(i < pos), float(i % 37), float(i % 11)) for i in range(n)],
                                 "id long, y int, a double, b double")


def test_stratified_split_exact_quotas(spark):
    sp = fe.stratified_split(labelled(spark), "y", "id", test_percent=20, seed=42)
    c = {(r["y"], r["split"]): r["count"] for r in sp.groupBy("y", "split").count().collect()}
    assert c == {(0, "test"): 182, (0, "train"): 728, (1, "test"): 18, (1, "train"): 72}
    again = fe.stratified_split(labelled(spark), "y", "id", test_percent=20, seed=42)
    assert sorted(sp.collect()) == sorted(again.collect())


def test_standard_scaler_fit_on_train(spark):
    df = labelled(spark)
    params = fe.fit_standard(df, ["a", "b"])
    out = fe.apply_scale(df, params).agg(F.avg("a"), F.stddev_pop("a"), F.avg("b"), F.stddev_pop("b")).first()
    assert abs(out[0]) < 1e-12 and abs(out[1] - 1) < 1e-12 and abs(out[2]) < 1e-12 and abs(out[3] - 1) < 1e-12


def test_population_std_and_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    p = fe.fit_standard(df, ["x", "c"])
    assert p["x"] == (2.0, 1.0) and p["c"] == (5.0, 1.0)
    m = fe.fit_minmax(df, ["x", "c"])
    out = fe.apply_scale(df, m).collect()
    assert [(r["x"], r["c"]) for r in out] == [(0.0, 0.0), (1.0, 0.0)]


def test_one_hot_drop_first_and_unseen(spark):
    df = spark.createDataFrame([(1, "M"), (2, "L"), (3, "H"), (4, None)], "id int, t string")
    out, cats = fe.one_hot(df, "t")
    assert cats == ["H", "L", "M"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, 0, 1), (2, 1, 0), (3, 0, 0), (4, 0, 0)]
    new = spark.createDataFrame([(9, "X")], "id int, t string")
    enc, _ = fe.one_hot(new, "t", cats=cats)
    assert tuple(enc.first()) == (9, 0, 0)


def test_oversample_exact_balance(spark):
    df = labelled(spark, n=100, pos=13)
    out = fe.oversample(df, "y", "id", seed=1)
    c = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert c == {0: 87, 1: 87}
    per_row = [r["count"] for r in out.where("y = 1").groupBy("id").count().collect()]
    assert sorted(set(per_row)) == [6, 7] and sum(per_row) == 87


def test_class_weights_and_balanced_sample(spark):
    df = labelled(spark, n=2000, pos=100)
    w = {r["y"]: r["weight"] for r in fe.class_weights(df, "y").collect()}
    assert w == {0: 1 / 1900, 1: 1 / 100}
    bs = fe.balanced_sample(df, "y", "id", seed=3)
    c = {r["y"]: r["count"] for r in bs.groupBy("y").count().collect()}
    assert abs(c[0] - 1000) < 150 and abs(c[1] - 1000) < 150


def test_hash_shuffle_is_a_permutation(spark):
    df = labelled(spark, n=300)
    idx = sorted(r["shuffle_index"] for r in fe.hash_shuffle(df, "id").collect())
    assert idx == list(range(300))


def test_split_by_ordinal(spark):
    df = labelled(spark, n=50)
    out = fe.split_by_ordinal(df, ["id"], 40)
    assert sorted(r["id"] for r in out.where("split = 'train'").collect()) == list(range(40))


def test_derive_power(spark):
    df = spark.createDataFrame([(10.0, 60.0, 300.0, 299.0)], "torque double, rpm double, hot double, cold double")
    r = fe.derive(df, fe.power_and_delta("torque", "rpm", "hot", "cold")).first()
    assert abs(r["power"] - 10 * 60 * 2 * np.pi / 60) < 1e-9 and r["temp_diff"] == 1.0


def test_explode_copies_slices_large_replication(spark):
    df = spark.createDataFrame([(1, 7), (2, 0), (3, 25)], "id int, n long")
    out = fe.explode_copies(df, F.col("n"), "copy", slice_size=4)
    got = sorted((r["id"], r["copy"]) for r in out.collect())
    assert got == [(1, i) for i in range(7)] + [(3, i) for i in range(25)]


def test_split_quota_is_the_largest_remainder(spark):
    """10,000 rows with 339 of one class: exactly 2,000 test rows, 68 of them."""
    df = spark.range(10_000).select(F.col("id"), (F.col("id") < 339).cast("int").alias("y"))
    out = {(r["y"], r["split"]): r["n"] for r in fe.stratified_split(df, "y", "id", 20, 42).groupBy("y", "split").agg(F.count("*").alias("n")).collect()}
    assert out == {(1, "test"): 68, (1, "train"): 271, (0, "test"): 1932, (0, "train"): 7729}


def test_split_moves_no_rows(spark):
    """Only the per-class tables are exchanged, never the rows' other columns."""
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("y"), F.lit("x").alias("payload"))
    plan = fe.stratified_split(df, "y", "id")._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]
    assert shuffles and not any("payload" in line for line in shuffles)


def test_balanced_sample_keeps_a_null_class(spark):
    df = spark.createDataFrame([(i, None if i < 10 else i % 2) for i in range(3000)], "id long, y int")
    out = fe.balanced_sample(df, "y", "id")
    n = {r["y"]: r["n"] for r in out.groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert sum(n.values()) == 3000 and set(n) == {None, 0, 1}
    assert all(900 < v < 1100 for v in n.values())
    assert out.exceptAll(fe.balanced_sample(df.repartition(7), "y", "id")).count() == 0


def test_split_joins_its_boundaries_where_the_rows_are(spark):
    """Two classes, so most partitions of a shuffle by class would be empty and one
    task would read a class: the boundaries are broadcast, found once and not again
    for each use of the split."""
    seen = spark.sparkContext.accumulator(0)

    def watch(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    n = 2000
    df = spark.range(n).select("id", (F.col("id") % 7 == 0).cast("int").alias("y")).mapInPandas(watch, "id long, y int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sp = fe.stratified_split(df, "y", "id", 20, 42)
        plan = sp._jdf.queryExecution().executedPlan().toString()
        fitted = seen.value
        assert sp.where("split = 'test'").count() == 400
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert seen.value - fitted == n
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_quota_of_repeated_keys(spark):
    """Rows that repeat a key are on the same side of the boundary, however many."""
    df = spark.range(900).select((F.col("id") % 3).cast("string").alias("id"), F.lit(1).alias("y"))
    sizes = {(r["id"], r["split"]): r["n"] for r in fe.stratified_split(df, "y", "id", 50, 42).groupBy("id", "split").agg(F.count("*").alias("n")).collect()}
    assert len(sizes) == 3 and set(sizes.values()) == {300}
    assert sorted(split for _, split in sizes) == ["test", "test", "train"]

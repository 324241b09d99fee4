"""Exact k-NN (k-d cells) against brute force, and SMOTE."""
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from forgeline.operators import neighbours as nb
from forgeline.operators.neighbours import knn_exact
from forgeline.operators.smote import smote


def brute(pdf, k):
    x = pdf[["a", "b", "c"]].to_numpy()
    keys = pdf["id"].tolist()
    out = []
    for i, ki in enumerate(keys):
        d = ((x - x[i]) ** 2).sum(axis=1)
        cand = sorted((d[j], keys[j]) for j in range(len(keys)) if j != i)[:k]
        out += [(ki, kj, r + 1) for r, (_, kj) in enumerate(cand)]
    return sorted(out)


def test_knn_exact_matches_brute_force_with_ties(spark):
    rng = np.random.default_rng(5)
    n = 300
    pdf = pd.DataFrame({"id": [f"r{i:04d}" for i in range(n)],
                        "a": rng.integers(0, 6, n).astype(float),      # many exact ties
                        "b": np.round(rng.normal(0, 1, n), 1),
                        "c": np.where(rng.random(n) < 0.1, 50.0, rng.random(n))})  # a far cluster
    df = spark.createDataFrame(pdf)
    got = sorted((r["id"], r["nn_key"], r["nn_rank"]) for r in knn_exact(df, "id", ["a", "b", "c"], k=4).collect())
    assert got == brute(pdf, 4)


def test_knn_tiny_input(spark):
    pdf = pd.DataFrame({"id": ["x", "y", "z"], "a": [0.0, 1.0, 5.0], "b": [0.0] * 3, "c": [0.0] * 3})
    got = sorted((r["id"], r["nn_key"], r["nn_rank"]) for r in
                 knn_exact(spark.createDataFrame(pdf), "id", ["a", "b", "c"], k=2).collect())
    assert got == brute(pdf, 2)


def test_knn_over_cells_hot_points_and_missing(spark):
    """Many cells, a point that a third of the rows share, far outliers, rows that
    take no part."""
    rng = np.random.default_rng(8)
    n = 600
    pdf = pd.DataFrame({"id": rng.permutation(n) * 3 - 500, "a": rng.integers(0, 40, n) / 4, "b": rng.normal(0, 1, n), "c": rng.integers(0, 3, n) * 1.0})
    pdf.loc[:199, ["a", "b", "c"]] = [1.25, -0.0, 2.0]
    pdf.loc[200:203, ["a", "b"]] = [[1e6, 0], [1e6, 1], [-1e6, 5], [0, 1e5]]
    bad = pd.DataFrame({"id": [90001, 90002], "a": [float("inf"), 1.0], "b": [0.0, float("nan")], "c": [0.0, 0.0]})
    df = spark.createDataFrame(pd.concat([pdf, bad]))
    got = sorted((r["id"], r["nn_key"], r["nn_rank"]) for r in knn_exact(df, "id", ["a", "b", "c"], k=4, cells=16).collect())
    assert got == brute(pdf, 4)
    assert knn_exact(df.where("id < -10000"), "id", ["a", "b", "c"]).collect() == []


def test_hot_point_goes_by_broadcast(spark, monkeypatch):
    from forgeline.functions import joins
    monkeypatch.setattr(joins, "HOT_ROWS", 10)
    monkeypatch.setattr(joins, "HOT_KEYS", 4)
    pdf = pd.DataFrame({"id": range(120), "a": [0.0] * 70 + [1.0] * 15 + list(np.arange(35.0)), "b": 0.0, "c": 0.0})
    got = sorted((r["id"], r["nn_key"], r["nn_rank"]) for r in knn_exact(spark.createDataFrame(pdf), "id", ["a", "b", "c"], k=3).collect())
    assert got == brute(pdf, 3)


def test_candidates_grow_with_the_rows(spark):
    """Points compared per point stay about the same at four times the rows."""
    def compared(n):
        pts = spark.range(n).select(F.col("id").alias("key"), F.lit(1).alias("rank"), *[F.rand(i).alias(f"f{i}") for i in range(3)]).checkpoint()
        return nb.point_lists(pts, ["f0", "f1", "f2"], 6, -(-n // 500)).agg(F.sum("looked")).first()[0] / n
    small, large = compared(4_000), compared(16_000)
    assert large < 1.5 * small and large < 0.1 * 16_000


def test_smote_balances_and_stays_on_segments(spark):
    rng = np.random.default_rng(9)
    n = 200
    pdf = pd.DataFrame({"id": [f"r{i}" for i in range(n)], "a": rng.normal(0, 1, n), "b": rng.normal(0, 1, n),
                        "y": (np.arange(n) < 23).astype(int)})
    out = smote(spark.createDataFrame(pdf), "id", ["a", "b"], "y", k=3, seed=1)
    c = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert c == {0: 177, 1: 177}
    syn = out.where(F.col("synthetic")).toPandas()
    base = pdf.set_index("id")
    nn = {(r["id"], r["nn_key"]) for r in knn_exact(spark.createDataFrame(pdf[pdf.y == 1]), "id", ["a", "b"], k=3).collect()}
    for _, r in syn.iterrows():
        assert (r["src_key"], r["nn_key"]) in nn and 0.0 <= r["gap"] < 1.0
        s, d = base.loc[r["src_key"]], base.loc[r["nn_key"]]
        assert abs(r["a"] - (s.a + r["gap"] * (d.a - s.a))) < 1e-12

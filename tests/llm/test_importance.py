"""Importance resampling: held-out accuracy, the exact top k, defined cases."""
import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from forgeline.llm import importance
from forgeline.llm.tokens import blocks

LABEL = "doc_id long, quality int, toxic int"


def corpus(n=400):
    rng = random.Random(3)
    words = [f"word{i}" for i in range(200)]
    docs, good = [], {}
    for i in range(n):
        good[i] = rng.random() < 0.8
        w = [rng.choice(words) for _ in range(rng.randrange(20, 80))]
        docs.append((i, " ".join(w) if good[i] else " ".join(rng.choice((f"{x.upper()}!!", "%%%", x)) for x in w)))
    return docs, good


def test_held_out_documents_are_told_apart(documents, spark, clashing):
    docs, good = corpus()
    labels = spark.createDataFrame([(i, int(good[i]), 0) for i in range(200)] + [(7, int(good[7]), 0), (None, 1, 0), (9999, 1, 0), (3, None, 0)], LABEL)
    rows = {r["doc_id"]: r for r in importance.select(clashing(documents(docs)), clashing(labels)).collect()}
    assert len(rows) == len(docs)
    wrong = [i for i in range(200, 400) if rows[i]["kept"] != good[i]]
    assert len(wrong) <= 4
    kept = importance.keep_selected(clashing(documents(docs)), labels)
    assert kept.columns == clashing(documents(docs)).columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in rows if rows[i]["kept"]}


def test_weights_are_log_ratios_of_all_documents(documents):
    docs, _ = corpus(50)
    df = documents(docs)
    counts = importance.feature_counts(df.select("text"))
    total = np.zeros(importance.BUCKETS, np.int64)
    for _, t in docs:
        for _, offsets, data in blocks(pa.array([t])):
            total += np.bincount(importance.features(offsets, data)[0], minlength=importance.BUCKETS)
    assert (counts == total).all()
    ratio = np.log((total + 1) / total.sum())
    rows = {r["doc_id"]: r["weight"] for r in importance.weights(df.select("doc_id", "text"), ratio, "doc_id").collect()}
    for i, t in docs[:5]:
        (_, offsets, data), = blocks(pa.array([t]))
        f, _ = importance.features(offsets, data)
        assert math.isclose(rows[i], ratio[f].sum() / (len(f) + importance.SHRINK), rel_tol=1e-9)


def test_kth_largest_is_exact(spark):
    rng = random.Random(1)
    values = [rng.gauss(0, 1) * 10 ** rng.randrange(-3, 4) for _ in range(2000)] + [1.5] * 500 + [-math.pi] * 3
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    for k in (1, 2, 137, 500, 1200, len(values)):
        assert importance.kth_largest(df, "x", k) == sorted(values, reverse=True)[k - 1]
    assert importance.kth_largest(df, "x", 0) == math.inf


def test_defined_cases(documents, spark):
    none = spark.createDataFrame([], LABEL)
    pairs = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (4, "long " * 50000)]
    rows = importance.select(documents(pairs), none).collect()
    assert len(rows) == len(pairs) and all(r["kept"] and r["weight"] == 0 for r in rows)
    assert importance.select(documents([]), none).count() == 0
    assert importance.keep_selected(documents([]), none).count() == 0
    docs, good = corpus(100)
    labels = spark.createDataFrame([(i, int(good[i]), 0) for i in range(100)], LABEL)
    rows = importance.select(documents([*docs, *docs]), labels).collect()
    assert len(rows) == 200
    by_id = {}
    for r in rows:
        assert by_id.setdefault(r["doc_id"], r["kept"]) == r["kept"]


def test_sample_has_its_bound(documents, spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(50)], LABEL)
    sample = importance.labelled_sample(documents([(i, "t") for i in range(60)]), labels, limit=10)
    assert sample.count() == 10
    assert sample.select(F.max("doc_id")).first()[0] < 50


def test_repeated_documents_count_once_in_the_sample(documents, spark):
    pairs = [(1, f"copy {i}") for i in range(300)] + [(2, "x"), (3, "y")]
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    assert importance.labelled_sample(documents(pairs), labels, 3).count() == 3
    from forgeline.llm import toxicity
    assert toxicity.training_sample(documents(pairs), labels, F.lit(False), 3).count() == 3


def test_draw_in_proportion_to_the_weights(documents, spark):
    """scale 1 and k of the caller: the k largest of weight + Gumbel noise."""
    pairs = [(i, "good clean words here " * (i % 5) + "junk $$ !! " * (i % 7)) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 7 == 0), 0) for i in range(60)], "doc_id long, quality int, toxic int")
    rows = importance.select(documents(pairs), labels, scale=1.0, k=50).collect()
    noise = {r["id"]: r["g"] for r in spark.range(200).select("id", importance.noise(F.col("id")).alias("g")).collect()}
    order = sorted(rows, key=lambda r: -(r["weight"] + noise[r["doc_id"]]))
    assert {r["doc_id"] for r in order[:50]} == {r["doc_id"] for r in rows if r["kept"]}
    cut = importance.keep_selected(documents(pairs), labels, scale=1.0, k=50)
    assert sorted(r["doc_id"] for r in cut.collect()) == sorted(r["doc_id"] for r in order[:50])

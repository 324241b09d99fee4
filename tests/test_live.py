"""Live scoring, changes of out-of-order streams, the history table, resampling."""
import datetime as dt
import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from forgeline.functions.quantiles import exact_quantiles
from forgeline.operators import images as im
from forgeline.operators import models as mo
from forgeline.operators.bundles import LinearBundle
from forgeline.operators.history import retain, value_changes
from forgeline.operators.history_table import HistoryTable
from forgeline.streaming import changes as ch
from forgeline.streaming import live as lv
from forgeline.streaming import pipelines as st

BUNDLE = LinearBundle(("a", "b x"), (1.0, 2.0), (2.0, 4.0), (1.5, -1.0), 0.25, 0.6)


def test_bundle_round_trip_and_single_record(spark, tmp_dir):
    BUNDLE.save(spark, f"{tmp_dir}/b")
    assert LinearBundle.load(spark, f"{tmp_dir}/b") == BUNDLE
    rows = [{"a": 0.5 * i, "b x": 3.0 - i} for i in range(10)]
    got = [r[0] for r in spark.createDataFrame([(r["a"], r["b x"]) for r in rows], "a double, `b x` double").select(BUNDLE.probability()).collect()]
    assert np.allclose(got, [BUNDLE.score(r) for r in rows], rtol=1e-14)


def test_bundle_of_a_fitted_pipeline(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (400, 2))
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "y": (x[:, 0] - x[:, 1] + rng.normal(0, 0.1, 400) > 0).astype(int)}))
    model = mo.fit_classifier(df, ["a", "b"], "y")
    bundle = LinearBundle.of(model, {})
    scored = mo.score(model, df, "p").withColumn("q", bundle.probability()).toPandas()
    assert np.allclose(scored["p"], scored["q"], atol=1e-12)
    # a floor on separable data, as the trained models of the scripts are judged
    hit = (scored["p"] >= 0.5).astype(int)
    tp, fp, fn = ((hit == 1) & (scored["y"] == 1)).sum(), ((hit == 1) & (scored["y"] == 0)).sum(), ((hit == 0) & (scored["y"] == 1)).sum()
    assert 2 * tp / (2 * tp + fp + fn) > 0.95


RECORDS = [(1, '{"a": 1, "b x": 2}'), (2, '{"a": 1'), (3, None), (4, '{"a": null, "b x": 2}'), (5, '{"b x": 2, "c": 1}'), (6, '{"a": "x", "b x": 2}'), (7, ""),
           (8, '{"a": NaN, "b x": 2}'), (9, "[]"), (10, '{"a": 9, "b x": -9}')]


def arrive(spark, folder, name, rows):
    spark.createDataFrame(rows, "id long, payload string").coalesce(1).write.parquet(f"{folder}/{name}")


def test_live_scores_restart_and_repeat(spark, tmp_dir):
    feed = lambda: spark.readStream.schema("id long, payload string").option("recursiveFileLookup", "true").parquet(f"{tmp_dir}/in")
    arrive(spark, f"{tmp_dir}/in", "a", RECORDS[:6])
    lv.score_live(feed(), "payload", BUNDLE, f"{tmp_dir}/out")
    lv.score_live(feed(), "payload", BUNDLE, f"{tmp_dir}/out")  # nothing new
    arrive(spark, f"{tmp_dir}/in", "b", RECORDS[6:])
    lv.score_live(feed(), "payload", BUNDLE, f"{tmp_dir}/out")
    scores = {r["id"]: r for r in lv.read_scores(spark, f"{tmp_dir}/out").collect()}
    dead = sorted((r["id"], r["payload"], r["reason"]) for r in lv.read_dead_letters(spark, f"{tmp_dir}/out").collect())
    assert sorted(scores) == [1, 10] and scores[1]["status"] == "normal" and scores[10]["status"] == "FAILURE RISK"
    assert np.isclose(scores[1]["probability"], BUNDLE.score({"a": 1, "b x": 2}))
    assert [d[0] for d in dead] == [2, 3, 4, 5, 6, 7, 8, 9] and {d[0]: d[2] for d in dead}[4] == "lacks a" and {d[0]: d[2] for d in dead}[8] == "lacks a"
    assert {d[0]: d[2] for d in dead}[2] == "unreadable" and dict((d[0], d[1]) for d in dead)[2] == '{"a": 1'
    # a batch that is run again leaves the same rows
    write = lv.score_batch("payload", BUNDLE)
    batch = spark.createDataFrame(RECORDS, "id long, payload string")
    for _ in range(2):
        write(batch, 7, f"{tmp_dir}/again")
    assert lv.read_scores(spark, f"{tmp_dir}/again").count() == 2 and lv.read_dead_letters(spark, f"{tmp_dir}/again").count() == 8


def test_late_rows_are_linked_into_place(spark, tmp_dir):
    rng = random.Random(4)
    t0 = dt.datetime(2024, 3, 1)
    rows = []
    for i in range(600):
        key = rng.choice(["hot", "hot", "b", "c", None])
        rows.append((i, key, t0 + dt.timedelta(minutes=rng.randrange(3000)), rng.choice([None, float("nan"), 1.0, 1.0, 2.0])))
    schema = "id long, k string, ts timestamp_ntz, v double"
    for n in range(3):
        spark.createDataFrame(rows[n::3], schema).coalesce(1).write.parquet(f"{tmp_dir}/{n}")
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(tmp_dir)
    path = st.run_batches(ch.reading_chunks(feed, "k", "ts", ["ts", "id"], "2 hours", "90 days"), "late", st.write_latest_per_key(["k", "start"]))
    got = ch.changes(spark, path, "k", "v").select("id", "prev_value")
    want = value_changes(spark.createDataFrame(rows, schema), "k", ["ts", "id"], "v").select("id", "prev_value")
    key = lambda df: sorted((r["id"], str(r["prev_value"])) for r in df.collect())
    assert key(got) == key(want)


def test_missing_readings_of_the_state_stream_are_no_changes(spark, tmp_dir):
    rows = [(i, "m", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), x) for i, x in enumerate([None, None, None, 1.0, 1.0, None, float("nan")])]
    schema = "id long, k string, ts timestamp_ntz, v double"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_dir}/f")
    feed = spark.readStream.schema(schema).parquet(f"{tmp_dir}/f")
    path = st.run_to_table(st.change_stream(feed, "k", ["ts", "id"], "v"), "nulls")
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [0, 3, 5]


def test_quantiles_of_null_and_nan_groups(spark):
    rows = [(None, float(i)) for i in range(11)] + [(1.0, 5.0), (float("nan"), 2.0), (float("nan"), 4.0)]
    df = spark.createDataFrame(rows, "g double, v double")
    got = {str(r["g"]): r["quantile"] for r in exact_quantiles(df, ["g"], "v", [0.5]).collect()}
    assert got == {"None": 5.0, "1.0": 5.0, "nan": 3.0}
    deep = exact_quantiles(df, ["g"], "v", [0.5], buckets=4, rank_limit=2)
    assert {str(r["g"]): r["quantile"] for r in deep.collect()} == got


def test_history_table_rewrites_touched_dates_only(spark, tmp_dir):
    rng = random.Random(6)
    t0 = dt.datetime(2024, 5, 1)
    make = lambda lo, hi, days: [(i, rng.choice(["a", "b", None]), t0 + dt.timedelta(days=rng.choice(days), minutes=rng.randrange(1000)), rng.random()) for i in range(lo, hi)]
    schema = "id long, k string, ts timestamp_ntz, v double"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    table = HistoryTable(spark, f"{tmp_dir}/t", "k", "ts", 25, "10 days", "id")
    with pytest.raises(ValueError):
        table.read()
    rows, parts = [], [make(0, 40, range(6)), [(1000, "new", t0, 1.0)], make(40, 80, range(3, 9)), [(2000, "a", t0 + dt.timedelta(days=40), 0.5)]]
    for i, part in enumerate(parts):
        before = dict(table.manifest()[1])
        rows += part
        changed = table.add(frame(part))
        after = table.manifest()[1]
        assert all(before[d] == after[d] for d in before if d not in changed)
        if i == 1:
            assert changed == ["2024-05-01"] and len(before) > 1
        want = retain(frame(rows), "k", "ts", 25, "10 days", tiebreak="id")
        key = lambda df: sorted(map(str, df.select("id", "k", "ts", "v").collect()))
        assert key(table.read()) == key(want)
    assert table.add(frame(parts[1])) == []  # a landing that is repeated changes nothing
    os.makedirs(f"{tmp_dir}/t/data/v99-broken/date=2024-05-01")  # left by a job that failed: no manifest names it
    assert table.read().count() == want.count()


def brute_resize(a, size):
    n, out, scale = len(a), [], len(a) / size
    reach = max(scale, 1.0)
    for o in range(size):
        centre = (o + 0.5) * scale
        w = [max(1 - abs((i + 0.5 - centre) / reach), 0) for i in range(n)]
        out.append(sum(x * y for x, y in zip(w, a)) / sum(w))
    return out


def test_resampling_equals_brute_force(spark):
    rng = np.random.default_rng(7)
    for h, w, th, tw in ((4, 4, 9, 2), (7, 3, 3, 7), (5, 5, 5, 5), (1, 6, 4, 1)):
        m = rng.random((h, w))
        want = np.array([brute_resize(r, tw) for r in np.array([brute_resize(c, th) for c in m.T]).T])
        assert np.allclose(im.resize(m, th, tw), want)
        df = spark.createDataFrame([(m.ravel().tolist(),), (None,), ([1.0],)], "m array<double>")
        got = [r[0] for r in im.resize_maps(df, "m", h, w, th, tw).select("resized").collect()]
        assert np.allclose(got[0], want.ravel()) and got[1] is got[2] is None
    assert np.allclose(im.resize(np.array([[0.0, 1.0]]), 1, 4), [[0, 0.25, 0.75, 1]])  # doubling: a quarter steps between, flat ends

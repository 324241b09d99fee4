"""Evaluation operators against hand-derived numbers."""
import numpy as np

from forgeline.operators import evaluation as ev
from forgeline.operators.sequences import decide


def scored(spark):
    return spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8), (1, 0.4)], "y int, s double")


def test_auc_with_ties(spark):
    assert abs(ev.roc_auc(scored(spark), "y", "s").first()["auc"] - 0.75) < 1e-12


def test_auc_invariant_under_monotone_map(spark):
    from pyspark.sql import functions as F
    df = scored(spark).withColumn("s2", F.exp(F.col("s") * 3))
    assert ev.roc_auc(df, "y", "s2").first()["auc"] == ev.roc_auc(df, "y", "s").first()["auc"]


def counts_frame(spark, tp, fp, fn, tn):
    rows = [(1, 1)] * tp + [(0, 1)] * fp + [(1, 0)] * fn + [(0, 0)] * tn
    return spark.createDataFrame(rows, "y int, pred int")


def test_metrics_records(spark):
    m = ev.classification_metrics(counts_frame(spark, 51, 9, 17, 1923), "y", "pred").first()
    assert (round(m["accuracy"], 6), round(m["precision"], 6), round(m["recall"], 6), round(m["f1"], 6)) == \
        (0.987, 0.85, 0.75, 0.796875)
    m = ev.classification_metrics(counts_frame(spark, 62, 151, 6, 1781), "y", "pred").first()
    assert (round(m["accuracy"], 4), round(m["precision"], 4), round(m["recall"], 4), round(m["f1"], 4)) == \
        (0.9215, 0.2911, 0.9118, 0.4413)


def test_zero_division_is_zero(spark):
    m = ev.classification_metrics(counts_frame(spark, 0, 0, 3, 5), "y", "pred").first()
    assert (m["precision"], m["recall"], m["f1"]) == (0.0, 0.0, 0.0)


def test_confusion_has_all_cells(spark):
    c = {(r["y"], r["pred"]): r["count"] for r in ev.confusion(decide(scored(spark), "s", 0.4), "y", "pred").collect()}
    assert c == {(0, 0): 1, (0, 1): 1, (1, 0): 1, (1, 1): 2}


def test_pr_curve_and_best_f1(spark):
    pr = {r["threshold"]: (r["precision"], r["recall"]) for r in ev.pr_curve(scored(spark), "y", "s").collect()}
    assert pr[None] == (1.0, 0.0)
    assert pr[0.4] == (2 / 3, 2 / 3) and pr[0.35] == (0.75, 1.0) and pr[0.1] == (0.6, 1.0)
    best = ev.best_f1_threshold(scored(spark), "y", "s").first()
    assert best["threshold"] == 0.35  # F1 0.857 at 0.35 beats 0.75 at 0.1


def test_roc_curve_starts_at_origin(spark):
    pts = sorted((r["fpr"], r["tpr"]) for r in ev.roc_curve(scored(spark), "y", "s").collect())
    assert pts[0] == (0.0, 0.0) and pts[-1] == (1.0, 1.0)


def test_sweep_picks_first_minimum(spark):
    s = ev.sweep_thresholds(scored(spark), "y", "s", 0.0, 1.0, 11).collect()
    chosen = [r for r in s if r["chosen"]]
    assert len(chosen) == 1
    best_gap = min(r["gap"] for r in s)
    assert chosen[0]["i"] == min(r["i"] for r in s if r["gap"] == best_gap)
    # strict '>': at threshold 0.4 the two 0.4 scores are negative predictions
    r4 = [r for r in s if abs(r["threshold"] - 0.4) < 1e-12][0]
    assert r4["precision"] == 1.0 and abs(r4["recall"] - 1 / 3) < 1e-12


def test_log_loss(spark):
    import math
    df = spark.createDataFrame([(1, 0.0), (0, 0.0)], "y int, z double")
    r = ev.log_loss(df, "y", "z").first()
    assert abs(r["log_loss"] - math.log(2)) < 1e-12 and abs(r["mse"] - 0.25) < 1e-12


def test_sweep_flags_degenerate_choice(spark):
    df = spark.createDataFrame([(1, 0.2), (0, 0.1), (1, 0.3)], "y int, s double")
    s = ev.sweep_thresholds(df, "y", "s", 0.0, 1.0, 5).collect()
    chosen = [r for r in s if r["chosen"]][0]
    # no score exceeds 0.5: from t = 0.5 on P = R = 0, so |P - R| = 0 is the
    # first minimum -- kept for parity, flagged as degenerate
    assert chosen["threshold"] == 0.5 and chosen["degenerate"]
    df2 = spark.createDataFrame([(0, 0.9), (1, 0.1)], "y int, s double")
    c2 = [r for r in ev.sweep_thresholds(df2, "y", "s", 0.0, 1.0, 5).collect() if r["chosen"]][0]
    assert c2["degenerate"] == (c2["recall"] == 0.0 and c2["precision"] == 0.0)


def test_auc_agrees_with_spark_ml_exact_evaluator(spark):
    import numpy as np
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rng = np.random.default_rng(11)
    y = (rng.random(2000) < 0.2).astype(int)
    s = np.round(rng.random(2000) * 0.6 + y * 0.2, 2)  # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    ours = ev.roc_auc(df, "y", "s").first()["auc"]
    ml = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", metricName="areaUnderROC",
                                       numBins=0).evaluate(df.withColumn("y", df["y"].cast("double")))
    assert abs(ours - ml) < 1e-12


def test_auc_of_counts_beyond_a_long_product(spark):
    from forgeline.operators.evaluation import auc_of_table
    big = 4_000_000_000
    cum = spark.createDataFrame([(0.1, 0, big, big), (0.9, big, 0, big)], "score double, pos long, neg long, cum_neg long")
    assert auc_of_table(cum).first()["auc"] == 1.0
    tie = spark.createDataFrame([(0.5, big, big, big)], "score double, pos long, neg long, cum_neg long")
    assert auc_of_table(tie).first()["auc"] == 0.5


def test_errors_by_class_with_own_edges(spark):
    """Each class from its own least to largest error; one value, NULL classes, no errors."""
    rng = np.random.default_rng(5)
    errors = {0: rng.gamma(2.0, 1.0, 300), 1: 50 + 20 * rng.random(80), 2: np.full(7, 3.0), None: rng.random(30)}
    rows = [(k, float(e)) for k, es in errors.items() for e in es] + [(0, None), (3, None)]
    got = ev.errors_by_class(spark.createDataFrame(rows, "y int, e double"), "y", "e", bins=10, own_edges=True).collect()
    counts = {(r["y"], r["bin"]): r["count"] for r in got}
    for k, es in errors.items():
        exp, edges = np.histogram(es, bins=10, range=(es.min(), es.max() if es.max() > es.min() else es.min() + 10))
        assert [counts.get((k, i), 0) for i in range(10)] == exp.tolist(), k
        for r in got:
            if r["y"] == k:
                np.testing.assert_allclose((r["lo"], r["hi"]), (edges[r["bin"]], edges[r["bin"] + 1]))
    assert 3 not in {r["y"] for r in got}

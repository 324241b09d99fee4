"""Row rules and repairs on tiny literal frames (null / NaN / Inf / edge cases)."""
import math

from pyspark.sql import functions as F

from forgeline.functions.exprs import round_half_even
from forgeline.operators import cleansing as cl


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_drop_rule_keeps_null_rows(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None), (4, 0.0)], "id int, t double")
    assert rows(cl.drop_non_positive(df, ["t"]), "id") == [(1,), (3,)]


def test_keep_range_drops_null_rows(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 100.0), (3, None), (4, 100.01)], "id int, t double")
    assert rows(cl.keep_in_range(df, {"t": (0.0, 100.0)}), "id") == [(1,), (2,)]


def test_out_of_limits_keeps_inclusive_limits(spark):
    df = spark.createDataFrame([(1, 50.0), (2, 400.0), (3, 49.9), (4, 400.1), (5, None)], "id int, b double")
    assert rows(cl.drop_out_of_limits(df, {"b": (50.0, 400.0)}), "id") == [(1,), (2,), (5,)]


def test_label_reason_contradiction(spark):
    df = spark.createDataFrame([(1, "Y", None), (2, "Y", "None"), (3, "Y", "flash"), (4, "N", "flash"),
                                (5, None, "flash")], "id int, p string, r string")
    out = cl.drop_contradiction(df, cl.label_reason_contradiction("p", "Y", "r"))
    assert rows(out, "id") == [(1,), (2,), (4,), (5,)]


def test_order_contradiction(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 2.0, 2.0), (3, 3.0, 2.0), (4, None, 2.0)], "id int, i double, c double")
    assert rows(cl.drop_contradiction(df, cl.order_contradiction("i", "c")), "id") == [(1,), (4,)]


def test_round_half_even_on_scaled_value(spark):
    df = spark.createDataFrame([(0.125,), (0.135,), (2.5,), (29.56354448529566,), (-0.125,)], "x double")
    got = [r[0] for r in df.select(round_half_even("x", 2)).collect()]
    assert got == [0.12, 0.14, 2.5, 29.56, -0.12]


def test_label_by_rule_counts_null_as_false(spark):
    df = spark.createDataFrame([(1, 28.0, 1.0), (2, 27.99, 1.4), (3, 27.99, 1.39), (4, None, None)],
                               "id int, t double, p double")
    out = cl.label_by_rule(df, (F.col("t") >= 28.0) | (F.col("p") >= 1.4), "lab")
    assert rows(out, "id", "lab") == [(1, 1), (2, 1), (3, 0), (4, 0)]


def test_na_normalise_nan_and_tokens(spark):
    df = spark.createDataFrame([(float("nan"), "None"), (1.0, " NA "), (2.0, "ok"), (None, "")], "x double, s string")
    out = cl.na_normalise(df).collect()
    assert [r["x"] for r in out] == [None, 1.0, 2.0, None]
    assert [r["s"] for r in out] == [None, " NA ", "ok", None]  # a padded token is text, as in a CSV reader


def test_sparse_rows_threshold_is_strict(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, None, None), (3, 1.0, 1.0)], "id int, a double, b double")
    assert rows(cl.drop_sparse_rows(df, ["a", "b"], 0.5), "id") == [(1,), (3,)]


def test_clip_and_infinite_repair(spark):
    df = spark.createDataFrame([(1, -5.0), (2, 5.0), (3, None), (4, float("inf")), (5, float("-inf"))], "id int, x double")
    clipped = rows(cl.clip_columns(df, {"x": (0.0, 1.0)}), "id", "x")
    assert clipped == [(1, 0.0), (2, 1.0), (3, None), (4, 1.0), (5, 0.0)]
    repaired = cl.impute_median(cl.replace_infinite(df, ["x"]), ["x"])
    assert rows(repaired, "id", "x") == [(1, -5.0), (2, 5.0), (3, 0.0), (4, 0.0), (5, 0.0)]


def test_drop_missing_all_columns_and_subset(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, 1.0, None), (3, 1.0, 1.0)], "id int, a double, b double")
    assert rows(cl.drop_missing(df), "id") == [(3,)]
    assert rows(cl.drop_missing(df, ["a"]), "id") == [(2,), (3,)]


def test_align_features_fills_absent(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "b double, a double")
    out = cl.align_features(df, ["a", "b", "c"]).first()
    assert list(out.asDict().items()) == [("a", 2.0), ("b", 1.0), ("c", 0)]
    assert not math.isnan(out["a"])


def test_keep_first_paths_agree_with_nulls(spark):
    from forgeline.operators import duplicates as du
    df = spark.createDataFrame([(1, 0, None, 5.0), (1, 1, 2.0, None), (2, 3, 7.0, 1.0), (2, 2, None, None),
                                (3, 9, 1.0, 1.0)], "k int, seq long, a double, b double")
    exp = [(1, 0, None, 5.0), (2, 2, None, None), (3, 9, 1.0, 1.0)]
    for unique in (False, True):
        got = sorted(tuple(r) for r in du.dedupe(df, ["k"], ["seq"], unique_order=unique).collect())
        assert got == exp
    c = {r["mode"]: (r["n_rows"], r["duplicates"]) for r in
         du.duplicate_count(df, ["k"], "members").selectExpr("'m' AS mode", "*")
         .unionByName(du.duplicate_count(df, ["k"], "excess").selectExpr("'e' AS mode", "*")).collect()}
    assert c == {"m": (5, 4), "e": (5, 2)}


def test_with_constant_and_feature_columns(spark):
    df = spark.createDataFrame([(1, 2.0, 0, 1)], "id int, x double, y int, leak int")
    out = cl.with_constant(df, "fin_jgmt", 1)
    assert out.first()["fin_jgmt"] == 1
    assert cl.feature_columns(out, target="y", leakage=["leak"], ids=["id"]) == ["x", "fin_jgmt"]


def test_dedupe_wide_keeps_first_per_sensor_vector(spark):
    from forgeline.operators import duplicates as du
    df = spark.createDataFrame([(0, 1.0, None, "a"), (1, 1.0, None, "b"), (2, 1.0, 2.0, "c"), (3, None, None, "d"),
                                (4, None, None, "e")], "seq long, s1 double, s2 double, tag string")
    got = sorted((r["seq"], r["tag"]) for r in du.dedupe_wide(df, ["s1", "s2"], ["seq"]).collect())
    assert got == [(0, "a"), (2, "c"), (3, "d")]

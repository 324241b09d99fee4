"""Golden pipeline: dedupe on time, drop missing, closed range, round half
even, label after rounding -- and the five-indicator report before/after."""
import datetime as dt

from pyspark.sql import functions as F

from forgeline.operators import cleansing as cl
from forgeline.operators import duplicates as du
from forgeline.operators import quality as qu

LIMITS = {"temperature": (0.0, 100.0), "pressure": (0.0, 5.0)}


def feed(spark):
    t0 = dt.datetime(2026, 3, 24, 21, 28, 34)
    vals = [(29.564, 1.2366), (28.681, 1.183), (None, 1.05), (24.8553, 1.3853), (28.276, 999.9),
            (20.421, 1.293), (25.514, 1.4853), (25.514, 1.4853), (27.99, 1.4), (26.0, 1.0)]
    rows = []
    for i, (t, p) in enumerate(vals):
        ts = t0 + dt.timedelta(milliseconds=500 * (i if i != 7 else 6))  # row 7 repeats row 6's time
        rows.append((i, "Machine_A", ts, t, p))
    return spark.createDataFrame(rows, "seq long, machine_id string, ts timestamp_ntz, temperature double, pressure double")


def clean(df):
    d = du.dedupe(df, ["ts"], ["seq"])
    d = cl.keep_in_range(cl.drop_missing(d), LIMITS)
    d = cl.round_columns(d, ["temperature", "pressure"], 2)
    return cl.label_by_rule(d, (F.col("temperature") >= 28.0) | (F.col("pressure") >= 1.4), "status_label")


def test_golden_rows(spark):
    out = sorted((r["seq"], r["temperature"], r["pressure"], r["status_label"]) for r in clean(feed(spark)).collect())
    assert out == [(0, 29.56, 1.24, 1), (1, 28.68, 1.18, 1), (3, 24.86, 1.39, 0), (5, 20.42, 1.29, 0),
                   (6, 25.51, 1.49, 1), (8, 27.99, 1.4, 1), (9, 26.0, 1.0, 0)]


def report(df, stage):
    rule = (F.col("temperature") >= 28.0) | (F.col("pressure") >= 1.4)
    return qu.quality_report(df, stage, ["ts"], LIMITS, rule, "status_label", "ts").first()


def test_report_before_and_after(spark):
    raw = report(feed(spark), "raw")
    assert raw["n_rows"] == 10 and raw["duplicate_ratio"] == 0.1
    assert raw["missing_ratio"] == 0.1 and raw["validity_ratio"] == 0.1
    assert raw["consistency_ratio"] is None and raw["accuracy"] == "Pass"
    after = report(clean(feed(spark)), "clean")
    assert (after["duplicate_ratio"], after["missing_ratio"], after["validity_ratio"], after["consistency_ratio"]) \
        == (0.0, 0.0, 0.0, 0.0)


def test_empty_table_report(spark):
    empty = feed(spark).where("false")
    r = report(empty, "empty")
    assert r["n_rows"] == 0 and r["duplicate_ratio"] is None and r["accuracy"] is None


def test_cleaning_is_idempotent(spark):
    once = clean(feed(spark))
    twice = clean(once.drop("status_label"))
    assert sorted(once.collect()) == sorted(twice.collect())

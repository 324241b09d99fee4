"""Sources, sinks, model bundle and scoring."""
import os

from pyspark.sql import functions as F

from forgeline.operators import models as mo
from forgeline.sources import io


def test_csv_roundtrip_with_index_and_bom(spark, tmp_dir):
    p = os.path.join(tmp_dir, "in.csv")
    with open(p, "w", encoding="utf-8-sig") as f:
        f.write(",A,B\n0,1.5,x\n1,NaN,None\n2,,y\n")
    df = io.read_table(spark, p, "A double, B string", drop_index=True)
    assert df.columns == ["A", "B"]
    assert [tuple(r) for r in df.collect()] == [(1.5, "x"), (None, None), (None, "y")]
    out = os.path.join(tmp_dir, "out")
    io.write_table(df, out, "csv")
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["A", "B"] and back.count() == 3


def test_splits_and_metrics_sinks(spark, tmp_dir):
    df = spark.createDataFrame([(1, "train"), (2, "test")], "id int, split string")
    io.write_splits(df, os.path.join(tmp_dir, "splits"))
    parts = {d for d in os.listdir(os.path.join(tmp_dir, "splits")) if d.startswith("split=")}
    assert parts == {"split=test", "split=train"}
    io.write_metrics(io.metrics_row(spark, accuracy=0.987, f1=0.796875), os.path.join(tmp_dir, "m"))
    assert spark.read.json(os.path.join(tmp_dir, "m")).first()["f1"] == 0.796875


def test_classifier_bundle_roundtrip(spark, tmp_dir):
    df = spark.range(400).select(F.col("id"), (F.col("id") % 10).cast("double").alias("x"),
                                 (F.col("id") % 10 >= 7).cast("int").alias("y"))
    for kind in ("logistic", "mlp"):
        model = mo.fit_classifier(df, ["x"], "y", kind=kind, max_iter=60, hidden=(4,))
        path = os.path.join(tmp_dir, f"bundle-{kind}")
        mo.save_bundle(model, {"threshold": 0.5}, path)
        loaded, params = mo.load_bundle(spark, path)
        s = mo.score(loaded, df, "p")
        acc = s.select(F.avg(((F.col("p") >= params["threshold"]).cast("int") == F.col("y")).cast("double"))).first()[0]
        assert acc >= 0.9, kind


def test_command_line_runs_a_query_into_a_sink(spark, tmp_dir):
    from forgeline.__main__ import main
    out = os.path.join(tmp_dir, "clean")
    assert main(["q_sensor_clean", "--sf", "/root/testdata/sf0.001", "--out", out, "--format", "csv"]) == 0
    back = spark.read.option("header", True).csv(out)
    assert back.count() == 892 and "status_label" in back.columns

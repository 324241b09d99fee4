"""Workflows on the source layouts, with small generated inputs."""
import datetime as dt
import os

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from forgeline import workflows as wf

INJ = ("seq long, TimeStamp string, EQUIP_CD string, PART_NAME string, Injection_Time double, "
       "Cycle_Time double, Barrel_Temperature_1 double, PassOrFail string, Reason string")


def test_injection_cleanse(spark):
    rows = [
        (0, "t0", "E1", "RH", 5.0, 60.0, 230.0, "Y", None),       # clean
        (1, "t0", "E1", "RH", 5.0, 60.0, 230.0, "Y", None),       # duplicate key -> dropped
        (2, "t1", "E1", "RH", None, 60.0, 230.0, "Y", None),      # missing critical value
        (3, "t2", "E1", "RH", 5.0, 0.0, 230.0, "Y", None),        # non-positive cycle time
        (4, "t3", "E1", "RH", 5.0, 60.0, 230.0, "Y", "flash"),    # pass with a reason
        (5, "t4", "E1", "RH", 60.0, 60.0, 230.0, "N", "short"),   # injection = cycle time
        (6, "t5", "E1", "RH", 5.0, 60.0, 49.9, "Y", None),        # below the barrel limit
        (7, "t6", "E1", "RH", 5.0, 60.0, 50.0, "Y", "None"),      # exactly 50: kept; 'None' is no reason
        (8, "t7", "E1", "RH", 5.0, 60.0, 400.0, None, "flash"),   # exactly 400 and NULL verdict: kept
    ]
    df = spark.createDataFrame(rows, INJ)
    clean, audit = wf.injection_cleanse(df)
    assert sorted(r["seq"] for r in clean.collect()) == [0, 7, 8]
    removed = {r["stage"]: r["removed"] for r in audit.collect()}
    assert removed == {"duplicates": 1, "missing": 1, "non_positive": 1, "label_contradiction": 1,
                       "time_contradiction": 1, "out_of_limits": 1}


def test_sensor_verify_from_bom_csv(spark, tmp_dir):
    p = os.path.join(tmp_dir, "raw.csv")
    t0 = dt.datetime(2026, 3, 24, 21, 28, 34)
    lines = ["Timestamp,Machine_ID,Temperature,Pressure"]
    vals = [(29.5635, 1.2366), (28.6811, 1.1830), (None, 1.0476), (28.2764, 999.9), (25.5137, 1.4850), (25.5137, 1.4850)]
    for i, (t, pr) in enumerate(vals):
        ts = t0 + dt.timedelta(milliseconds=500 * (i if i < 5 else 4))
        lines.append(f"{ts:%Y-%m-%d %H:%M:%S.%f},Machine_A,{'' if t is None else t},{pr}")
    with open(p, "w", encoding="utf-8-sig") as f:
        f.write("\n".join(lines) + "\n")
    clean, report = wf.sensor_verify(wf.read_telemetry(spark, p))
    got = sorted((r["Temperature"], r["Pressure"], r["Status_Label"]) for r in clean.collect())
    assert got == [(25.51, 1.48, 1), (28.68, 1.18, 1), (29.56, 1.24, 1)]  # 1.485 is 1.48499.. in binary
    rep = {r["stage"]: r for r in report.collect()}
    assert rep["raw"]["duplicate_ratio"] == 1 / 6 and rep["raw"]["consistency_ratio"] is None
    assert rep["verified"]["consistency_ratio"] == 0.0 and rep["verified"]["accuracy"] == "Pass"


def test_secom_mdqi_matches_pandas(spark):
    from test_mdqi import S, fixture, pandas_mdqi
    pdf = fixture()
    sdf = spark.createDataFrame(pdf.astype({"label": "float64"}))
    sdf = (sdf.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in S + ["label"]})
           .withColumn("Pass/Fail", F.col("label").cast("int")).drop("label")
           .withColumn("Time", F.col("seq").cast("string")))
    score, clean = wf.secom_mdqi(sdf)
    got = score.first().asDict()
    exp = pandas_mdqi(pdf)
    assert abs(got["mdqi"] - exp["mdqi"]) < 1e-9 and got["rows_final"] == exp["rows_final"]
    assert "s4" not in clean.columns and "s2" not in clean.columns


def test_ai4i_prepare(spark):
    rng = np.random.default_rng(0)
    n = 200
    pdf = pd.DataFrame({"UDI": np.arange(n), "Product ID": [f"P{i}" for i in range(n)],
                        "Type": rng.choice(["L", "M", "H"], n),
                        "Air temperature [K]": rng.normal(300, 2, n), "Process temperature [K]": rng.normal(310, 1, n),
                        "Rotational speed [rpm]": rng.normal(1500, 100, n), "Torque [Nm]": rng.normal(40, 10, n),
                        "Tool wear [min]": rng.integers(0, 250, n).astype(float),
                        "Machine failure": (np.arange(n) % 10 == 0).astype(int)})
    for c in ["TWF", "HDF", "PWF", "OSF", "RNF"]:
        pdf[c] = 0
    train, test, params = wf.ai4i_prepare(spark.createDataFrame(pdf), improved=True)
    assert params["categories"] == ["H", "L", "M"]
    assert {"Type_L", "Type_M", "power", "temp_diff"} <= set(train.columns)
    assert not {"TWF", "Product ID", "Type_H"} & set(train.columns)
    assert test.count() == 40 and test.where("`Machine failure` = 1").count() == 4
    m = train.agg(F.avg("Torque [Nm]"), F.stddev_pop("Torque [Nm]")).first()
    assert abs(m[0]) < 1e-9 and abs(m[1] - 1) < 1e-9


def test_welding_windows_edge_sizes(spark):
    cols = wf.WELD_COLS
    normal = spark.createDataFrame([(i, *[float(i)] * 5) for i in range(61)], ["seq", *cols])
    outlier = spark.createDataFrame([(i, *[float(-i)] * 5) for i in range(200)], ["seq", *cols])
    w = wf.welding_windows(normal, outlier)
    c = {r["series"]: (r["count"], r["lab"]) for r in
         w.groupBy("series").agg(F.count("*").alias("count"), F.max("label").alias("lab")).collect()}
    assert c == {"normal": (1, 0), "outlier": (140, 1)}
    none = wf.welding_windows(normal.where("seq < 60"), outlier.where("seq < 60"))
    assert none.count() == 0


def _ai4i_frame(spark, n=600, seed=1):
    rng = np.random.default_rng(seed)
    torque = rng.normal(40, 10, n)
    wear = rng.integers(0, 250, n).astype(float)
    fail = ((torque > 55) & (wear > 150)).astype(int)
    pdf = pd.DataFrame({"UDI": np.arange(n), "Product ID": [f"P{i}" for i in range(n)],
                        "Type": rng.choice(["L", "M", "H"], n),
                        "Air temperature [K]": rng.normal(300, 2, n), "Process temperature [K]": rng.normal(310, 1, n),
                        "Rotational speed [rpm]": rng.normal(1500, 100, n), "Torque [Nm]": torque,
                        "Tool wear [min]": wear, "Machine failure": fail})
    for c in ["TWF", "HDF", "PWF", "OSF", "RNF"]:
        pdf[c] = 0
    return spark.createDataFrame(pdf)


def test_ai4i_train_evaluate_and_score_records(spark):
    df = _ai4i_frame(spark)
    train, test, params = wf.ai4i_prepare(df, improved=True)
    model, metrics, thr = wf.ai4i_train_evaluate(train, test, kind="logistic", balance="weights", max_iter=50)
    m = metrics.first()
    assert m["roc_auc"] >= 0.8 and m["f1_at_best"] >= m["f1_at_0_5"] - 1e-12 and 0.0 <= thr <= 1.0
    rec = spark.createDataFrame([(9, "H", 302.5, 311.2, 1350.0, 70.0, 215.0), (10, "X", 300.0, 310.0, 1500.0, 30.0, 10.0)],
                                "UDI long, Type string, `Air temperature [K]` double, `Process temperature [K]` double, "
                                "`Rotational speed [rpm]` double, `Torque [Nm]` double, `Tool wear [min]` double")
    out = {r["UDI"]: r for r in wf.ai4i_score(model, params, rec, thr, improved=True).collect()}
    assert out[9]["probability"] > out[10]["probability"]
    assert out[9]["status"].startswith("FAILURE RISK") and out[10]["status"].startswith("normal")


def test_welding_evaluate_separates_anomalies(spark):
    t = np.arange(700)
    normal = pd.DataFrame({"seq": t, **{c: np.sin(t / 10 + k) for k, c in enumerate(wf.WELD_COLS)}})
    rng = np.random.default_rng(3)
    noisy = pd.DataFrame({"seq": t, **{c: np.sin(t / 10 + k) + rng.normal(0, 12, 700) for k, c in enumerate(wf.WELD_COLS)}})
    w = wf.welding_windows(spark.createDataFrame(normal), spark.createDataFrame(noisy), train_rows=300)
    parts = {r["series"]: (r["n"], r["lo"]) for r in w.groupBy("series").agg(F.count("*").alias("n"), F.min("start_ordinal").alias("lo")).collect()}
    assert parts == {"train": (240, 0), "normal": (340, 0), "outlier": (640, 0)}  # no window spans two parts
    scaled = wf.welding_prepare(spark.createDataFrame(normal), spark.createDataFrame(noisy), 300).where("series = 'train'")
    assert scaled.agg(F.min("DV_R"), F.max("DV_R")).first()[0:2] == (0.0, 1.0)
    thr, sweep, m = wf.welding_evaluate(w, {0: 150, 1: 170}, 0.0, 20.0, 100, purge=60)
    assert sweep.count() == 100 and sweep.where("chosen").count() == 1
    r = m.first()
    assert r["accuracy"] >= 0.9 and r["f1"] >= 0.9 and 0.0 <= thr <= 20.0


def test_readers_for_source_files(spark, tmp_dir):
    p = os.path.join(tmp_dir, "secom.csv")
    with open(p, "w") as f:
        f.write("Time,0,1,2,Pass/Fail\n")
        f.write("2008-07-19 11:55:00,1.5,NaN,3,-1\n2008-07-19 12:32:00,2.5,,4,1\n")
    df = wf.read_secom(spark, p, n_sensors=3)
    assert df.columns == ["Time", "0", "1", "2", "Pass/Fail", "seq"]
    assert [tuple(r)[:5] for r in df.orderBy("seq").collect()] == [
        ("2008-07-19 11:55:00", 1.5, None, 3.0, -1), ("2008-07-19 12:32:00", 2.5, None, 4.0, 1)]
    q = os.path.join(tmp_dir, "mould.csv")
    with open(q, "w") as f:
        f.write("TimeStamp,EQUIP_CD,PART_NAME,Injection_Time,Cycle_Time,Barrel_Temperature_1,PassOrFail,Reason,Other\n")
        f.write("t0,E1,RH,5,60,230,Y,None,x\n")
    m = wf.read_moulding(spark, q).first()
    assert m["Injection_Time"] == 5.0 and m["Reason"] is None and m["Other"] == "x"


def test_balancing_schemes_and_the_unsupported_pair(spark):
    import pytest
    train, test, _ = wf.ai4i_prepare(_ai4i_frame(spark))
    feats = [c for c in train.columns if c not in ("Machine failure", "UDI")]
    n = {r[0]: r[1] for r in train.groupBy("Machine failure").count().collect()}
    for how in ("sampler", "smote", "oversample"):
        rows, weight = wf.balance_rows(train, "Machine failure", feats, how)
        got = {r[0]: r[1] for r in rows.groupBy("Machine failure").count().collect()}
        assert weight is None
        if how == "sampler":
            assert sum(got.values()) == sum(n.values()) and abs(got[1] - got[0]) < 0.2 * sum(n.values())
        else:
            assert got[0] == got[1] == max(n.values())
    with pytest.raises(ValueError):
        wf.ai4i_train_evaluate(train, test, kind="mlp", balance="weights")


def test_files_keep_their_order(spark, tmp_dir):
    """A small file before a large one: rows are numbered in file order."""
    from forgeline.sources import io
    d = os.path.join(tmp_dir, "many")
    os.makedirs(d)
    for name, rows in (("a.csv", 3), ("b.csv", 30000)):
        with open(os.path.join(d, name), "w") as f:
            f.write("x\n" + "\n".join(f"{name[0]}{i}" for i in range(rows)) + "\n")
    df = io.with_seq(io.read_table(spark, d, "x string"))
    got = [r["x"] for r in df.orderBy("seq").limit(5).collect()]
    assert got == ["a0", "a1", "a2", "b0", "b1"]

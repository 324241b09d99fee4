"""End-to-end workflows on the source workloads' own file layouts.

Each function composes library operators for one kind of input a user of
the source scripts already has (column names as in those files).  They read
with a declared schema and keep file order in an explicit ``seq`` column so
"keep the first" means what it meant there.  They are not registered driver
queries (the driver tables have other schemas); tests run them on small
generated files.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import cleansing as cl
from .operators import duplicates as du
from .operators import features as fe
from .operators import profiling as pr
from .operators import quality as qu
from .operators import sequences as sq
from .plans import fixed as fx
from .sources import io


# ------------------------------------------------------------ moulding log
MOULDING_TYPES = {"TimeStamp": "string", "EQUIP_CD": "string", "PART_NAME": "string",
                  "Injection_Time": "double", "Cycle_Time": "double", "Barrel_Temperature_1": "double",
                  "PassOrFail": "string", "Reason": "string"}


def read_moulding(spark: SparkSession, path: str) -> DataFrame:
    """The moulding log: every column read as text (no inference pass over
    the data), the used ones cast, missing tokens normalised, file order kept."""
    raw = spark.read.option("header", True).csv(path)
    typed = raw.withColumns({c: F.col(f"`{c}`").cast(t) for c, t in MOULDING_TYPES.items() if c in raw.columns})
    from .operators.cleansing import na_normalise
    return io.with_seq(na_normalise(typed))


def injection_cleanse(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Moulding cycles (TimeStamp, EQUIP_CD, PART_NAME, Injection_Time,
    Cycle_Time, Barrel_Temperature_1, PassOrFail, Reason, seq): the five
    rule stages in order; returns (clean rows, stage audit)."""
    key = ["TimeStamp", "EQUIP_CD", "PART_NAME"]
    critical = ["Injection_Time", "Cycle_Time", "Barrel_Temperature_1"]
    rules = {
        "missing": cl.missing_any(critical),
        "non_positive": cl.non_positive(["Cycle_Time", "Injection_Time"]),
        "label_contradiction": cl.label_reason_contradiction("PassOrFail", fx.PASS_TOKEN, "Reason",
                                                             fx.NO_REASON_TOKEN),
        "time_contradiction": cl.order_contradiction("Injection_Time", "Cycle_Time"),
        "out_of_limits": cl.out_of_limits({"Barrel_Temperature_1": fx.BARREL_LIMITS}),
    }
    first = du.dedupe(df, key, ["seq"])
    clean = first
    for pred in rules.values():
        clean = cl.drop_where(clean, pred)
    return clean, pr.audit(first, rules, upstream=df, upstream_stage="duplicates")


# ------------------------------------------------------- telemetry capture
TELEMETRY_SCHEMA = "Timestamp timestamp_ntz, Machine_ID string, Temperature double, Pressure double"


def read_telemetry(spark: SparkSession, path: str) -> DataFrame:
    return io.with_seq(io.read_table(spark, path, TELEMETRY_SCHEMA))


def sensor_verify(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Telemetry capture: dedupe on Timestamp (first kept), drop rows with any
    NULL, closed ranges, round half-even, rule label; returns (verified rows,
    report before and after)."""
    limits = {"Temperature": fx.SENSOR_LIMITS["temperature"], "Pressure": fx.SENSOR_LIMITS["pressure"]}
    rule = (F.col("Temperature") >= fx.STATUS_MIN_TEMPERATURE) | (F.col("Pressure") >= fx.STATUS_MIN_PRESSURE)
    clean = du.dedupe(df, ["Timestamp"], ["seq"])
    clean = cl.keep_in_range(cl.drop_missing(clean), limits)
    clean = cl.label_by_rule(cl.round_columns(clean, list(limits), fx.ROUND_DIGITS), rule, "Status_Label")
    args = dict(key_cols=["Timestamp"], limits=limits, rule=rule, label_col="Status_Label", time_col="Timestamp")
    report = qu.quality_report(df, "raw", **args).unionByName(qu.quality_report(clean, "verified", **args))
    return clean.drop("seq"), report


# ------------------------------------------------------- wide sensor table
def secom_schema(n_sensors: int = 590) -> str:
    """Time, sensors named 0..n-1 (doubles), Pass/Fail -- built from the rule."""
    sensors = ", ".join(f"`{i}` double" for i in range(n_sensors))
    return f"Time string, {sensors}, `Pass/Fail` int"


def read_secom(spark: SparkSession, path: str, n_sensors: int = 590) -> DataFrame:
    return io.with_seq(io.read_table(spark, path, secom_schema(n_sensors)))


def secom_mdqi(df: DataFrame, time_col: str = "Time", label: str = "Pass/Fail") -> tuple[DataFrame, DataFrame]:
    """Wide sensor table (time, sensors..., label in {-1, 1}, seq): the MDQI
    cascade; returns (score row, cleaned table)."""
    sensors = [c for c in df.columns if c not in (time_col, label, "seq")]
    c = qu.WideCascade(df, sensors, label, ["seq"], label_domain=fx.LABEL_DOMAIN,
                       col_threshold=fx.SPARSE_SHARE, row_threshold=fx.SPARSE_SHARE, k=fx.IQR_K)
    return c.score(), c.final()


# ------------------------------------------------------ failure table
AI4I_NUMERIC = ["Air temperature [K]", "Process temperature [K]", "Rotational speed [rpm]", "Torque [Nm]",
                "Tool wear [min]"]
AI4I_LEAKAGE = ["TWF", "HDF", "PWF", "OSF", "RNF"]


def ai4i_prepare(df: DataFrame, improved: bool = False) -> tuple[DataFrame, DataFrame, dict]:
    """Failure table: drop identifiers, one-hot Type (first sorted category
    dropped), drop leakage columns, optional derived features, stratified
    80/20 split, standard scaling fitted on train.  Returns (train, test,
    params) with params = scaler constants and the category list."""
    target = "Machine failure"
    work = df.drop("Product ID")
    if improved:
        work = fe.derive(work, fe.power_and_delta("Torque [Nm]", "Rotational speed [rpm]",
                                                  "Process temperature [K]", "Air temperature [K]"))
    work, cats = fe.one_hot(work, "Type")
    work = work.drop(*AI4I_LEAKAGE)
    numeric = AI4I_NUMERIC + (["power", "temp_diff"] if improved else [])
    sp = fe.stratified_split(work, target, "UDI", test_percent=fx.TEST_PERCENT, seed=fx.SEED)
    params = fe.fit_standard(sp.where(F.col("split") == "train"), numeric)
    scaled = fe.apply_scale(sp, params)  # UDI stays: the key of reproducible sampling, not a feature
    return (scaled.where(F.col("split") == "train").drop("split"),
            scaled.where(F.col("split") == "test").drop("split"), {"scaler": params, "categories": cats})


# ------------------------------------------------------------- welding
WELD_COLS = ["DV_R", "DA_R", "AV_R", "AA_R", "PM_R"]


WELD_TRAIN_ROWS = 60_000  # fixed: the first normal rows train the model


def welding_prepare(normal: DataFrame, outlier: DataFrame, train_rows: int = WELD_TRAIN_ROWS) -> DataFrame:
    """Two welding files (normal, outlier), each with an explicit ``seq``: the
    first ``train_rows`` normal rows are the part 'train', the rest 'normal', the
    outlier file 'outlier'; label 0/1 per file; all columns min-max scaled with
    the constants of the train part."""
    split = fe.split_by_ordinal(normal.select("seq", *WELD_COLS), ["seq"], train_rows, "series", "train", "normal").drop("_ord")
    a = cl.with_constant(split, "FIN_JGMT", 0)
    b = cl.with_constant(outlier.select("seq", *WELD_COLS), "FIN_JGMT", 1).withColumn("series", F.lit("outlier"))
    params = fe.fit_minmax(a.where(F.col("series") == "train"), WELD_COLS)
    return fe.apply_scale(a.unionByName(b), params)


def welding_windows(normal: DataFrame, outlier: DataFrame, train_rows: int | None = None) -> DataFrame:
    """20-in / 20-gap / 20-out windows with the label 60 rows ahead, within each
    part of ``welding_prepare`` (``train_rows`` None: each file is one unscaled
    part)."""
    if train_rows is None:
        a = cl.with_constant(normal.select("seq", *WELD_COLS), "FIN_JGMT", 0).withColumn("series", F.lit("normal"))
        b = cl.with_constant(outlier.select("seq", *WELD_COLS), "FIN_JGMT", 1).withColumn("series", F.lit("outlier"))
        both = a.unionByName(b)
    else:
        both = welding_prepare(normal, outlier, train_rows)
    return sq.sequence_windows(both, "series", ["seq"], WELD_COLS, label="FIN_JGMT",
                               length=fx.WINDOW_LENGTH, gap=fx.WINDOW_GAP, horizon=fx.WINDOW_HORIZON)


def balance_rows(train: DataFrame, target: str, feats, how: str, key: str = "UDI") -> tuple[DataFrame, str | None]:
    """Training rows under a balancing scheme, and the weight column if it has one."""
    if how == "weights":
        return fe.with_row_weight(train, target, "_w"), "_w"
    if how == "sampler":
        return fe.balanced_sample(train, target, key, seed=fx.SEED).drop("copy"), None
    if how == "smote":
        from .operators.smote import smote
        return smote(train.select(key, *feats, target), key, feats, target, seed=fx.SEED).select(*feats, target), None
    if how == "oversample":
        return fe.oversample(train, target, key, seed=fx.SEED).drop("copy"), None
    if how == "none":
        return train, None
    raise ValueError(f"balance: {how}")


def ai4i_train_evaluate(train: DataFrame, test: DataFrame, kind: str = "mlp", balance: str = "sampler",
                        hidden=(32, 16), max_iter: int = 100) -> tuple[object, DataFrame, float]:
    """Train the failure classifier and evaluate it on the test rows.

    ``balance``: 'sampler' (draws with replacement, weight 1 / class size),
    'smote' (synthetic minority rows), 'oversample' (exact replication of the
    minority), 'weights' (inverse class frequency as row weights; logistic and gbt
    only, an error for the perceptron) or 'none'.  Returns (model, one-row metrics
    at 0.5 and at the best-F1 threshold, best threshold)."""
    from .operators import evaluation as ev
    from .operators import models as mo
    target = "Machine failure"
    feats = [c for c in train.columns if c not in (target, "UDI")]
    fit_on, weight = balance_rows(train, target, feats, balance)
    model = mo.fit_classifier(fit_on, feats, target, kind=kind, weight_col=weight,
                              hidden=hidden, max_iter=max_iter, seed=fx.SEED)
    scored = mo.score(model, test, "probability")
    thr = ev.best_f1_threshold(scored, target, "probability", eps=fx.F1_EPSILON).first()["threshold"]
    names = ("accuracy", "precision", "recall", "f1")
    base = ev.classification_metrics(sq.decide(scored, "probability", fx.DECISION_THRESHOLD), target, "pred").first()
    best = ev.classification_metrics(sq.decide(scored, "probability", thr), target, "pred").first()
    auc = ev.roc_auc(scored, target, "probability").first()["auc"]
    values = {**{f"{c}_at_0_5": base[c] for c in names}, **{f"{c}_at_best": best[c] for c in names},
              "roc_auc": auc, "threshold": thr}
    metrics = io.metrics_row(train.sparkSession, **values)  # one row, ready for write_metrics (A7)
    return model, metrics, thr


def ai4i_score(model, params: dict, records: DataFrame, threshold: float = fx.DECISION_THRESHOLD,
               improved: bool = False) -> DataFrame:
    """Score new records (batch or stream) exactly as training prepared them:
    saved categories for the one-hot (unseen -> zeros), derived features,
    the trained feature order, the saved scaler; adds probability, pred and
    a status text."""
    from .operators import models as mo
    work = records
    if improved:
        work = fe.derive(work, fe.power_and_delta("Torque [Nm]", "Rotational speed [rpm]",
                                                  "Process temperature [K]", "Air temperature [K]"))
    work, _ = fe.one_hot(work, "Type", cats=params["categories"])
    work = fe.apply_scale(work, {c: tuple(v) for c, v in params["scaler"].items()})
    feats = model.stages[0].getInputCols()
    aligned = cl.align_features(work, feats, fill=0)
    keep = [c for c in work.columns if c not in feats]
    out = mo.score(model, work.select(*keep, *[aligned[c] for c in feats]) if keep else aligned, "probability")
    out = sq.decide(out, "probability", threshold)
    return out.withColumn("status", F.when(F.col("pred") == 1, F.format_string("FAILURE RISK (%.2f%%)",
                                                                              F.col("probability") * 100))
                          .otherwise(F.format_string("normal (%.2f%%)", F.col("probability") * 100)))


def welding_evaluate(windows: DataFrame, firsts: dict, lo: float = 0.0, hi: float = 20.0, n: int = 100,
                     purge: int = 0) -> tuple[float, DataFrame, DataFrame]:
    """Window anomaly evaluation: the windows of the part 'train' fit the
    forecaster; of the others, per class the first ``firsts[class]``
    windows are the validation split (optionally purging overlaps); the
    last-step error is swept over linspace(lo, hi, n) with strict '>' on the
    validation split and the first minimum of |P - R| is chosen; returns
    (threshold, sweep table, test metrics)."""
    from .operators import evaluation as ev
    from .operators import forecast as fo
    train = windows.where(F.col("series") == "train")
    sp = sq.split_windows(windows.where(F.col("series") != "train"), "label", firsts, "series", ["series", "start_ordinal"], purge=purge)
    model = fo.fit_forecaster(train, WELD_COLS, fx.WINDOW_LENGTH, fx.WINDOW_HORIZON)
    err = fo.step_errors(fo.forecast(sp, model), model)
    sweep = ev.sweep_thresholds(err.where(F.col("split") == "valid"), "label", "error", lo, hi, n)
    thr = sweep.where(F.col("chosen")).first()["threshold"]
    test = sq.decide(err.where(F.col("split") == "test"), "error", thr, strict=True)
    return thr, sweep, ev.classification_metrics(test, "label", "pred")


def image_evaluate(spark: SparkSession, root: str, category: str, size: int = 256,
                   kernel: int = fx.GAUSSIAN_TAPS) -> tuple[DataFrame, DataFrame]:
    """Image anomaly evaluation for one category of an image tree: mean
    normal image from train/good, smoothed error maps, max-score per image,
    best-F1 threshold (lowest on ties), verdict ``score >= threshold``;
    returns (scored test images with heat maps, one-row metrics incl. AUROC)."""
    from .operators import evaluation as ev
    from .operators import images as im
    tree = im.read_image_tree(spark, root).where(F.col("category") == category)
    grid = im.image_grid(tree, size)
    normal = im.fit_normal_image(grid.where((F.col("split") == "train") & (F.col("label") == 0)))
    test = im.normalise_map(im.image_score(im.error_maps(grid.where(F.col("split") == "test"), normal, size,
                                                        kernel=kernel)))
    thr = ev.best_f1_threshold(test, "label", "score", eps=fx.F1_EPSILON).first()["threshold"]
    verdict = sq.decide(test, "score", thr).withColumn("verdict", F.when(F.col("pred") == 1, F.lit("NG"))
                                                       .otherwise(F.lit("OK")))
    m = ev.classification_metrics(verdict, "label", "pred").first()
    auc = ev.roc_auc(test, "label", "score").first()["auc"]
    metrics = io.metrics_row(spark, accuracy=m["accuracy"], precision=m["precision"], recall=m["recall"],
                             f1=m["f1"], auroc=auc if auc is not None else float("nan"), threshold=thr)
    return verdict.drop("pixels"), metrics

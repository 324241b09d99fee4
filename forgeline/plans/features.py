"""Feature preparation, sampling and sequence-window queries
(B9-B12, C1, C2, F1-F16, G5-G7)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleansing as cl
from ..operators import features as fe
from ..operators import sequences as sq
from ..functions.metadata import class_counts
from . import fixed as fx
from . import views as v
from .registry import r6, register

def line_id():
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")
LINE_ID_SQL = "l_orderkey * 8 + l_linenumber"
CATS = ["error", "purchase", "signup", "view"]


@register("q_one_hot", """
SELECT event_id, """ + ", ".join(f"CAST(event_type = '{c}' AS INTEGER) AS event_type_{c}" for c in CATS)
          + " FROM events")
def q_one_hot(spark, sf_dir):
    """one-hot of the event type with the first sorted category dropped."""
    ev = v.table(spark, sf_dir, "events").select("event_id", "event_type")
    out, _cats = fe.one_hot(ev, "event_type")
    return out


MODEL_COLS = ["value", "user_id", *[f"event_type_{c}" for c in CATS], "event_type_unseen"]


@register("q_model_input", """
SELECT event_id, value, user_id, """ + ", ".join(
    f"CAST(coalesce(event_type = '{c}', FALSE) AS INTEGER) AS event_type_{c}" for c in CATS)
          + ", 0 AS event_type_unseen FROM events")
def q_model_input(spark, sf_dir):
    """B9/B10 (drop ids and leakage columns), F2 (encode with saved
    categories), B12 (align to the trained feature order; a feature the
    data lacks is filled with 0)."""
    ev = v.table(spark, sf_dir, "events")
    feats = cl.feature_columns(ev, target="props", leakage=["ts"], ids=[])
    enc, _ = fe.one_hot(ev.select(*feats), "event_type", cats=["click", *CATS])
    return cl.align_features(enc, ["event_id", *MODEL_COLS], fill=0)


@register("q_derive", f"""
SELECT {LINE_ID_SQL} AS line_id,
       l_quantity * l_extendedprice * (2 * pi()) / CAST(60.0 AS DOUBLE) AS power,
       l_tax - l_discount AS temp_diff FROM lineitem""")
def q_derive(spark, sf_dir):
    """derived power (torque x speed x 2pi / 60) and a difference feature."""
    li = v.table(spark, sf_dir, "lineitem")
    d = fe.derive(li, fe.power_and_delta("l_quantity", "l_extendedprice", "l_tax", "l_discount"))
    return d.select(line_id().alias("line_id"), "power", "temp_diff")


def line_key():
    """Unique line key: (orderkey, linenumber) repeats in the generated data."""
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


LINE_KEY_SQL = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def _split(spark, sf_dir):
    li = v.table(spark, sf_dir, "lineitem").select(
        line_key().alias("line_id"), "l_linestatus", "l_quantity", "l_extendedprice", "l_discount")
    return fe.stratified_split(li, "l_linestatus", "line_id", test_percent=fx.TEST_PERCENT, seed=fx.SEED)


SPLIT_SQL = f"""
WITH base AS (SELECT {LINE_KEY_SQL} AS line_id, l_linestatus, l_quantity, l_extendedprice, l_discount FROM lineitem),
rk AS (SELECT *, row_number() OVER (PARTITION BY l_linestatus ORDER BY md5(CAST(line_id AS VARCHAR) || '42')) AS r,
              COUNT(*) OVER (PARTITION BY l_linestatus) AS n FROM base),
parts AS (SELECT l_linestatus, COUNT(*) AS n, COUNT(*) * 20 // 100 AS base, COUNT(*) * 20 % 100 AS rest
          FROM base GROUP BY l_linestatus),
quota AS (SELECT l_linestatus, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, n DESC, l_linestatus)
                 <= (SELECT (SUM(n) * 20 + 99) // 100 - SUM(base) FROM parts) THEN 1 ELSE 0 END AS q FROM parts),
sp AS (SELECT rk.*, CASE WHEN r <= q THEN 'test' ELSE 'train' END AS split
       FROM rk JOIN quota ON rk.l_linestatus = quota.l_linestatus)"""


@register("q_split", SPLIT_SQL + "\nSELECT line_id, l_linestatus, split FROM sp")
def q_split(spark, sf_dir):
    """stratified 80/20 split in md5(key || seed) order, exact quotas."""
    return _split(spark, sf_dir).select("line_id", "l_linestatus", "split")


SCALE_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@register("q_standard_scale", SPLIT_SQL + """
, fit AS (SELECT """ + ", ".join(f"AVG({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1.0) AS s_{c}"
                                  for c in SCALE_COLS) + """ FROM sp WHERE split = 'train')
SELECT line_id, split, """ + ", ".join(f"ROUND(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in SCALE_COLS)
          + " FROM sp, fit")
def q_standard_scale(spark, sf_dir):
    """F5 + C1: standard scaling fitted on the train split only, applied to all."""
    sp = _split(spark, sf_dir)
    params = fe.fit_standard(sp.where(F.col("split") == "train"), SCALE_COLS)
    out = fe.apply_scale(sp, params)
    return out.select("line_id", "split", *[r6(c).alias(c) for c in SCALE_COLS])


@register("q_minmax_scale", SPLIT_SQL + """
, fit AS (SELECT """ + ", ".join(f"MIN({c}) AS lo_{c}, coalesce(nullif(MAX({c}) - MIN({c}), 0), 1.0) AS r_{c}"
                                  for c in SCALE_COLS) + """ FROM sp WHERE split = 'train' AND l_linestatus = 'O')
SELECT line_id, split, """ + ", ".join(f"ROUND(({c} - lo_{c}) / r_{c}, 6) AS {c}" for c in SCALE_COLS)
          + " FROM sp, fit")
def q_minmax_scale(spark, sf_dir):
    """F6 + F16: min-max scaling fitted on the normal ('O') train rows only."""
    sp = _split(spark, sf_dir)
    params = fe.fit_minmax(sp.where((F.col("split") == "train") & (F.col("l_linestatus") == "O")), SCALE_COLS)
    out = fe.apply_scale(sp, params)
    return out.select("line_id", "split", *[r6(c).alias(c) for c in SCALE_COLS])


@register("q_split_ordinal", """
WITH o AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS ord, COUNT(*) OVER () AS n FROM events)
SELECT event_id, CASE WHEN ord < n * 8 // 10 THEN 'train' ELSE 'test' END AS split FROM o""")
def q_split_ordinal(spark, sf_dir):
    """the first 80 % of events in time order train, the rest test."""
    ev = v.table(spark, sf_dir, "events").select("event_id", "ts")
    n = ev.count()
    return fe.split_by_ordinal(ev, ["ts", "event_id"], n * 8 // 10).select("event_id", "split")


@register("q_class_weights", """
SELECT quality, COUNT(*) AS count, 1.0 / COUNT(*) AS weight FROM labels GROUP BY quality""")
def q_class_weights(spark, sf_dir):
    """inverse-frequency class weights."""
    return fe.class_weights(v.table(spark, sf_dir, "labels"), "quality")


@register("q_row_weights", """
SELECT l.doc_id, l.quality, 1.0 / c.n AS weight
FROM labels l JOIN (SELECT quality, COUNT(*) AS n FROM labels GROUP BY quality) c ON l.quality = c.quality""")
def q_row_weights(spark, sf_dir):
    """Per-row weight looked up from the class table."""
    lab = v.table(spark, sf_dir, "labels").select("doc_id", "quality")
    return fe.with_row_weight(lab, "quality").select("doc_id", "quality", "weight")


@register("q_oversample", """
WITH c AS (SELECT quality, COUNT(*) AS n FROM labels GROUP BY quality),
plan AS (SELECT quality, (SELECT MAX(n) FROM c) // n AS full_copies, (SELECT MAX(n) FROM c) % n AS q FROM c),
rk AS (SELECT l.doc_id, l.quality,
              row_number() OVER (PARTITION BY l.quality ORDER BY md5(CAST(l.doc_id AS VARCHAR) || '42')) AS r
       FROM labels l),
k AS (SELECT rk.doc_id, rk.quality, full_copies + CASE WHEN r <= q THEN 1 ELSE 0 END AS copies
      FROM rk JOIN plan ON rk.quality = plan.quality)
SELECT doc_id, quality, CAST(copy AS INTEGER) AS copy FROM k, unnest(range(copies)) t(copy)""")
def q_oversample(spark, sf_dir):
    """F9 + F11: exact random oversampling of the minority to the majority count."""
    lab = v.table(spark, sf_dir, "labels").select("doc_id", "quality")
    return fe.oversample(lab, "quality", "doc_id", seed=42).select("doc_id", "quality", "copy")


def _unit_sql(what: str) -> str:
    return f"CAST(CAST('0x' || substr(md5(CAST(j AS VARCHAR) || '-42-{what}'), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656.0"


@register("q_balanced", f"""
WITH c AS (SELECT quality, COUNT(*) AS n, row_number() OVER (ORDER BY quality NULLS FIRST) - 1 AS i FROM labels GROUP BY quality),
rk AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY doc_id) - 1 AS r FROM labels),
j AS (SELECT unnest(range((SELECT COUNT(*) FROM labels))) AS j),
d AS (SELECT CAST(floor({_unit_sql('class')} * (SELECT COUNT(*) FROM c)) AS BIGINT) AS i, {_unit_sql('row')} AS u FROM j),
t AS (SELECT c.quality, CAST(floor(u * n) AS BIGINT) AS r, COUNT(*) AS times FROM d JOIN c ON d.i = c.i GROUP BY 1, 2)
SELECT rk.doc_id, rk.quality, CAST(copy AS BIGINT) AS copy
FROM t JOIN rk ON t.quality = rk.quality AND t.r = rk.r, unnest(range(times)) x(copy)""")
def q_balanced(spark, sf_dir):
    """F8: weighted sampling with replacement, hashed draws."""
    lab = v.table(spark, sf_dir, "labels").select("doc_id", "quality")
    return fe.balanced_sample(lab, "quality", "doc_id", seed=42)


@register("q_shuffle", """
SELECT doc_id, row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || '42')) - 1 AS shuffle_index FROM labels""")
def q_shuffle(spark, sf_dir):
    """reproducible shuffled order as a global index."""
    lab = v.table(spark, sf_dir, "labels").select("doc_id")
    return fe.hash_shuffle(lab, "doc_id", seed=42)


# ------------------------------------------------------------ sequence windows
def _series(spark, sf_dir):
    ev = v.table(spark, sf_dir, "events")
    return ev.select("event_id", "user_id", "ts", "value",
                     F.get_json_object("props", "$.k").cast("double").alias("k"),
                     (F.col("event_type") == "error").cast("int").alias("fault"))


def windows(spark, sf_dir):
    return sq.sequence_windows(_series(spark, sf_dir), "user_id", ["ts", "event_id"], ["value", "k"],
                               label="fault", length=fx.WINDOW_LENGTH, gap=fx.WINDOW_GAP,
                               horizon=fx.WINDOW_HORIZON)


WIN_SQL = """
WITH s AS (SELECT event_id, user_id, ts, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
                  CAST(event_type = 'error' AS INTEGER) AS fault FROM events),
o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS ord FROM s),
wv AS (SELECT user_id, ord AS start_ordinal, ts AS start_ts,
              SUM(value) OVER (PARTITION BY user_id ORDER BY ord ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS in_sum,
              lead(value, 19) OVER (PARTITION BY user_id ORDER BY ord) AS in_last_value,
              lead(k, 19) OVER (PARTITION BY user_id ORDER BY ord) AS in_last_k,
              lead(value, 59) OVER (PARTITION BY user_id ORDER BY ord) AS target_last_value,
              lead(k, 59) OVER (PARTITION BY user_id ORDER BY ord) AS target_last_k,
              lead(fault, 60) OVER (PARTITION BY user_id ORDER BY ord) AS label,
              lead(ord, 60) OVER (PARTITION BY user_id ORDER BY ord) AS endo FROM o),
w AS (SELECT * FROM wv WHERE endo IS NOT NULL)"""


@register("q_windows", WIN_SQL + """
SELECT user_id, start_ordinal, start_ts, ROUND(in_sum, 6) AS in_sum, in_last_value, target_last_value, label FROM w""")
def q_windows(spark, sf_dir):
    """20-step input, 20-step gap, 20-step target, label at +60, per user."""
    w = windows(spark, sf_dir)
    return w.select("user_id", "start_ordinal", "start_ts",
                    r6(F.aggregate(F.col("input.value"), F.lit(0.0), lambda a, x: a + x)).alias("in_sum"),
                    sq.last_step("input", "value").alias("in_last_value"),
                    sq.last_step("target", "value").alias("target_last_value"), "label")


@register("q_window_split", WIN_SQL + """
, r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY user_id, start_ordinal) - 1 AS rk,
               COUNT(*) OVER (PARTITION BY label) AS n FROM w)
SELECT user_id, start_ordinal, label, CASE WHEN rk < n // 4 THEN 'valid' ELSE 'test' END AS split,
       rk < n // 4 AND label = 0 AS valid_normal FROM r""")
def q_window_split(spark, sf_dir):
    """F15 + F16: per class the first quarter of windows (series order) is
    the validation split; its normal windows form the normal-only subset."""
    w = windows(spark, sf_dir).select("user_id", "start_ordinal", "label")
    counts = class_counts(w, "label")
    sp = sq.split_windows(w, "label", {k: n // 4 for k, n in counts.items()}, "user_id",
                          ["user_id", "start_ordinal"])
    return sp.withColumn("valid_normal", (F.col("split") == "valid") & (F.col("label") == 0))


@register("q_forecast_error", WIN_SQL + """
SELECT user_id, start_ordinal,
       ROUND((pow(target_last_value - in_last_value, 2) + pow(target_last_k - in_last_k, 2)) / 2, 6) AS error,
       CASE WHEN (pow(target_last_value - in_last_value, 2) + pow(target_last_k - in_last_k, 2)) / 2 > 5000.0
            THEN 1 ELSE 0 END AS pred
FROM w""")
def q_forecast_error(spark, sf_dir):
    """G6 + G7 with a persistence forecaster: last-step MSE over the two
    features and the strict-threshold anomaly decision."""
    w = sq.forecast_error(windows(spark, sf_dir), ["value", "k"])
    w = sq.decide(w, "error", 5000.0, strict=True)
    return w.select("user_id", "start_ordinal", r6("error").alias("error"), "pred")


# ------------------------------------------------------------------ SMOTE
def _minority_lines(spark, sf_dir):
    """Lines without discount (about 5 %) against the rest; three features on
    comparable scales."""
    li = v.table(spark, sf_dir, "lineitem")
    return li.select(line_key().alias("line_id"), F.col("l_quantity").alias("qty"),
                     (F.col("l_extendedprice") / F.lit(1000.0)).alias("price_k"),
                     (F.col("l_tax") * F.lit(100.0)).alias("tax_pct"),
                     (F.col("l_discount") == 0.0).cast("int").alias("y"))


@register("q_knn", f"""
WITH m AS (SELECT {LINE_KEY_SQL} AS line_id, l_quantity AS qty, l_extendedprice / CAST(1000.0 AS DOUBLE) AS price_k,
                  l_tax * CAST(100.0 AS DOUBLE) AS tax_pct FROM lineitem WHERE l_discount = 0.0),
p AS (SELECT a.line_id, b.line_id AS nn_key,
             (a.qty - b.qty) * (a.qty - b.qty) + (a.price_k - b.price_k) * (a.price_k - b.price_k)
             + (a.tax_pct - b.tax_pct) * (a.tax_pct - b.tax_pct) AS dist2
      FROM m a JOIN m b ON a.line_id <> b.line_id)
SELECT line_id, nn_key, CAST(row_number() OVER (PARTITION BY line_id ORDER BY dist2, nn_key) AS INTEGER) AS nn_rank,
       ROUND(dist2, 6) AS dist2
FROM p QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY dist2, nn_key) <= 5""")
def q_knn(spark, sf_dir):
    """F10 neighbour search: exact 5 nearest minority neighbours (k-d cells and
    visits, no all-pairs); the oracle is DuckDB brute force."""
    from ..operators.neighbours import knn_exact
    m = _minority_lines(spark, sf_dir).where(F.col("y") == 1).drop("y")
    nn = knn_exact(m, "line_id", ["qty", "price_k", "tax_pct"], k=fx.SMOTE_K)
    return nn.select("line_id", "nn_key", F.col("nn_rank").cast("int").alias("nn_rank"), r6("dist2").alias("dist2"))


@register("q_smote")
def q_smote(spark, sf_dir):
    """SMOTE of the no-discount minority up to the majority count
    (hash-drawn neighbour and gap: rows-only check)."""
    from ..operators.smote import smote
    return smote(_minority_lines(spark, sf_dir), "line_id", ["qty", "price_k", "tax_pct"], "y",
                 k=fx.SMOTE_K, seed=fx.SEED)

"""Model queries.

* ``q_classifier_scores``: split, scale on train, class weights, weighted
  logistic regression, bundle save/load, scoring and the 0.5 decision
  (F4, F5, F7, C2, G1-G3, A8).
* ``q_forecast_linear``, ``q_forecast_gram``: forecaster of the whole target fitted
  on normal windows, errors and the strict-threshold decision (G5-G7); the second
  uses the last input step alone and has an oracle.
* ``q_subspace_anomaly``: low-rank reconstruction of the embeddings (G8).
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as fe
from ..operators import forecast as fo
from ..operators import models as mo
from ..operators import sequences as sq
from ..operators import subspace as su
from ..session import ensure_checkpoint_dir
from . import features as fp
from . import fixed as fx
from . import views as v
from .registry import register

FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("q_classifier_scores")
def q_classifier_scores(spark, sf_dir):
    """Failure-style classifier on ``lineitem`` (label: return flag 'R')."""
    import uuid
    li = v.table(spark, sf_dir, "lineitem").select(
        fp.line_key().alias("line_id"), *FEATS, (F.col("l_returnflag") == "R").cast("int").alias("y"))
    sp = fe.stratified_split(li, "y", "line_id", test_percent=20, seed=42)
    train = sp.where(F.col("split") == "train")
    params = fe.fit_standard(train, FEATS)
    train = fe.with_row_weight(fe.apply_scale(train, params), "y", "w")
    model = mo.fit_classifier(train, FEATS, "y", kind="logistic", weight_col="w", max_iter=50)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bundles/clf-{uuid.uuid4().hex[:12]}"
    mo.save_bundle(model, {"scaler": params, "threshold": 0.5}, path)
    model, saved = mo.load_bundle(spark, path)
    test = fe.apply_scale(sp.where(F.col("split") == "test"), {k: tuple(v) for k, v in saved["scaler"].items()})
    scored = mo.score(model, test, "probability")
    return sq.decide(scored, "probability", saved["threshold"]).select("line_id", "y", "probability", "pred")


@register("q_forecast_linear")
def q_forecast_linear(spark, sf_dir):
    """Window forecaster on all input steps, fitted on normal windows (label 0)."""
    w = fp.windows(spark, sf_dir)
    model = fo.fit_forecaster(w.where(F.col("label") == 0), ["value", "k"], fx.WINDOW_LENGTH, fx.WINDOW_HORIZON)
    err = fo.step_errors(fo.forecast(w, model), model)
    return sq.decide(err, "error", 5000.0, strict=True).select("user_id", "start_ordinal", "label", "error", "error_all", "pred")


@register("q_forecast_gram", fp.WIN_SQL.replace("lead(fault, 60)", """list(value) OVER (PARTITION BY user_id ORDER BY ord ROWS BETWEEN 40 FOLLOWING AND 59 FOLLOWING) AS tv,
              list(k) OVER (PARTITION BY user_id ORDER BY ord ROWS BETWEEN 40 FOLLOWING AND 59 FOLLOWING) AS tk,
              lead(fault, 60)""") + """,
t AS (SELECT user_id, start_ordinal, label, in_last_value AS x1, in_last_k AS x2, unnest(tv) AS yv, unnest(tk) AS yk, generate_subscripts(tv, 1) AS step FROM w),
f AS (SELECT step, AVG(x1) AS m1, AVG(x2) AS m2, var_pop(x1) AS s11, var_pop(x2) AS s22, covar_pop(x1, x2) AS s12, AVG(yv) AS mv, covar_pop(x1, yv) AS v1,
             covar_pop(x2, yv) AS v2, AVG(yk) AS mk, covar_pop(x1, yk) AS k1, covar_pop(x2, yk) AS k2 FROM t WHERE label = 0 GROUP BY step),
b AS (SELECT *, s11 * s22 - s12 * s12 AS det FROM f),
e AS (SELECT user_id, start_ordinal, label, step,
             pow(yv - (mv + (v1 * s22 - v2 * s12) / det * (x1 - m1) + (v2 * s11 - v1 * s12) / det * (x2 - m2)), 2)
             + pow(yk - (mk + (k1 * s22 - k2 * s12) / det * (x1 - m1) + (k2 * s11 - k1 * s12) / det * (x2 - m2)), 2) AS sq FROM t JOIN b USING (step))
SELECT user_id, start_ordinal, any_value(label) AS label, ROUND(SUM(sq) FILTER (step = 20) / 2, 4) AS error, ROUND(AVG(sq) / 2, 4) AS error_all,
       CASE WHEN SUM(sq) FILTER (step = 20) / 2 > 5000.0 THEN 1 ELSE 0 END AS pred
FROM e GROUP BY user_id, start_ordinal""")
def q_forecast_gram(spark, sf_dir):
    """All target steps of both features forecast from the last input step by
    one table of co-moments of the normal windows; the SQL solves the same
    two-input regressions step by step."""
    w = fp.windows(spark, sf_dir)
    model = fo.fit_forecaster(w.where(F.col("label") == 0), ["value", "k"], fx.WINDOW_LENGTH, fx.WINDOW_HORIZON, steps=[fx.WINDOW_LENGTH - 1])
    err = sq.decide(fo.step_errors(fo.forecast(w, model), model), "error", 5000.0, strict=True)
    return err.select("user_id", "start_ordinal", "label", F.round("error", 4).alias("error"), F.round("error_all", 4).alias("error_all"), "pred")


@register("q_subspace_anomaly", """
WITH RECURSIVE e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings),
u AS (SELECT vec_id, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM e WHERE label = 0),
m AS (SELECT i, AVG(v) AS mu FROM u GROUP BY i),
c AS (SELECT vec_id, i, v - mu AS d FROM u JOIN m USING (i)),
s AS (SELECT a.i, b.i AS j, SUM(a.d * b.d) AS s FROM c a JOIN c b USING (vec_id) GROUP BY a.i, b.i),
rows AS (SELECT i, list(s ORDER BY j) AS r FROM s GROUP BY i),
mat AS (SELECT list(r ORDER BY i) AS a FROM rows),
p(k, v) AS (SELECT 0, list_transform(range(64), lambda i: 1.0 / (i + 8)) UNION ALL
            SELECT k + 1, (SELECT list_transform(y, lambda z: z / sqrt(list_inner_product(y, y))) FROM (SELECT list_transform(mat.a, lambda r: list_inner_product(r, v)) AS y FROM mat)) FROM p WHERE k < 200),
axis AS (SELECT v FROM p WHERE k = 200),
mean AS (SELECT list(mu ORDER BY i) AS mu FROM m),
g AS (SELECT vec_id, label, list_transform(list_zip(x, mu), lambda z: z[1] - z[2]) AS d, v FROM e, mean, axis),
err AS (SELECT vec_id, label, (list_inner_product(d, d) - pow(list_inner_product(d, v), 2)) / 64 AS error FROM g),
t AS (SELECT MAX(error) AS t FROM err WHERE label = 0)
SELECT vec_id, label, ROUND(error, 7) AS error, CASE WHEN error >= t - 1e-12 THEN 1 ELSE 0 END AS verdict FROM err, t""")
def q_subspace_anomaly(spark, sf_dir):
    """Reconstruction from the leading principal axis of the normal
    vectors (label 0); the verdict is an error not below the largest normal one.  The
    SQL finds the axis by power iteration."""
    emb = v.table(spark, sf_dir, "embeddings")
    model = su.fit_subspace(emb.where(F.col("label") == 0), "embedding", 64, 1)
    told = su.reconstruction_error(emb, "embedding", model).select("vec_id", "label", "error")
    most = told.where(F.col("label") == 0).agg(F.max("error")).first()[0]
    return told.select("vec_id", "label", F.round("error", 7).alias("error"), F.when(F.col("error") >= most - 1e-12, 1).otherwise(0).alias("verdict"))

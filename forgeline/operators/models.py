"""Classifier training and scoring on Spark ML.

The reference trains small torch networks; here distributed Spark ML estimators
fill the role: a multilayer perceptron, a weighted logistic regression or boosted
trees.  Parity is by metric floor, not by weights.  The window forecaster is in
``forecast``."""
from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_classifier(train: DataFrame, features: Sequence[str], label: str, kind: str = "logistic",
                   weight_col: str | None = None, hidden: Sequence[int] = (32, 16), max_iter: int = 100,
                   seed: int = 42) -> PipelineModel:
    """G1: assemble ``features`` and fit a binary classifier.

    kind: 'mlp' (sigmoid hidden layers, softmax output), 'logistic' (honours
    ``weight_col``, e.g. inverse class frequency) or 'gbt'.  'mlp' takes no row
    weights: balance its training rows instead."""
    if kind == "mlp" and weight_col:
        raise ValueError("the multilayer perceptron takes no row weights: use a sampler")
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    if kind == "mlp":
        est = MultilayerPerceptronClassifier(layers=[len(features), *hidden, 2], maxIter=max_iter, seed=seed,
                                             labelCol=label, featuresCol="features")
    elif kind == "logistic":
        est = LogisticRegression(maxIter=max_iter, labelCol=label, featuresCol="features",
                                 **({"weightCol": weight_col} if weight_col else {}))
    elif kind == "gbt":
        est = GBTClassifier(maxIter=max_iter, seed=seed, labelCol=label, featuresCol="features",
                            **({"weightCol": weight_col} if weight_col else {}))
    else:
        raise ValueError(kind)
    return Pipeline(stages=[asm, est]).fit(train.withColumn(label, F.col(label).cast("double")))


def score(model: PipelineModel, df: DataFrame, name: str = "probability_1") -> DataFrame:
    """Probability of the positive class as a plain double column."""
    out = model.transform(df)
    return (out.withColumn("_p1", vector_to_array(F.col("probability"))[1])
            .drop("features", "rawPrediction", "probability", "prediction")
            .withColumnRenamed("_p1", name))


def save_bundle(model: PipelineModel, params: Mapping, path: str) -> None:
    """Persist the fitted pipeline and its parameters (scaler constants,
    categories, threshold) next to each other."""
    model.write().overwrite().save(f"{path}/model")
    spark = model.stages[0].sparkSession if hasattr(model.stages[0], "sparkSession") else None
    from pyspark.sql import SparkSession
    spark = spark or SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(dict(params)),)], "params string").write.mode("overwrite").json(f"{path}/params")


def load_bundle(spark, path: str) -> tuple[PipelineModel, dict]:
    model = PipelineModel.load(f"{path}/model")
    params = json.loads(spark.read.json(f"{path}/params").first()["params"])
    return model, params

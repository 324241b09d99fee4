"""A linear scoring bundle (A8, G2, G3): everything that scoring a record needs, saved as
one JSON file, applied as column expressions in batch and on a stream alike."""
from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LinearBundle:
    """probability = sigmoid(bias + sum of weight * (feature - centre) / scale)."""
    features: tuple[str, ...]
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    bias: float
    threshold: float = 0.5

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(asdict(self)),)], "bundle string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearBundle:
        told = json.loads(spark.read.text(path).first()[0])
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in told.items()})

    @classmethod
    def of(cls, model, params: dict, threshold: float = 0.5) -> LinearBundle:
        """From a fitted logistic pipeline (``models.fit_classifier``) and the scaler
        {feature: (centre, scale)} that its rows went through."""
        names, fitted = tuple(model.stages[0].getInputCols()), model.stages[-1]
        scaler = [params.get(c, (0.0, 1.0)) for c in names]
        return cls(names, tuple(float(c) for c, _ in scaler), tuple(float(s) for _, s in scaler), tuple(map(float, fitted.coefficients)), float(fitted.intercept), threshold)

    def probability(self) -> Column:
        """NULL where a feature is NULL."""
        total = F.lit(self.bias)
        for name, c, s, w in zip(self.features, self.centre, self.scale, self.weights, strict=True):
            total = total + F.lit(w) * ((F.col(f"`{name}`") - F.lit(c)) / F.lit(s))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def verdict(self, probability: Column) -> Column:
        return F.when(probability >= self.threshold, 1).otherwise(0)

    def score(self, record: dict[str, float]) -> float:
        """The probability of one record, without Spark."""
        z = self.bias + sum(w * ((record[n] - c) / s) for n, c, s, w in zip(self.features, self.centre, self.scale, self.weights, strict=True))
        return 1.0 / (1.0 + math.exp(-z))


__all__ = ["LinearBundle"]

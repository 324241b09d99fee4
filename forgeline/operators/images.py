"""Image anomaly scoring (A5, F17, G8-G13) and its vector analogue.

Images come from Spark's ``image`` source (the JVM decodes PNG/JPEG into
BGR bytes).  Per-image pixel work (resize, error map, Gaussian smoothing) is
a small numpy helper inside Arrow-batched pandas UDFs; the fit of the normal
image is a distributed mean (``Summarizer``), and scores / verdicts / map
normalisation are JVM array expressions.
"""
from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.metadata import DIM_LIMIT, collect_bounded

# path layout of an image tree: <root>/<category>/<split>/<defect>/<file>
TREE_PATTERN = r".*/([^/]+)/(train|test)/([^/]+)/[^/]+$"


def read_image_tree(spark, root: str) -> DataFrame:
    """A5: (path, category, split, defect, label, height, width, channels, data)
    with label 0 for 'good' and 1 otherwise."""
    img = (spark.read.format("image").option("dropInvalid", True)
           .load(f"{root.rstrip('/')}/*/*/*/*"))
    o = F.col("image.origin")
    return img.select(
        o.alias("path"),
        F.regexp_extract(o, TREE_PATTERN, 1).alias("category"),
        F.regexp_extract(o, TREE_PATTERN, 2).alias("split"),
        F.regexp_extract(o, TREE_PATTERN, 3).alias("defect"),
        (F.regexp_extract(o, TREE_PATTERN, 3) != "good").cast("int").alias("label"),
        F.col("image.height").alias("height"), F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("channels"), F.col("image.data").alias("data"))


@functools.cache
def resampling(n: int, size: int) -> np.ndarray:
    """Weights (size x n) of linear interpolation from n samples to ``size``.

    Sample centres stand at halves; an output centre takes the samples within one
    step by a triangle.  When shrinking the triangle is as much wider as the steps
    are, so every sample counts (the antialiased filter of image libraries)."""
    scale = n / size
    reach = max(scale, 1.0)
    centre = (np.arange(size) + 0.5) * scale
    w = np.maximum(1.0 - np.abs((np.arange(n) + 0.5 - centre[:, None]) / reach), 0.0)
    return w / w.sum(1, keepdims=True)


def resize(a: np.ndarray, height: int, width: int) -> np.ndarray:
    """(h, w, ...) array -> (height, width, ...), axis by axis."""
    rows = np.tensordot(resampling(a.shape[0], height), a, (1, 0))
    return np.moveaxis(np.tensordot(resampling(a.shape[1], width), rows, (1, 1)), 0, 1)


def resize_maps(df: DataFrame, col: str, height: int, width: int, to_height: int, to_width: int, name: str = "resized") -> DataFrame:
    """F17 on flattened maps (row by row): the map at another size; NULL for NULL
    maps and maps of another length."""
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(maps: pd.Series) -> pd.Series:
        arrays = [None if m is None else np.asarray(m, np.float64) for m in maps]
        some = [i for i, m in enumerate(arrays) if m is not None and len(m) == height * width]
        out = pd.Series([None] * len(arrays), dtype=object)
        if some:
            stack = np.moveaxis(np.stack([arrays[i] for i in some]).reshape(-1, height, width), 0, 2)
            told = np.moveaxis(resize(stack, to_height, to_width), 2, 0).reshape(len(some), -1)
            for i, m in zip(some, told, strict=True):
                out.iloc[i] = m
        return out

    return df.withColumn(name, run(F.col(col)))


def _to_rgb_grid(data: bytes, h: int, w: int, ch: int, size: int) -> np.ndarray:
    """Decode BGR(A) bytes to RGB, resample to size x size, scale to [0, 1]."""
    a = np.frombuffer(data, dtype=np.uint8).reshape(h, w, ch).astype(np.float64)
    a = np.repeat(a, 3, axis=2) if ch == 1 else a[:, :, [2, 1, 0]]
    return (resize(a, size, size) / 255.0).ravel()


def image_grid(df: DataFrame, size: int = 256) -> DataFrame:
    """3-channel RGB resized to size x size in [0, 1], flattened (y, x, c), by
    antialiased linear interpolation in floating point (image libraries round to
    8 bits after each axis)."""
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def grid(data: pd.Series, h: pd.Series, w: pd.Series, ch: pd.Series) -> pd.Series:
        return pd.Series([_to_rgb_grid(d, int(a), int(b), int(c), size).tolist()
                          for d, a, b, c in zip(data, h, w, ch)])
    return df.withColumn("pixels", grid("data", "height", "width", "channels")).drop("data")


def fit_normal_image(df: DataFrame, col: str = "pixels") -> np.ndarray:
    """The per-pixel mean of the normal images (distributed Summarizer)."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer
    vec = df.select(array_to_vector(F.col(col)).alias("v"))
    mean = vec.select(Summarizer.mean(F.col("v")).alias("m")).first()["m"]
    return mean.toArray()


def gaussian_kernel(size: int = 15, sigma: float = 0.0) -> np.ndarray:
    """1-D Gaussian taps; sigma <= 0 derives it from the size as
    0.3 * ((size - 1) * 0.5 - 1) + 0.8 (2.6 for size 15)."""
    if sigma <= 0:
        sigma = 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    r = np.arange(size) - (size - 1) / 2.0
    k = np.exp(-(r ** 2) / (2 * sigma * sigma))
    return k / k.sum()


def _blur(m: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Separable convolution with mirrored borders (reflect-101)."""
    p = len(k) // 2
    a = np.pad(m, ((p, p), (0, 0)), mode="reflect")
    a = np.apply_along_axis(lambda col: np.convolve(col, k, mode="valid"), 0, a)
    a = np.pad(a, ((0, 0), (p, p)), mode="reflect")
    return np.apply_along_axis(lambda row: np.convolve(row, k, mode="valid"), 1, a)


def error_maps(df: DataFrame, normal: np.ndarray, size: int, col: str = "pixels",
               kernel: int = 15, sigma: float = 0.0) -> DataFrame:
    """G9 + G10: squared error against the normal image averaged over the
    channels, then Gaussian-smoothed; adds ``error_map`` (size*size)."""
    spark = df.sparkSession
    bnormal = spark.sparkContext.broadcast(normal.astype(np.float64))
    k = gaussian_kernel(kernel, sigma)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def emap(px: pd.Series) -> pd.Series:
        ref = bnormal.value.reshape(size, size, 3)
        out = []
        for p in px:
            e = ((np.asarray(p).reshape(size, size, 3) - ref) ** 2).mean(axis=2)
            out.append(_blur(e, k).ravel().tolist())
        return pd.Series(out)
    return df.withColumn("error_map", emap(col))


def image_score(df: DataFrame, col: str = "error_map", name: str = "score") -> DataFrame:
    """Anomaly score = max of the smoothed error map."""
    return df.withColumn(name, F.array_max(col))


def normalise_map(df: DataFrame, col: str = "error_map", name: str = "heatmap") -> DataFrame:
    """Per-image min-max rescale of the map to 0..255."""
    lo, hi = F.array_min(col), F.array_max(col)
    rng = F.when(hi > lo, hi - lo).otherwise(F.lit(1.0))
    return df.withColumn(name, F.transform(col, lambda x: (x - lo) / rng * F.lit(255.0)))


def vector_anomaly(df: DataFrame, key: str, vec: str, label: str, normal_label=0) -> DataFrame:
    """G8/G9/G11/G12 for embeddings: centroid of the normal vectors (a
    per-dimension mean, collected as dims-sized metadata), error = mean squared
    difference to it, verdict = error >= the largest normal error."""
    normal = df.where(F.col(label) == normal_label)
    cent = collect_bounded(normal.select(F.posexplode(vec).alias("pos", "x"))
                           .groupBy("pos").agg(F.avg(F.col("x").cast("double")).alias("mu")).orderBy("pos"),
                           DIM_LIMIT, "vector dimensions")
    dims = len(cent)
    if dims == 0:
        raise ValueError("no normal vectors")
    mu = F.array(*[F.lit(float(r["mu"])) for r in cent])
    sq = F.zip_with(F.col(vec), mu, lambda x, m: F.pow(x.cast("double") - m, 2))
    scored = df.withColumn("error", F.aggregate(sq, F.lit(0.0), lambda a, x: a + x) / F.lit(float(dims)))
    thr = scored.where(F.col(label) == normal_label).agg(F.max("error")).first()[0]
    return scored.withColumn("verdict", (F.col("error") >= F.lit(thr)).cast("int"))


def map_anomaly(df: DataFrame, key: str, vec: str, label: str, size: int, kernel: int = 15,
                normal_label=0) -> DataFrame:
    """G8-G13 on one-channel maps stored as flat arrays of size * size values: the
    mean of the normal maps is the reconstruction (G8), the squared difference the
    error map (G9), Gaussian-smoothed (G10); the score is its maximum (G11), the
    verdict score >= the largest normal score (G12), and ``heatmap`` the map
    rescaled to 0..255 (G13)."""
    maps = df.select(key, label, F.transform(vec, lambda x: x.cast("double")).alias("pixels"))
    normal = fit_normal_image(maps.where(F.col(label) == normal_label))  # size * size numbers
    mean = F.array(*[F.lit(float(x)) for x in normal])
    errors = maps.withColumn("error", F.zip_with("pixels", mean, lambda x, m: (x - m) * (x - m)))
    k = gaussian_kernel(kernel)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def smooth(px: pd.Series) -> pd.Series:
        return pd.Series([_blur(np.asarray(p, float).reshape(size, size), k).ravel().tolist() for p in px])

    scored = image_score(errors.withColumn("error_map", smooth("error")))
    largest = scored.where(F.col(label) == normal_label).agg(F.max("score")).first()[0]
    verdict = F.when(F.col("score") >= F.lit(largest), F.lit("NG")).otherwise(F.lit("OK"))
    return normalise_map(scored.withColumn("verdict", verdict)).drop("pixels", "error")

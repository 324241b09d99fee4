"""SMOTE (F10): synthetic minority rows between nearest neighbours.

``n_major - n_minor`` synthetic rows are placed on segments from a minority row to
one of its k nearest neighbours (``neighbours.knn_exact``); the copy quota, the
neighbour choice and the gap are drawn from hashes, so a run can be repeated."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metadata import class_counts
from .features import explode_copies, hash_quota
from .neighbours import knn_exact


def _unit_hash(*cols: Column) -> Column:
    """Uniform [0, 1) from a 64-bit hash."""
    h = F.xxhash64(*cols)
    return (F.pmod(h, F.lit(1 << 52)).cast("double")) / F.lit(float(1 << 52))


def smote(df: DataFrame, key: str, features: Sequence[str], label: str, k: int = 5,
          seed: int = 42) -> DataFrame:
    """the input rows plus synthetic minority rows up to the majority
    count.  Adds ``synthetic`` (bool), ``src_key``, ``nn_key`` and ``gap``."""
    features = list(features)
    counts = class_counts(df, label)
    n_max = max(counts.values())
    parts = [df.select(F.col(key), *features, F.col(label), F.lit(False).alias("synthetic"),
                       F.lit(None).cast(dict(df.dtypes)[key]).alias("src_key"),
                       F.lit(None).cast(dict(df.dtypes)[key]).alias("nn_key"), F.lit(None).cast("double").alias("gap"))]
    for cls, n in counts.items():
        need = n_max - n
        if need == 0 or n < 2:
            continue
        kk = min(k, n - 1)
        minority = df.where(F.col(label) == cls).select(key, *features, label)
        nn = knn_exact(minority, key, features, kk)
        quota = df.sparkSession.createDataFrame([(cls, need % n)], f"`{label}` {dict(df.dtypes)[label]}, q long")
        flagged = hash_quota(minority, label, key, seed, quota, "_extra")
        copies = F.lit(need // n) + F.col("_extra").cast("long")
        drawn = (explode_copies(flagged.select(key, label, copies.alias("_n")), F.col("_n"), "_copy").drop("_n")
                 .withColumn("nn_rank", (F.pmod(F.xxhash64(key, "_copy", F.lit(seed)), F.lit(kk)) + 1).cast("int"))
                 .withColumn("gap", _unit_hash(key, "_copy", F.lit(seed + 1))))
        pick = drawn.join(nn.select(key, "nn_key", "nn_rank"), [key, "nn_rank"])
        src = minority.select(key, *[F.col(f).alias("s_" + f) for f in features])
        dst = minority.select(F.col(key).alias("nn_key"), *[F.col(f).alias("d_" + f) for f in features])
        syn = (pick.join(src, key).join(dst, "nn_key")
               .select(F.concat_ws("#", F.col(key).cast("string"), F.col("_copy").cast("string")).alias("_sk"),
                       *[(F.col("s_" + f) + F.col("gap") * (F.col("d_" + f) - F.col("s_" + f))).alias(f)
                         for f in features],
                       F.col(label), F.lit(True).alias("synthetic"), F.col(key).alias("src_key"), "nn_key", "gap"))
        parts.append(syn.withColumn(key, F.col("_sk").cast(dict(df.dtypes)[key]) if dict(df.dtypes)[key] == "string"
                                    else F.lit(None).cast(dict(df.dtypes)[key])).drop("_sk")
                     .select(key, *features, label, "synthetic", "src_key", "nn_key", "gap"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


__all__ = ["knn_exact", "smote"]

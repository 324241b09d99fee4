"""Sliding sequence windows per series (F14, F15, F16) and the last-step
forecast error (G6, G7).

A window frame partitioned by the series key would put a long series in one
task.  Instead each row gets a distributed ordinal within its series, rows
are grouped into chunks of ``chunk`` ordinals, and the first ``span`` rows of
every chunk are also copied to the previous chunk (a halo).  Windows are then
computed per (series, chunk), each group bounded by chunk + span rows, and a
chunk emits only the windows that start inside it.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordinals import with_ordinal


def sequence_windows(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str],
                     label: str | None = None, length: int = 20, gap: int = 20,
                     horizon: int = 20, chunk: int = 4096) -> DataFrame:
    """windows starting at every ordinal i of a series:
    ``input`` = rows i .. i+length-1, ``target`` = rows i+length+gap ..
    i+length+gap+horizon-1, ``label`` = label at row i+span where
    span = length+gap+horizon.  A series of n rows yields max(n - span, 0)
    windows.  Steps are structs, so NULL measures keep their position."""
    span = length + gap + horizon
    if chunk <= span:
        raise ValueError("chunk must exceed the window span")
    od = with_ordinal(df, [key], order, "ordinal")
    c = F.floor(F.col("ordinal") / chunk)
    halo = (F.col("ordinal") % chunk <= span) & (c > 0)
    ex = od.withColumn("_chunk", F.explode(F.when(halo, F.array(c, c - 1)).otherwise(F.array(c))))
    w = Window.partitionBy(key, "_chunk").orderBy("ordinal")
    step = F.struct(*[F.col(x).cast("double").alias(x) for x in cols])
    out = ex.select(
        key, "_chunk", "ordinal", F.col(order[0]).alias("start_" + order[0]),
        F.collect_list(step).over(w.rowsBetween(0, length - 1)).alias("input"),
        F.collect_list(step).over(w.rowsBetween(length + gap, span - 1)).alias("target"),
        (F.lead(F.col(label), span).over(w) if label else F.lit(None)).alias("label"),
        F.lead("ordinal", span).over(w).alias("_end"))
    return (out.where((F.floor(F.col("ordinal") / chunk) == F.col("_chunk")) & F.col("_end").isNotNull())
            .drop("_chunk", "_end").withColumnRenamed("ordinal", "start_ordinal"))


def last_step(arr: str, field: str):
    """``X[:, -1, :]``: a field of the last step of a window array."""
    return F.element_at(F.col(arr), -1)[field]


def forecast_error(df: DataFrame, cols: Sequence[str], pred: Mapping[str, object] | None = None,
                   name: str = "error") -> DataFrame:
    """Mean over features of (target[-1] - prediction[-1])^2.  Without
    ``pred`` the forecast is the last input step (a persistence model)."""
    terms = []
    for c in cols:
        p = pred[c] if pred else last_step("input", c)
        terms.append(F.pow(last_step("target", c) - p, 2))
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return df.withColumn(name, total / F.lit(float(len(cols))))


def decide(df: DataFrame, score: str, threshold: float, strict: bool = False, name: str = "pred") -> DataFrame:
    """1 where score >= threshold (strict: >)."""
    hit = F.col(score) > threshold if strict else F.col(score) >= threshold
    return df.withColumn(name, F.when(F.coalesce(hit, F.lit(False)), F.lit(1)).otherwise(F.lit(0)))


def split_windows(df: DataFrame, label: str, firsts: Mapping[int, int], key: str,
                  order: Sequence[str], first: str = "valid", rest: str = "test",
                  purge: int = 0, start: str = "start_ordinal") -> DataFrame:
    """per class, the first ``firsts[class]`` windows in ``order`` form
    the first split.  The rank inside a class is a distributed ordinal
    (range-partitioned), not a window over the whole class.  F16 (the
    normal-only subset) is then ``where(split == first and label == 0)``."""
    spark = df.sparkSession
    quota = spark.createDataFrame([(k, int(v)) for k, v in firsts.items()], f"{label} int, q long")
    ranked = with_ordinal(df, [label], list(order), "_rank")
    out = (ranked.join(F.broadcast(quota), label, "left")  # one row per class
           .withColumn("split", F.when(F.col("_rank") < F.coalesce(F.col("q"), F.lit(0)), F.lit(first))
                       .otherwise(F.lit(rest)))
           .drop("_rank", "q"))
    return purge_overlaps(out, key, start, purge, first) if purge > 0 else out


def purge_overlaps(df: DataFrame, key: str, start: str, span: int, first: str = "valid",
                   split: str = "split") -> DataFrame:
    """Drop non-``first`` windows whose start lies within ``span`` rows of a
    ``first`` window of the same series (they share raw rows).  Overlaps are
    found by an equi-join on (series, start bucket of width span) against the
    neighbouring buckets, so a long series is never paired with itself whole."""
    b = F.floor(F.col(start) / F.lit(span))
    valid = df.where(F.col(split) == first).select(F.col(key).alias("_k"), F.col(start).alias("_vs"), b.alias("_b"))
    probe = (df.where(F.col(split) != first).select(key, start)
             .withColumn("_b", F.explode(F.array(b - 1, b, b + 1))))
    hit = (probe.join(valid, (probe[key] == valid["_k"]) & (probe["_b"] == valid["_b"]))
           .where(F.abs(F.col(start) - F.col("_vs")) < span)
           .select(key, start).distinct())
    return df.join(hit, [key, start], "left_anti")


__all__ = ["sequence_windows", "forecast_error", "decide", "split_windows", "last_step"]

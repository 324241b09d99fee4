"""Feature preparation and sampling.

Order-dependent sampling is driven by a hash of (key, seed), never by file
order or ``rand()``, so every result is reproducible and recomputable after
an executor loss.  "The first q rows of a class in hash order" is answered
without a window over the whole class: a small job finds the class's boundary
hash, and rows are compared with it where they are.
"""
from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import join_on_keys
from ..functions.metadata import class_counts
from ..functions.ordinals import join_small, with_ordinal
from ..session import ensure_checkpoint_dir

MAX_CATEGORIES = 10_000  # one-hot categories are collected: metadata only


# ------------------------------------------------------------------ encoding
def categories(df: DataFrame, col: str) -> list:
    cats = df.select(col).where(F.col(col).isNotNull()).distinct().limit(MAX_CATEGORIES + 1).collect()
    if len(cats) > MAX_CATEGORIES:
        raise ValueError(f"{col} has more than {MAX_CATEGORIES} categories")
    return sorted(r[0] for r in cats)


def one_hot(df: DataFrame, col: str, cats: Sequence | None = None, drop_first: bool = True,
            prefix: str | None = None) -> tuple[DataFrame, list]:
    """0/1 indicator columns ``{prefix}_{value}`` for the sorted
    categories, the first dropped; unseen values get all zeros.  Pass the
    saved ``cats`` to encode new records the same way."""
    cats = list(cats) if cats is not None else categories(df, col)
    kept = cats[1:] if drop_first else cats
    prefix = prefix or col
    out = df.withColumns({f"{prefix}_{c}": (F.col(col) == F.lit(c)).cast("int") for c in kept}).drop(col)
    out = out.fillna(0, subset=[f"{prefix}_{c}" for c in kept])
    return out, cats


def derive(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """derived columns from expressions."""
    return df.withColumns(dict(exprs))


def power_and_delta(torque: str, rpm: str, hot: str, cold: str) -> dict[str, Column]:
    """F3 as used for machine failure data: mechanical power (W) and the
    temperature difference."""
    return {"power": F.col(torque) * F.col(rpm) * F.lit(2 * math.pi) / F.lit(60.0),
            "temp_diff": F.col(hot) - F.col(cold)}


# ---------------------------------------------------------------- hash order
def hash_key(key: str | Column, seed: int) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(k.cast("string"), F.lit(str(seed))))


def hash_quota(df: DataFrame, cls: str, key: str, seed: int, quota,
               flag: str = "_in_quota", keep_counts: bool = False) -> DataFrame:
    """Flag the first ``q`` rows of each class in md5(key||seed) order.

    ``quota`` is either a DataFrame (cls, q) with one row per class, or a
    function of the class table (cls, _ncls, _nmax) that adds ``q``.  ``key``
    must be unique within a class; rows that repeat a key go together.
    ``keep_counts`` also returns ``_ncls`` and ``_nmax`` per row.

    Two small jobs find one boundary hash per class: rows are counted per (class,
    16-bit bucket), which gives the bucket with the boundary, and only that
    bucket's hashes are counted and ranked.  Both results have one row per class and
    are checkpointed, so that reading the rows again doesn't repeat the jobs.  The rows
    themselves are flagged where they are, by a comparison with their class's boundary,
    which is broadcast: no shuffle, window, sort or union of rows."""
    ensure_checkpoint_dir(df.sparkSession)
    h = df.select(cls, hash_key(key, seed).alias("_h")).withColumn("_b", F.substring("_h", 1, 4))
    per_bucket = h.groupBy(cls, "_b").agg(F.count("*").alias("_bn"))  # <= classes x 65536 rows
    wb = Window.partitionBy(cls).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    cum = per_bucket.withColumn("_before", F.coalesce(F.sum("_bn").over(wb), F.lit(0)))
    if callable(quota):
        # class sizes: one row per class; the window over classes is that small
        totals = (per_bucket.groupBy(cls).agg(F.sum("_bn").alias("_ncls"))
                  .withColumn("_nmax", F.max("_ncls").over(Window.partitionBy())))
        quotas = quota(totals)
    else:
        quotas = quota
    counts = ["_ncls", "_nmax"] if keep_counts and callable(quota) else []
    found = (join_on_keys(cum, quotas.select(cls, "q"), [cls])
             .where((F.col("_before") < F.col("q")) & (F.col("q") <= F.col("_before") + F.col("_bn")))
             .select(cls, "_b", (F.col("q") - F.col("_before")).alias("_need")))
    edge = join_on_keys(quotas.select(cls, *counts), found, [cls], how="left").checkpoint()  # one row per class
    inside = join_small(h, edge.where("_need IS NOT NULL").select(cls, "_b", "_need"), [cls, "_b"])
    hashes = inside.groupBy(cls, "_b", "_h", "_need").agg(F.count("*").alias("_hn"))  # keys that repeat are one row
    upto = F.sum("_hn").over(Window.partitionBy(cls, "_b").orderBy("_h").rowsBetween(Window.unboundedPreceding, 0))
    limits = (hashes.withColumn("_upto", upto)
              .where((F.col("_upto") - F.col("_hn") < F.col("_need")) & (F.col("_need") <= F.col("_upto")))
              .select(cls, F.col("_h").alias("_limit"))).checkpoint()
    table = (edge.select(cls, *counts).unionByName(limits, allowMissingColumns=True)
             .groupBy(cls).agg(*[F.max(c).alias(c) for c in [*counts, "_limit"]]))
    tagged = join_small(df.withColumn("_h", hash_key(key, seed)), table, [cls], how="left")
    return tagged.withColumn(flag, F.coalesce(F.col("_h") <= F.col("_limit"), F.lit(False))).drop("_h", "_limit")


def largest_remainder(totals: DataFrame, cls: str, percent: int) -> DataFrame:
    """Quotas of ``percent`` of all rows, rounded up, over the classes: the floor
    of each class's share, and one more for the largest remainders (ties: the
    larger class, then the smaller value)."""
    share = F.col("_ncls") * percent
    parts = totals.withColumns({"_floor": F.floor(share / 100), "_rest": share % 100})
    every = Window.partitionBy()  # one row per class
    total = F.ceil(F.sum("_ncls").over(every) * percent / 100)
    left = total - F.sum("_floor").over(every)
    turn = F.row_number().over(Window.orderBy(F.desc("_rest"), F.desc("_ncls"), F.asc_nulls_first(cls)))
    return parts.withColumn("q", F.col("_floor") + (turn <= left).cast("long")).drop("_floor", "_rest")


def stratified_split(df: DataFrame, label: str, key: str, test_percent: int = 20,
                     seed: int = 42) -> DataFrame:
    """``test_percent`` of all rows, rounded up, go to 'test', shared among the
    classes by largest remainder and taken in hash order; the rest to 'train'.
    Adds column ``split``."""
    flagged = hash_quota(df, label, key, seed, lambda t: largest_remainder(t, label, test_percent), "_test")
    return flagged.withColumn("split", F.when(F.col("_test"), F.lit("test")).otherwise(F.lit("train"))).drop("_test")


# ---------------------------------------------------------------- scaling
def fit_standard(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """F5 fit: mean and population std (std 0 -> 1)."""
    r = df.agg(*[x for c in cols for x in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]).first()
    return {c: (r[f"m_{c}"], r[f"s_{c}"] if r[f"s_{c}"] else 1.0) for c in cols}


def fit_minmax(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """F6 fit: (min, range) with range 0 -> 1, so a constant maps to 0."""
    r = df.agg(*[x for c in cols for x in (F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))]).first()
    return {c: (r[f"lo_{c}"], (r[f"hi_{c}"] - r[f"lo_{c}"]) or 1.0) for c in cols}


def apply_scale(df: DataFrame, params: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(x - shift) / scale with the fitted per-column literals (no clipping)."""
    return df.withColumns({c: (F.col(c) - F.lit(a)) / F.lit(b) for c, (a, b) in params.items()})


# ---------------------------------------------------------- class balance
def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, count, weight = 1 / count)."""
    return (df.groupBy(label).agg(F.count("*").alias("count"))
            .withColumn("weight", F.lit(1.0) / F.col("count")))


def with_row_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Per-row weight from the class table (one row per class: broadcast)."""
    w = class_weights(df, label).select(label, F.col("weight").alias(name))
    return join_on_keys(df, w, [label], broadcast_right=True)


def unit_md5(*parts: Column | str) -> Column:
    """A number in [0, 1) from the first 48 bits of an md5 of the joined parts."""
    text = F.md5(F.concat_ws("-", *[p if isinstance(p, Column) else F.lit(p) for p in parts]))
    return F.conv(F.substring(text, 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def balanced_sample(df: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """F8: as many draws with replacement as there are rows, each row with weight
    1 / n_class: a draw takes a class, all alike, then a row of the class.

    Draws are rows of a range, numbered and hashed, so the sample can be repeated;
    they are added up per drawn row before they meet the rows, which are numbered
    within their class (``key`` unique).  Adds ``copy`` (0-based)."""
    sizes = df.groupBy(label).agg(F.count("*").alias("_ncls"))  # one row per class
    classes = sizes.withColumn("_class", F.row_number().over(Window.orderBy(F.asc_nulls_first(label))) - 1)
    total = df.count()
    k = classes.count()
    draws = df.sparkSession.range(total).select(
        F.floor(unit_md5(F.col("id").cast("string"), str(seed), "class") * k).alias("_class"),
        unit_md5(F.col("id").cast("string"), str(seed), "row").alias("_u"))
    drawn = (draws.join(classes, "_class").select(label, F.floor(F.col("_u") * F.col("_ncls")).alias("_ord"))
             .groupBy(label, "_ord").agg(F.count("*").alias("_times")))
    rows = with_ordinal(df, [label], [key], "_ord")
    return explode_copies(join_on_keys(rows, drawn, [label, "_ord"]), F.col("_times"), "copy").drop("_ord", "_times")


def oversample(df: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """minority classes are replicated up to the majority count exactly:
    floor(n_maj / n_c) full copies plus the first (n_maj mod n_c) rows in
    hash order.  Adds ``copy`` (0 = original)."""
    # class sizes come from the per-bucket table inside hash_quota (windows
    # over <= classes x 65536 rows), not from another scan of the rows
    flagged = hash_quota(df, label, key, seed, lambda t: t.withColumn("q", F.col("_nmax") % F.col("_ncls")), "_extra",
                         keep_counts=True)
    n_copies = (F.col("_nmax") / F.col("_ncls")).cast("long") + F.col("_extra").cast("long")
    out = explode_copies(flagged, n_copies, "copy").drop("_ncls", "_nmax", "_extra")
    return out.withColumn("copy", F.col("copy").cast("int"))


COPY_SLICE = 100_000  # copies generated per task slice


def explode_copies(df: DataFrame, copies: Column, name: str = "copy", slice_size: int = COPY_SLICE) -> DataFrame:
    """One output row per copy index 0..copies-1, without putting a huge
    replication of one row into one task: rows are first split into slices
    of at most ``slice_size`` copies, the slices are redistributed, and each
    slice generates its own index range."""
    n_slices = F.ceil(copies / F.lit(slice_size)).cast("int")
    sliced = (df.withColumn("_copies", copies.cast("long")).where(F.col("_copies") > 0)
              .withColumn("_slice", F.explode(F.sequence(F.lit(0), n_slices - 1))))
    big = sliced.where(F.col("_copies") > slice_size)
    spread = big.repartition(F.col("_slice"), *[F.col(c) for c in df.columns[:1]])
    small = sliced.where(F.col("_copies") <= slice_size)
    both = small.unionByName(spread)
    lo = F.col("_slice") * F.lit(slice_size)
    hi = F.least(lo + F.lit(slice_size), F.col("_copies")) - 1
    return both.withColumn(name, F.explode(F.sequence(lo, hi))).drop("_copies", "_slice")


def hash_shuffle(df: DataFrame, key: str, seed: int = 42, name: str = "shuffle_index") -> DataFrame:
    """a reproducible shuffled order, exposed as a global 0-based index."""
    h = df.withColumn("_h", hash_key(key, seed))
    return with_ordinal(h.withColumn("_all", F.lit(0)), ["_all"], ["_h"], name).drop("_h", "_all")


def split_by_ordinal(df: DataFrame, order: Sequence[str], n_first: int, name: str = "split",
                     first: str = "train", rest: str = "test") -> DataFrame:
    """the first ``n_first`` rows in ``order`` vs the rest (distributed ordinal)."""
    o = with_ordinal(df.withColumn("_all", F.lit(0)), ["_all"], order, "_ord").drop("_all")
    return o.withColumn(name, F.when(F.col("_ord") < n_first, F.lit(first)).otherwise(F.lit(rest)))

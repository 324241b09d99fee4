"""Exact quantiles (linear interpolation) without holding a group in one task.

Spark's exact ``percentile`` keeps every distinct value of a group in a single
aggregation buffer, so one hot sensor with billions of readings would land in
one task.  Here the data are scanned twice:

* the first scan builds a mergeable quantile sketch (KLL) per group; for each
  target it proposes a bracket of values, a few times the sketch's error wide;
* the second scan counts the rows below, between and inside the brackets of each
  group, and keeps the inside values added up by value.  The counts prove where each
  target lies, whatever the sketch said; a target outside its bracket (rare) gets the
  gap that holds it as its bracket, and one more scan.

What stays, about two hundredths of a big group per target, is *selected*
from: equal-width histograms narrow a target to the one cell that contains its rank,
until its cell is one value or holds at most ``rank_limit`` values, which are ranked.
Only per-target metadata (bounded by groups x probs) reaches the driver.

The interpolation matches pandas ``quantile`` / DuckDB ``quantile_cont``:
position ``p * (n - 1)`` between the two neighbouring order statistics.
Values may be infinite: an infinite end has a cell of its own.  NaN is the largest
value, as in Spark's order.
"""
from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import join_on_keys

MAX_TARGETS = 200_000  # targets are broadcast: groups x probs x 2 must stay metadata-sized
RANK_LIMIT = 10_000  # a band this small is ranked exactly inside one window partition
SKETCH_K = 1_024  # a sketch holds about 3 k doubles
GRID = 512  # sketched quantiles that a summary keeps
HASHED_GROUPS = 2_048  # sketches that a task holds at once before it sorts by group


@dataclass
class Group:
    """One group's counts and ends (NaN apart), and its brackets in ascending order."""
    key: tuple
    n: int
    finite: int
    low: float | None
    high: float | None
    brackets: list


def sketch_error(k: int) -> float:
    """Rank error of a KLL sketch that 99 % of the answers keep."""
    return 2.296 / k ** 0.9723


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                    probs: Sequence[float], buckets: int = 4096,
                    rank_limit: int = RANK_LIMIT, sketch_k: int = SKETCH_K) -> DataFrame:
    """Return ``group_cols + [prob, quantile, n]`` for each group and prob.

    ``df`` is long-form (one value per row); NULL values are ignored, a NULL group
    is a group.
    """
    spark = df.sparkSession
    group_cols = list(group_cols)
    data = df.select(*group_cols, F.col(value_col).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    groups = _sketched(data, group_cols, probs, rank_limit, sketch_k)
    wanted, resolved = [], {}
    for gid, g in enumerate(groups):
        for p in probs:
            pos = p * (g.n - 1)
            k_lo = math.floor(pos)
            wanted.append((gid, float(p), k_lo, min(k_lo + 1, g.n - 1), pos - k_lo))
    open_t = {(gid, k) for gid, _p, k_lo, k_hi, _f in wanted for k in (k_lo, k_hi)}
    for gid, k in list(open_t):
        g = groups[gid]
        if k >= g.finite or g.low == g.high:
            resolved[(gid, k)] = math.nan if k >= g.finite else g.low
            open_t.discard((gid, k))
    _resolve(data, group_cols, df.schema, groups, open_t, resolved, buckets, rank_limit)
    out_rows = []
    for gid, p, k_lo, k_hi, frac in wanted:
        a, b = resolved[(gid, k_lo)], resolved[(gid, k_hi)]
        q = a + frac * (b - a) if frac else a
        out_rows.append((*groups[gid].key, p, float(q), groups[gid].n))
    out_schema = T.StructType([df.schema[c] for c in group_cols] + [
        T.StructField("prob", T.DoubleType()), T.StructField("quantile", T.DoubleType()),
        T.StructField("n", T.LongType())])
    return spark.createDataFrame(out_rows, out_schema)


def _resolve(data: DataFrame, group_cols: list, schema: T.StructType, groups: list[Group], open_t: set,
             resolved: dict, buckets: int, rank_limit: int) -> None:
    """Second scan, and one more while a target lies outside its bracket."""
    spark = data.sparkSession
    while open_t:
        at_once = sorted({gid for gid, _k in open_t})
        banded = _banded(data, group_cols, schema, groups, at_once).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            targets, band_rows, gaps = _located(banded, groups, open_t)
            _select(spark, banded.where("_v IS NOT NULL"), targets, band_rows, resolved, buckets, rank_limit)
        finally:
            banded.unpersist()
        open_t = set(gaps)
        for gid in {gid for gid, _k in gaps}:
            groups[gid].brackets = sorted({gaps[t] for t in gaps if t[0] == gid})


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _sketched(data: DataFrame, group_cols: list, probs: Sequence[float], rank_limit: int, k: int) -> list[Group]:
    """First scan: every group's counts, ends and sketched brackets.

    A small group's bracket is its whole range: its values are ranked at once."""
    number = F.when(~F.isnan("_v"), F.col("_v"))
    reach = 2 * sketch_error(k)
    ranks = [r for p in probs for r in (max(p - reach, 0.0), min(p + reach, 1.0))]
    found = (data.groupBy(*group_cols)
             .agg(F.count("*").alias("_n"), F.count(number).alias("_finite"), F.min(number).alias("_lo"),
                  F.max(number).alias("_hi"), F.kll_sketch_agg_double(number, F.lit(k)).alias("_sketch"))
             .withColumn("_ends", F.when(F.col("_finite") > rank_limit, F.kll_sketch_get_quantile_double(
                 "_sketch", F.array(*[F.lit(float(r)) for r in ranks]))))
             .drop("_sketch").where("_n > 0").limit(MAX_TARGETS // (2 * len(probs)) + 1))
    with _setting(data.sparkSession, "spark.sql.objectHashAggregate.sortBased.fallbackThreshold", str(HASHED_GROUPS)):
        rows = found.collect()
    if len(rows) * len(probs) * 2 > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} quantile targets: groups must be metadata-sized")
    groups = []
    for r in rows:
        brackets = [(r["_lo"], r["_hi"])]
        if r["_ends"]:
            ends = iter(r["_ends"])
            brackets = [(r["_lo"] if p - reach <= 0 else lo, r["_hi"] if p + reach >= 1 else hi)
                        for p, lo, hi in zip(probs, ends, ends)]
        groups.append(Group(tuple(r[c] for c in group_cols), r["_n"], r["_finite"], r["_lo"], r["_hi"], _apart(brackets)))
    return groups


def _apart(brackets: list) -> list:
    """The brackets in ascending order, those that meet as one."""
    out: list = []
    for lo, hi in sorted(brackets):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _banded(data: DataFrame, group_cols: list, schema: T.StructType, groups: list[Group], at_once: list) -> DataFrame:
    """Second scan: (_gid, _slot, _v, _c).  Slot 2i + 1 is the group's bracket i, whose
    values are kept; slot 2i is what lies before it, of which only the count is."""
    width = max(len(groups[gid].brackets) for gid in at_once)
    rows = []
    for gid in at_once:
        ends = [float(e) for b in groups[gid].brackets for e in b]
        rows.append((*groups[gid].key, gid, *ends, *[math.nan] * (2 * width - len(ends))))  # nothing reaches NaN
    names = [f"_end{i}" for i in range(2 * width)]
    table = data.sparkSession.createDataFrame(rows, T.StructType(
        [schema[c] for c in group_cols] + [T.StructField("_gid", T.LongType())]
        + [T.StructField(c, T.DoubleType()) for c in names]))
    # the table of brackets is bounded by MAX_TARGETS, checked in the first scan
    keyed = join_on_keys(data.where(~F.isnan("_v")), table, group_cols, broadcast_right=True)
    slot = F.lit(0)
    for i, c in enumerate(names):
        slot = slot + (F.col("_v") > F.col(c) if i % 2 else F.col("_v") >= F.col(c)).cast("int")
    return (keyed.select("_gid", slot.alias("_slot"), "_v")
            .select("_gid", "_slot", F.when(F.col("_slot") % 2 == 1, F.col("_v")).alias("_v"))
            .groupBy("_gid", "_slot", "_v").agg(F.count("*").alias("_c")))


def _located(banded: DataFrame, groups: list[Group], open_t: set) -> tuple[dict, dict, dict]:
    """Which slot holds each target, by exact counts: for targets in a bracket
    [low, high, rows below] and the bracket's values; for the others the gap."""
    slots: dict = {}
    for r in banded.groupBy("_gid", "_slot").agg(F.sum("_c").alias("_c"), F.count("_v").alias("_values"),
                                                 F.min("_v").alias("_lo"), F.max("_v").alias("_hi")).collect():
        slots.setdefault(r["_gid"], {})[r["_slot"]] = r
    targets, band_rows, gaps = {}, {}, {}
    for gid, k in open_t:
        below = 0
        for slot, r in sorted(slots[gid].items()):
            if k < below + r["_c"]:
                break
            below += r["_c"]
        if slot % 2:
            targets[(gid, k)], band_rows[(gid, k)] = [r["_lo"], r["_hi"], below], r["_values"]
        else:
            g, i = groups[gid], slot // 2
            gaps[(gid, k)] = (g.brackets[i - 1][1] if i else g.low, g.brackets[i][0] if i < len(g.brackets) else g.high)
    return targets, band_rows, gaps


def _select(spark: SparkSession, values: DataFrame, targets: dict, band_rows: dict, resolved: dict, buckets: int, rank_limit: int) -> None:
    """Distributed selection of every target among ``values`` (_gid, _v, _c: how often)."""
    while True:  # the ends of an open band lie in different cells, so every pass narrows it
        open_t = []
        for (g, k), (lo, hi, below) in targets.items():
            if lo == hi:
                resolved[(g, k)] = lo
            else:
                open_t.append((g, k, lo, hi, below))
        if not open_t:
            return
        if all(band_rows[(g, k)] <= rank_limit for g, k, *_ in open_t):
            return _finish_by_rank(spark, values, targets, [(g, k) for g, k, *_ in open_t], resolved)
        tdf = spark.createDataFrame(
            [(i, g, k, float(lo), float(hi), int(below)) for i, (g, k, lo, hi, below) in enumerate(open_t)],
            "_tid long, _gid long, _k long, _lo double, _hi double, _below long")
        cell = _cell(F.col("_v"), F.col("_lo"), F.col("_hi"), buckets)
        hist = (values.join(F.broadcast(tdf), "_gid")
                .where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
                .select("_tid", "_k", "_below", cell.alias("_cell"), "_v", "_c")
                .groupBy("_tid", "_k", "_below", "_cell")
                .agg(F.sum("_c").alias("_c"), F.count("*").alias("_values"), F.min("_v").alias("_cmin"), F.max("_v").alias("_cmax")))
        w = Window.partitionBy("_tid").orderBy("_cell")
        picked = (hist.withColumn("_cum", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
                  .withColumn("_before", F.col("_cum") - F.col("_c"))
                  .where((F.col("_below") + F.col("_before") <= F.col("_k"))
                         & (F.col("_k") < F.col("_below") + F.col("_cum")))
                  .select("_tid", "_cmin", "_cmax", "_values", (F.col("_below") + F.col("_before")).alias("_nb"))
                  .collect())
        for r in picked:
            target = open_t[r["_tid"]][:2]
            targets[target] = [r["_cmin"], r["_cmax"], r["_nb"]]
            band_rows[target] = r["_values"]


def _cell(v, lo, hi, buckets: int):
    """Monotone (non-decreasing in v) bucket of v inside [lo, hi].

    Finite intervals are split evenly (halves avoid overflow of hi - lo);
    an infinite end puts the end value in its own cell and spreads the rest
    by arctangent, which is monotone and bounded."""
    b = float(buckets)
    lin = F.floor((v * 0.5 - lo * 0.5) / (hi * 0.5 - lo * 0.5) * F.lit(b))
    arc = F.lit(1.0) + F.floor((F.atan(v) - F.atan(lo)) / (F.atan(hi) - F.atan(lo)) * F.lit(b - 2.0))
    inf = float("inf")
    raw = (F.when(v == lo, F.lit(0.0)).when(v == hi, F.lit(b - 1.0))
           .when((F.abs(lo) == inf) | (F.abs(hi) == inf),
                 F.least(F.greatest(F.coalesce(F.nanvl(arc, F.lit(1.0)), F.lit(1.0)), F.lit(1.0)), F.lit(b - 2.0)))
           .otherwise(lin))
    return F.least(F.greatest(raw, F.lit(0.0)), F.lit(b - 1.0)).cast("int")


def _finish_by_rank(spark, values, targets, open_t, resolved):
    """Rank the values inside each open band (at most ``rank_limit`` values
    per band, so one window partition stays bounded); targets that share a
    band are ranked once."""
    bands: dict = {}
    for g, k in open_t:
        lo, hi, below = targets[(g, k)]
        bands.setdefault((g, float(lo), float(hi), int(below)), []).append(k)
    band_rows = [(i, g, lo, hi, below) for i, (g, lo, hi, below) in enumerate(bands)]
    want = [(i, k) for i, key in enumerate(bands) for k in bands[key]]
    bdf = spark.createDataFrame(band_rows, "_bid long, _gid long, _lo double, _hi double, _below long")
    kdf = spark.createDataFrame(want, "_bid long, _k long")
    w = Window.partitionBy("_bid").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (values.join(F.broadcast(bdf), "_gid")
              .where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
              .withColumn("_past", F.sum("_c").over(w) + F.col("_below"))
              .join(F.broadcast(kdf), "_bid")
              .where((F.col("_past") - F.col("_c") <= F.col("_k")) & (F.col("_k") < F.col("_past")))
              .select("_gid", "_k", "_v").collect())
    for r in ranked:
        resolved[(r["_gid"], r["_k"])] = r["_v"]


def quantile_wide(df: DataFrame, cols: Sequence[str], probs: Sequence[float], **kw) -> dict:
    """Exact quantiles of several columns of a wide table: ``{col: {prob: q}}``.

    The table is unpivoted to (sensor, value) so every column is a group and
    all columns are served by the same scans."""
    long = unpivot(df, cols)
    out: dict = {c: {} for c in cols}
    for r in exact_quantiles(long, ["sensor"], "value", probs, **kw).collect():
        out[r["sensor"]][r["prob"]] = r["quantile"]
    return out


@dataclass
class Summary:
    """One column's cells: least and largest value apart from infinities (NaN is the
    largest), the finite values' count and ends, and how many cells are anything else."""
    least: float | None = None
    largest: float | None = None
    finite: int = 0
    low: float | None = None
    high: float | None = None
    nulls: int = 0
    minus: int = 0
    plus: int = 0
    nans: int = 0
    grid: list | None = None  # sketched quantiles of the finite values

    @property
    def infinite(self) -> int:
        return self.minus + self.plus

    @property
    def cells(self) -> int:
        return self.finite + self.nulls + self.infinite + self.nans


def summarise(df: DataFrame, cols: Sequence[str], rank_limit: int = RANK_LIMIT, sketch_k: int = SKETCH_K) -> dict[str, Summary]:
    """Counts, ends and sketches of the columns of a wide table, in one scan."""
    cols = list(cols)
    if not cols:
        return {}
    v = F.col("_v")
    usual = F.abs(v) != float("inf")  # NaN is
    finite = F.when(usual & ~F.isnan(v), v)
    told = (_cells(df, cols).groupBy("_at")
            .agg(F.min(F.when(usual, v)).alias("least"), F.max(F.when(usual, v)).alias("largest"), F.count(finite).alias("finite"),
                 F.min(finite).alias("low"), F.max(finite).alias("high"), F.count_if(v.isNull()).alias("nulls"),
                 F.count_if(v == -float("inf")).alias("minus"), F.count_if(v == float("inf")).alias("plus"),
                 F.count_if(F.isnan(v)).alias("nans"), F.kll_sketch_agg_double(finite, F.lit(sketch_k)).alias("_sketch"))
            .withColumn("grid", F.when(F.col("finite") > rank_limit, F.kll_sketch_get_quantile_double(
                "_sketch", F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]))))
            .drop("_sketch"))
    with _setting(df.sparkSession, "spark.sql.objectHashAggregate.sortBased.fallbackThreshold", str(HASHED_GROUPS)):
        rows = [r.asDict() for r in told.collect()]  # one per column
    return {c: Summary() for c in cols} | {cols[r.pop("_at")]: Summary(**r) for r in rows}


def order_statistics(df: DataFrame, summaries: dict[str, Summary], wanted: set, buckets: int = 4096,
                     rank_limit: int = RANK_LIMIT, sketch_k: int = SKETCH_K) -> dict:
    """``{(column, rank): value}`` of the finite values of the summarised columns of
    ``df``, all by one scan, whatever number of ranks a column has."""
    if len(wanted) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} order statistics")
    reach = 2 * sketch_error(sketch_k)
    cols = list(summaries)
    at = {c: i for i, c in enumerate(cols)}
    ends = {c: {0: s.low, s.finite - 1: s.high} for c, s in summaries.items()}
    resolved = {(at[c], k): ends[c][k] if k in ends[c] else s.low for c, k in wanted if k in ends[c] or (s := summaries[c]).low == s.high}
    open_t = {(at[c], k) for c, k in wanted} - set(resolved)
    groups = []
    for c, s in summaries.items():
        brackets = [(s.low, s.high)]
        if s.grid:
            shares = [k / (s.finite - 1) for gid, k in open_t if gid == at[c]]
            near = [(math.floor((p - reach) * GRID), math.ceil((p + reach) * GRID)) for p in shares]
            brackets = [(s.low if i <= 0 else s.grid[i], s.high if j >= GRID else s.grid[j]) for i, j in near]
        groups.append(Group((at[c],), s.finite, s.finite, s.low, s.high, _apart(brackets)))
    data = _cells(df, cols).where(F.abs("_v") < float("inf"))
    _resolve(data, ["_at"], data.schema, groups, open_t, resolved, buckets, rank_limit)
    return {(cols[gid], k): v for (gid, k), v in resolved.items()}


def _cells(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """(ids..., _at, _v): every cell of the columns as a double, with its column's place."""
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in cols])
    return df.select(*ids, F.posexplode(values).alias("_at", "_v"))


def unpivot(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Wide -> long (ids..., sensor, value) with doubles.

    The row's values are exploded from one array: the plan stays linear in the
    columns, where an Expand would hold a projection per column."""
    names = F.array(*[F.lit(c) for c in cols])
    return _cells(df, cols, ids).select(*ids, F.get(names, F.col("_at")).alias("sensor"), F.col("_v").alias("value"))

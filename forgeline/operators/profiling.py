"""Missing rates, constant columns, counts, profiles, correlation, histograms,
density curves and stage audits (D4-D6, D9-D16).

Per-column statistics are computed in a single ``agg`` pass each; the
metadata they yield (one number per column) is the only thing collected.
"""
from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import null_count_expr, truthy
from ..functions.moments import pair_moments

KERNEL_REACH = 9.0  # bandwidths


def missing_rates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long table (column, missing_rate, missing) from one aggregation."""
    aggs = [F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols]
    wide = df.agg(F.count("*").alias("_rows"), *aggs)
    long = wide.unpivot(["_rows"], list(cols), "column", "missing")
    return long.select("column", F.col("missing").cast("long").alias("missing"),
                       F.when(F.col("_rows") > 0, F.col("missing") / F.col("_rows")).alias("missing_rate"))


def sparse_columns(df: DataFrame, cols: Sequence[str], threshold: float = 0.5) -> list[str]:
    """Columns whose NULL share is strictly above ``threshold`` (metadata)."""
    rates = missing_rates(df, cols).where(F.col("missing_rate") > threshold).select("column").collect()  # <= len(cols)
    keep = {r["column"] for r in rates}
    return [c for c in cols if c in keep]


def drop_sparse_columns(df: DataFrame, cols: Sequence[str], threshold: float = 0.5) -> tuple[DataFrame, list[str]]:
    dropped = sparse_columns(df, cols, threshold)
    return df.drop(*dropped), dropped


def missing_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Overall rate, max column rate and remaining NULL cells, one row."""
    n = len(cols)
    per_col = [F.avg(F.col(c).isNull().cast("double")) for c in cols]
    return df.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(null_count_expr(cols)), F.lit(0)).cast("long").alias("missing_cells"),
        (F.sum(null_count_expr(cols)) / (F.count("*") * F.lit(n))).alias("overall_rate"),
        (F.greatest(*per_col) if n > 1 else per_col[0]).alias("max_column_rate"))


def constant_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Columns with min = max over >= 2 non-NULL values (zero variance).

    ``min = max`` is exact where a floating variance can miss constants."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"mn_{c}"), F.max(c).alias(f"mx_{c}"), F.count(c).alias(f"n_{c}")]
    r = df.agg(*aggs).first()
    return [c for c in cols if r[f"n_{c}"] >= 2 and r[f"mn_{c}"] == r[f"mx_{c}"]]


def constant_column_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D6 as a DataFrame (column, n, is_constant) without a driver round trip."""
    aggs = []
    for c in cols:
        aggs.append(F.struct(F.lit(c).alias("column"), F.count(c).alias("n"),
                             ((F.count(c) >= 2) & (F.min(c) == F.max(c))).alias("is_constant")).alias(c))
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[F.col(c) for c in cols])).alias("s")).select("s.*")


def drop_constant_columns(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    dropped = constant_columns(df, cols)
    return df.drop(*dropped), dropped


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, count), NULL kept as its own group."""
    return df.groupBy(col).agg(F.count("*").alias("count"))


def class_ratio(df: DataFrame, col: str) -> DataFrame:
    """(value, count, percent); the window runs over the aggregated
    counts (one row per class), never over raw rows."""
    vc = value_counts(df, col)
    return vc.withColumn("percent", F.col("count") * F.lit(100.0) / F.sum("count").over(Window.partitionBy()))


def flag_totals(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sum of each 0/1 flag column, long form (flag, total)."""
    wide = df.agg(*[F.sum(F.col(c).cast("long")).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "flag", "total").withColumn("total", F.col("total").cast("long"))


def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per column: dtype, rows, non-NULL count, min and max (numeric
    columns), min_text and max_text (all others), from a single aggregation."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    structs = []
    for c in cols:
        numeric = types[c] in ("double", "float", "int", "bigint", "smallint", "tinyint") or types[c].startswith("decimal")
        mn = F.min(c).cast("double") if numeric else F.lit(None).cast("double")
        mx = F.max(c).cast("double") if numeric else F.lit(None).cast("double")
        structs.append(F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                                F.count("*").alias("n_rows"), F.count(c).alias("non_null"),
                                mn.alias("min"), mx.alias("max"),
                                (F.lit(None) if numeric else F.min(c)).cast("string").alias("min_text"),
                                (F.lit(None) if numeric else F.max(c)).cast("string").alias("max_text")).alias(c))
    wide = df.agg(*structs)
    return wide.select(F.explode(F.array(*[F.col(c) for c in cols])).alias("s")).select("s.*")


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """D12 (sample part): the first ``n`` rows; the limit is the feature."""
    return df.limit(n)


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair (col_a, col_b, corr), long form, missing
    values left out pair by pair; NULL where a column doesn't vary.

    One scan adds up matrix products block by block, so the plan doesn't grow with
    the columns; what reaches the driver is a fixed number of numbers per pair."""
    cols = list(cols)
    m = pair_moments(df, cols)
    if m is None:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, corr double")
    told = m.correlation()
    np.fill_diagonal(told, 1.0)
    at = np.arange(len(cols))
    names = pa.array(cols)
    table = pa.table({"col_a": names.take(pa.array(np.repeat(at, len(cols)))), "col_b": names.take(pa.array(np.tile(at, len(cols)))), "corr": pa.array(told.ravel(), mask=np.isnan(told.ravel()))})
    return df.sparkSession.createDataFrame(table)


def histogram(df: DataFrame, col: str, bins: int = 50, by: str | None = None,
              density: bool = False, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Equal-width histogram over [min, max]; the last bin is closed.

    Output (by?, bin, lo, hi, count[, density])."""
    if lo is None or hi is None:
        r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
        lo, hi = r["lo"], r["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, count long")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    keys = ([by] if by else [])
    h = (df.where(F.col(col).isNotNull()).select(*keys, b.alias("bin"))
         .groupBy(*keys, "bin").agg(F.count("*").alias("count"))
         .withColumn("lo", F.lit(lo) + F.col("bin") * F.lit(width))
         .withColumn("hi", F.lit(lo) + (F.col("bin") + 1) * F.lit(width)))
    if density:
        tot = Window.partitionBy(*keys) if keys else Window.partitionBy()  # over <= bins rows per group
        h = h.withColumn("density", F.col("count") / (F.sum("count").over(tot) * F.lit(width)))
    return h


def density_curve(df: DataFrame, col: str, points: int = 100) -> DataFrame:
    """Gaussian kernel density at ``points`` grid positions linspace(min, max),
    Scott bandwidth sd * n^(-1/5).

    Rows are first reduced to (distinct value, weight) by a partial/final aggregation.
    Each distinct value then goes to the grid points within KERNEL_REACH bandwidths
    only: what is left out of a grid point's sum is less than exp(-KERNEL_REACH^2 / 2)
    = 2.6e-18 per row, below the rounding of the sum itself.  The bandwidth shrinks
    with n, and so do the grid points of a value."""
    st = df.agg(F.count(col).alias("n"), F.stddev_samp(col).alias("sd"),
                F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    n, sd, lo, hi = st["n"], st["sd"], st["lo"], st["hi"]
    if not n or sd is None or sd == 0:
        return df.sparkSession.createDataFrame([], "i int, x double, density double")
    bw = sd * n ** (-1.0 / 5.0)
    step = (hi - lo) / (points - 1) if points > 1 else 0.0
    xs = [i * step + lo for i in range(points)]
    xs[-1] = hi
    grid = F.array(*[F.lit(float(x)) for x in xs])
    norm = 1.0 / (n * bw * math.sqrt(2 * math.pi))
    values = (df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("_v"))
              .agg(F.count("*").alias("_w")))
    near = lambda side: (F.col("_v") + F.lit(side * KERNEL_REACH * bw) - F.lit(lo)) / F.lit(step or 1.0)
    first = F.greatest(F.lit(0), F.floor(near(-1)).cast("int"))
    last = F.least(F.lit(points - 1), F.ceil(near(1)).cast("int"))
    spread = values.select(F.explode(F.sequence(first, last)).alias("i"), "_v", "_w").withColumn("x", F.get(grid, F.col("i")))
    kern = F.col("_w") * F.exp(F.lit(-0.5) * F.pow((F.col("x") - F.col("_v")) / F.lit(bw), 2))
    sums = spread.groupBy("i").agg((F.sum(kern) * F.lit(norm)).alias("density"))
    every = df.sparkSession.range(points).select(F.col("id").cast("int").alias("i")).withColumn("x", F.get(grid, F.col("i")))
    return every.join(F.broadcast(sums), "i", "left").select("i", "x", F.coalesce("density", F.lit(0.0)).alias("density"))  # at most ``points`` rows


def audit(df: DataFrame, rules: Mapping[str, Column], upstream: DataFrame | None = None,
          upstream_stage: str = "duplicates") -> DataFrame:
    """Removal audit of a rule cascade in one aggregation.

    ``rules`` maps stage name -> drop predicate (NULL = keep).  A row is
    charged to the first stage that removes it, which is what applying the
    rules one after another does.  Output: stage, stage_order, rows_before,
    removed, rows_after, removed_share.  The only windows run over the
    per-stage table (stages + 1 rows).

    ``upstream`` is the table before a row-reducing step that produced
    ``df`` (e.g. keep-first deduplication); that step is audited as stage 0
    from the row-count difference, so no row has to be joined back."""
    names = list(rules)
    if upstream is not None:
        signed = upstream.select(F.lit(1).alias("_d")).unionByName(df.select(F.lit(-1).alias("_d")))
        head = signed.agg(F.sum("_d").cast("long").alias("removed")).select(
            F.lit(upstream_stage).alias("stage"), F.lit(0).alias("stage_order"), "removed")
        return _audit_chain(head, audit(df, rules))
    first = None
    for i in reversed(range(len(names))):
        hit = truthy(rules[names[i]])
        first = F.when(hit, F.lit(i)) if first is None else F.when(hit, F.lit(i)).otherwise(first)
    counts = df.select(first.alias("stage_order")).groupBy("stage_order").agg(F.count("*").alias("removed"))
    stages = df.sparkSession.createDataFrame(list(enumerate(names)), "stage_order int, stage string")
    per = stages.join(counts, "stage_order", "full").fillna(0, subset=["removed"])
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("stage_order").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    per = (per.withColumn("_total", F.sum("removed").over(everything))
           .withColumn("rows_before", F.col("_total") - F.coalesce(F.sum("removed").over(before), F.lit(0))))
    return (per.where(F.col("stage").isNotNull())
            .select("stage", "stage_order", "rows_before", "removed",
                    (F.col("rows_before") - F.col("removed")).alias("rows_after"),
                    F.when(F.col("rows_before") > 0, F.col("removed") / F.col("rows_before")).alias("removed_share")))


def _audit_chain(head: DataFrame, inner: DataFrame) -> DataFrame:
    """Prepend a stage known only by its removed count to an audit table; its
    rows_before is the inner audit's first rows_before plus those removals.
    The windows run over the stage table only."""
    every = Window.partitionBy()
    stacked = (head.select("stage", F.col("stage_order").cast("int").alias("stage_order"),
                           F.col("removed").cast("long").alias("removed"), F.lit(None).cast("long").alias("rows_before"))
               .unionByName(inner.select("stage", (F.col("stage_order") + 1).cast("int").alias("stage_order"),
                                         "removed", "rows_before")))
    base = F.max(F.when(F.col("stage_order") == 1, F.col("rows_before"))).over(every)
    lead = F.max(F.when(F.col("stage_order") == 0, F.col("removed"))).over(every)
    out = stacked.withColumn("rows_before", F.when(F.col("stage_order") == 0, base + lead)
                             .otherwise(F.col("rows_before")))
    return out.select("stage", "stage_order", "rows_before", "removed",
                      (F.col("rows_before") - F.col("removed")).alias("rows_after"),
                      F.when(F.col("rows_before") > 0, F.col("removed") / F.col("rows_before")).alias("removed_share"))

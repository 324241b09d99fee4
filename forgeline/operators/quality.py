"""Quality indicators: the five-indicator stage report (E8) and the MDQI
score of a wide sensor table (E1-E7).

The report is one aggregation per stage.  MDQI runs the cleansing cascade
(dedupe -> sparse columns -> sparse rows -> median fill -> Inf repair ->
constant columns -> IQR clip -> label domain) with each statistic measured
on the previous stage's output; only per-column metadata reaches the driver.
"""
from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import grade, qi, truthy
from ..functions.quantiles import order_statistics, summarise
from .cleansing import clip_columns, drop_sparse_rows, fill_values, keep_label_domain, replace_infinite
from .profiling import sparse_columns


def schema_check(df: DataFrame, time_col: str, numeric_cols: Sequence[str]) -> str:
    """E8c: 'Pass' when the time column is a timestamp and the measures numeric."""
    types = dict(df.dtypes)
    time_ok = types.get(time_col, "").startswith("timestamp")
    num_ok = all(types.get(c) in ("double", "float", "int", "bigint", "smallint", "tinyint")
                 or types.get(c, "").startswith("decimal") for c in numeric_cols)
    return "Pass" if time_ok and num_ok else "Fail"


def quality_report(df: DataFrame, stage: str, key_cols: Sequence[str],
                   limits: Mapping[str, tuple[float, float]], rule: Column | None,
                   label_col: str | None, time_col: str) -> DataFrame:
    """One row (stage, n_rows, duplicate_ratio, missing_ratio,
    validity_ratio, consistency_ratio, accuracy).

    duplicate_ratio counts excess rows of repeated ``key_cols`` (D2);
    missing_ratio is the largest per-column NULL share; validity_ratio the
    share of rows with a present value outside its closed range (E8a);
    consistency_ratio the share where the rule disagrees with the label,
    NULL while the label column is absent (E8b)."""
    measures = list(limits)
    n = F.count("*")
    invalid = None
    for c, (lo, hi) in limits.items():
        t = ~F.col(c).between(lo, hi) & F.col(c).isNotNull()
        invalid = t if invalid is None else invalid | t
    # excess duplicates = rows - distinct keys; the struct keeps NULL keys
    aggs = [n.alias("n_rows"), (n - F.count_distinct(F.struct(*key_cols))).alias("_excess"),
            F.greatest(*[F.avg(F.col(c).isNull().cast("double")) for c in measures]).alias("missing_ratio")
            if len(measures) > 1 else F.avg(F.col(measures[0]).isNull().cast("double")).alias("missing_ratio"),
            F.avg(F.coalesce(invalid, F.lit(False)).cast("double")).alias("validity_ratio")]
    has_label = label_col is not None and label_col in df.columns
    if has_label:
        mismatch = truthy(rule) != truthy(F.col(label_col) == 1)
        aggs.append(F.avg(mismatch.cast("double")).alias("consistency_ratio"))
    else:
        aggs.append(F.lit(None).cast("double").alias("consistency_ratio"))
    body = df.agg(*aggs)
    acc = schema_check(df, time_col, measures)
    return (body
            .select(F.lit(stage).alias("stage"), "n_rows",
                    F.when(F.col("n_rows") > 0, F.coalesce(F.col("_excess"), F.lit(0)) / F.col("n_rows"))
                    .alias("duplicate_ratio"),
                    "missing_ratio", "validity_ratio", "consistency_ratio",
                    F.when(F.col("n_rows") > 0, F.lit(acc)).alias("accuracy")))


MDQI_SCHEMA = T.StructType([T.StructField(n, t) for n, t in [
    ("n_original", T.LongType()), ("n_sensors", T.LongType()),
    ("e_uni", T.LongType()), ("q_uni", T.DoubleType()),
    ("e_com_cols", T.LongType()), ("e_com_rows", T.LongType()), ("e_com_cells", T.LongType()),
    ("q_com", T.DoubleType()),
    ("e_val_inf", T.LongType()), ("e_val_const", T.LongType()), ("q_val", T.DoubleType()),
    ("e_con", T.LongType()), ("n_con", T.LongType()), ("q_con", T.DoubleType()),
    ("e_acc", T.LongType()), ("q_acc", T.DoubleType()),
    ("mdqi", T.DoubleType()), ("grade", T.StringType()),
    ("rows_final", T.LongType()), ("sensors_final", T.LongType())]])


def _qi(n: int, e: int) -> float:
    return (n - e) / n * 100.0 if n > 0 else 0.0


UNKNOWN = object()  # a finite value that hasn't been read yet


@dataclass
class Run:
    """Consecutive places of a column's order: ``n`` finite values of the table from
    rank ``first`` on, or ``n`` times ``value``."""
    n: int
    first: int | None = None
    value: object = None


class ColumnOrder:
    """The order of a column's values through the repairs.

    A repair only adds cells of one value or drops the infinite ones, so a quantile of
    a repaired column is one of the original finite values, or between two, whose ranks
    follow from counts.  A rank whose value isn't in ``known`` is put into ``asked``
    and its value counts as UNKNOWN; the ranks that follow don't depend on it."""

    def __init__(self, runs: Sequence[Run], known: Mapping, asked: set):
        self.runs, self.known, self.asked = [r for r in runs if r.n], known, asked

    def size(self) -> int:
        return sum(r.n for r in self.runs)

    def _value(self, k: int) -> object:
        for r in self.runs:
            if k < r.n:
                break
            k -= r.n
        if r.first is None:
            return r.value
        if r.first + k not in self.known:
            self.asked.add(r.first + k)
        return self.known.get(r.first + k, UNKNOWN)

    def quantile(self, p: float) -> object:
        """Linear interpolation as in ``functions.quantiles``; None without values."""
        if not self.runs:
            return None
        pos = p * (self.size() - 1)
        k = math.floor(pos)
        a, b = self._value(k), self._value(min(k + 1, self.size() - 1))
        if pos == k:
            return a
        x, y = (0.0 if v is UNKNOWN else v for v in (a, b))
        q = x + (pos - k) * (y - x)
        return UNKNOWN if math.isfinite(q) and UNKNOWN in (a, b) else q

    def median_filled(self, n: int) -> tuple[object, ColumnOrder]:
        """The median, and the order with ``n`` more cells of it."""
        m = self.quantile(0.5)
        if m is None:
            return None, self
        if m is UNKNOWN or math.isfinite(m):
            at = math.floor(0.5 * (self.size() - 1)) + 1  # after the lower of the median's neighbours
        else:
            at = 0 if m < 0 else self.size() - (0 if math.isnan(m) else sum(r.n for r in self.runs if r.value is not UNKNOWN and r.value is not None and math.isnan(r.value)))
        before, after = [], []
        for r in self.runs:
            left = min(max(at, 0), r.n)
            before.append(Run(left, r.first, r.value))
            after.append(Run(r.n - left, None if r.first is None else r.first + left, r.value))
            at -= r.n
        return m, ColumnOrder([*before, Run(n, value=m), *after], self.known, self.asked)

    def without_infinities(self) -> ColumnOrder:
        return ColumnOrder([r for r in self.runs if r.value in (None, UNKNOWN) or not math.isinf(r.value)], self.known, self.asked)


class WideCascade:
    """E1-E7 as a lazily evaluated cascade over a wide sensor table.

    Stages (each measured on the previous one's output): ``deduped`` ->
    ``rows_kept`` (sparse columns, then sparse rows, dropped) -> ``filled``
    (median) -> ``repaired`` (+-Inf -> median) -> ``nonconstant`` ->
    ``clipped`` (exact 3*IQR fences) -> ``final`` (label domain).  Only
    per-column metadata is collected; every stage is a DataFrame."""

    def __init__(self, df: DataFrame, sensors: Sequence[str], label: str, order_by: Sequence,
                 label_domain: Sequence = (-1, 1), col_threshold: float = 0.5,
                 row_threshold: float = 0.5, k: float = 3.0):
        self.raw, self.sensors, self.label, self.order_by = df, list(sensors), label, list(order_by)
        self.domain, self.col_thr, self.row_thr, self.k = list(label_domain), col_threshold, row_threshold, k
        self._memo: dict = {}

    def _m(self, key, fn):
        if key not in self._memo:
            self._memo[key] = fn()
        return self._memo[key]

    # -- uniqueness
    def _uniqueness(self) -> tuple[int, int, int]:
        """(rows, rows whose sensor vector repeats, distinct vectors), read off
        the dedupe aggregation (which counts each group while picking its first
        row)."""
        def calc():
            r = (self._grouped().agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("n"),
                                     F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c"))), F.lit(0)).alias("e"),
                                     F.count(F.lit(1)).alias("d")).first())
            return int(r["n"]), int(r["e"]), int(r["d"])
        return self._m("uni", calc)

    def _grouped(self) -> DataFrame:
        """One aggregation per distinct sensor vector: the other columns of its
        first row (min_by over the order) and its size; persisted, every later
        stage reads it.  The sensors are the grouping keys, so they cross the
        shuffle once."""
        def calc():
            order = [F.col(o) if isinstance(o, str) else o for o in self.order_by]
            okey = order[0] if len(order) == 1 else F.struct(*order)
            others = [c for c in self.raw.columns if c not in self.sensors]
            first = [F.min_by(F.struct(*[F.col(c) for c in others]), okey).alias("_row")] if others else []
            h = self.raw.withColumn("_h", F.xxhash64(*self.sensors))
            g = (h.groupBy("_h", *self.sensors).agg(*first, F.count("*").alias("_c"))
                 .select(*[F.col(f"_row.`{c}`").alias(c) if c in others else F.col(f"`{c}`") for c in self.raw.columns], "_c"))
            return g.persist(StorageLevel.MEMORY_AND_DISK)
        return self._m("grouped", calc)

    def n_original(self) -> int:
        return self._uniqueness()[0]

    def e_uni(self) -> int:
        return self._uniqueness()[1]

    def deduped(self) -> DataFrame:
        return self._grouped().drop("_c")

    # -- completeness
    def dropped_columns(self) -> list[str]:
        return self._m("dropcols", lambda: sparse_columns(self.deduped(), self.sensors, self.col_thr))

    def live(self) -> list[str]:
        return [c for c in self.sensors if c not in self.dropped_columns()]

    def rows_kept(self) -> DataFrame:
        return self._m("rows", lambda: drop_sparse_rows(self.deduped().drop(*self.dropped_columns()),
                                                        self.live(), self.row_thr))

    def row_stats(self) -> tuple[int, int]:
        """(sparse rows dropped, NULL cells left), from the kept rows' summaries."""
        st = self._summaries()
        kept = max((s.cells for s in st.values()), default=0)  # the same for every column
        return self._uniqueness()[2] - kept if st else 0, sum(s.nulls for s in st.values())

    def _summaries(self) -> dict:
        """One pass over the kept rows gives every live column its counts of finite,
        NULL and infinite cells, its range and a sketch (filling NULLs doesn't touch
        infinities); the plan is linear in the columns, the result has one row per
        column."""
        return self._m("summaries", lambda: summarise(self.rows_kept(), self.live()))

    def _quantiles(self) -> dict:
        """Per live column (median of the kept rows, median once infinities are NULL,
        first and third quartile after the repairs).

        The ranks of all of them among the finite values of the kept rows follow from
        the summaries' counts, so one more pass reads them all."""
        def calc():
            known: dict = {c: {} for c in self.live()}
            while True:  # ranks depend on values only where an interpolation overflows
                asked: dict = {c: set() for c in known}
                told = {c: self._column_quantiles(c, known[c], asked[c]) for c in known}
                wanted = {(c, k) for c, ks in asked.items() for k in ks}
                if not wanted:
                    return told
                for (c, k), v in order_statistics(self.rows_kept(), self._summaries(), wanted).items():
                    known[c][k] = v
        return self._m("quantiles", calc)

    def _column_quantiles(self, c: str, known: Mapping, asked: set) -> tuple:
        s = self._summaries()[c]
        order = ColumnOrder([Run(s.minus, value=-math.inf), Run(s.finite, first=0), Run(s.plus, value=math.inf), Run(s.nans, value=math.nan)],
                            known, asked)
        median, filled = order.median_filled(s.nulls)
        repair = None
        if self.e_inf():
            finite = filled.without_infinities()
            repair, filled = finite.median_filled(s.cells - finite.size())
        return median, repair, filled.quantile(0.25), filled.quantile(0.75)

    def medians(self) -> dict:
        return {c: q[0] for c, q in self._quantiles().items()}

    def filled(self) -> DataFrame:
        return self._m("filled", lambda: fill_values(self.rows_kept(), self.medians()))

    # -- validity
    def e_inf(self) -> int:
        return sum(s.infinite for s in self._summaries().values())

    def repair_medians(self) -> dict:
        """Column medians after +-Inf became NULL (the repair values)."""
        return {c: q[1] for c, q in self._quantiles().items()}

    def repair(self, df: DataFrame) -> DataFrame:
        """The Inf repair applied to ``df`` (which carries the live columns)."""
        if self.e_inf() == 0:
            return df
        return fill_values(replace_infinite(df, self.live()), self.repair_medians())

    def repaired(self) -> DataFrame:
        return self._m("repaired", lambda: self.repair(self.filled()))

    def constant(self) -> list[str]:
        """Columns with min = max over >= 2 values after the repairs, read off
        the summaries: the repaired values are the finite values
        plus the NULL-fill median (if NULLs were filled) plus the Inf-repair
        median (if infinities were repaired) -- no extra pass over the rows."""
        def calc():
            med1 = self.medians()
            med2 = self.repair_medians() if self.e_inf() > 0 else {}
            out = []
            for c, s in self._summaries().items():
                mn, mx, n, nulls, infs = s.least, s.largest, s.finite + s.nans, s.nulls, s.infinite
                vals = [v for v in (mn, mx) if v is not None]
                count = n
                if nulls and med1.get(c) is not None:
                    vals.append(med1[c])
                    count += nulls
                if infs and med2.get(c) is not None:
                    vals.append(med2[c])
                    count += infs
                if count >= 2 and vals and min(vals) == max(vals):
                    out.append(c)
            return out
        return self._m("const", calc)

    def valid_cols(self) -> list[str]:
        return [c for c in self.live() if c not in self.constant()]

    def nonconstant(self) -> DataFrame:
        return self._m("noncon", lambda: self.repaired().drop(*self.constant()))

    # -- consistency
    def bounds(self) -> dict:
        def calc():
            out = {}
            for c in self.valid_cols():
                _, _, q1, q3 = self._quantiles()[c]
                if q1 is not None:
                    out[c] = (q1 - self.k * (q3 - q1), q3 + self.k * (q3 - q1))
            return out
        return self._m("bounds", calc)

    def _tail_counts(self) -> dict:
        """Outlier cells against the fences and the label check, in one
        aggregation over the non-constant table (clipping leaves labels alone)."""
        def calc():
            b = self.bounds()
            ok = truthy(F.col(self.label).isin(self.domain))
            r = self.nonconstant().agg(
                F.count("*").alias("_n"), F.sum((~ok).cast("long")).alias("_bad"), F.sum(ok.cast("long")).alias("_good"),
                *[F.sum(F.coalesce((F.col(c) < lo) | (F.col(c) > hi), F.lit(False)).cast("long")).alias(c)
                  for c, (lo, hi) in b.items()]).first()
            return {"e_con": int(sum(r[c] or 0 for c in b)), "n": int(r["_n"]),
                    "bad": int(r["_bad"] or 0), "good": int(r["_good"] or 0)}
        return self._m("tail", calc)

    def outliers(self) -> tuple[int, int]:
        t = self._tail_counts()
        return t["e_con"], t["n"] * len(self.valid_cols())

    def clipped(self) -> DataFrame:
        return self._m("clipped", lambda: clip_columns(self.nonconstant(), self.bounds()))

    # -- accuracy
    def _labels(self) -> tuple[int, int]:
        """(invalid labels, valid rows)."""
        t = self._tail_counts()
        return t["bad"], t["good"]

    def e_acc(self) -> int:
        return self._labels()[0]

    def final(self) -> DataFrame:
        return keep_label_domain(self.clipped(), self.label, self.domain)

    def release(self) -> None:
        """Unpersist the cached stage (call once the results that read it have been
        computed; later reads recompute from the source)."""
        if "grouped" in self._memo:
            self._memo["grouped"].unpersist()

    def score(self) -> DataFrame:
        n0, nc = self.n_original(), len(self.sensors)
        e_rows, e_cells = self.row_stats()
        q_uni = _qi(n0, self.e_uni())
        q_com = _qi(n0 * nc, len(self.dropped_columns()) * n0 + e_rows * len(self.live()) + e_cells)
        q_val = _qi(n0 * nc, self.e_inf() + len(self.constant()) * n0)
        e_con, n_con = self.outliers()
        q_con = _qi(n_con, e_con)
        q_acc = _qi(n0, self.e_acc())
        score = (q_uni + q_com + q_val + q_con + q_acc) / 5.0
        row = (n0, nc, self.e_uni(), q_uni, len(self.dropped_columns()), e_rows, e_cells, q_com,
               self.e_inf(), len(self.constant()), q_val, e_con, n_con, q_con, self.e_acc(), q_acc,
               score, None, self._labels()[1], len(self.valid_cols()))
        spark = self.raw.sparkSession
        return spark.createDataFrame([row], MDQI_SCHEMA).withColumn("grade", grade(F.col("mdqi")))


def mdqi(df: DataFrame, sensors: Sequence[str], label: str, order_by: Sequence, **kw) -> tuple[DataFrame, DataFrame]:
    """Returns (one-row score table, cleaned table)."""
    c = WideCascade(df, sensors, label, order_by, **kw)
    return c.score(), c.final()


def qi_column(n: str, e: str) -> Column:
    """E1 as a column expression."""
    return qi(F.col(n), F.col(e))

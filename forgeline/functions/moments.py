"""Sums of products of many columns in one scan.

Every task adds up blocks of rows by matrix products, about a shift of its own (the
first block's means), and sends one packed row.  Rows are added up in a tree, GROUP to
one, each about its weighted mean, until one is left, which is a fixed number of
numbers: ``width ** 2`` per matrix.  Working about nearby means keeps the sums stable where
values are large against their spread.

``pairwise`` leaves out missing values pair by pair (like a pairwise correlation):
counts, sums, squares and products are held for every pair of columns."""
from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP = 64  # packed rows added up together
BLOCK_ROWS = 4_096


@dataclass
class Moments:
    """Count, means and co-moments (sums of products about the means)."""
    n: float
    mean: np.ndarray
    products: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        if not self.n or not other.n:
            return self if self.n else other
        n, gap = self.n + other.n, other.mean - self.mean
        return Moments(n, self.mean + gap * (other.n / n), self.products + other.products + np.outer(gap, gap) * (self.n * other.n / n))

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        mean = x.mean(0)
        y = x - mean
        return cls(float(len(x)), mean, y.T @ y)

    def pack(self) -> list[bytes]:
        return [np.array([self.n]).tobytes(), self.mean.tobytes(), self.products.tobytes()]

    @classmethod
    def unpack(cls, parts: Sequence[bytes]) -> Moments:
        n, mean, products = (np.frombuffer(p) for p in parts)
        return cls(float(n[0]), mean, products.reshape(len(mean), len(mean)))


@dataclass
class PairMoments:
    """Per pair (i, j), over rows where both are present and about ``shift``: count,
    sum of i, sum of squares of i, sum of products."""
    shift: np.ndarray
    n: np.ndarray
    one: np.ndarray
    two: np.ndarray
    both: np.ndarray

    def about(self, shift: np.ndarray) -> PairMoments:
        """The same sums about another shift."""
        g = (self.shift - shift)[:, None]
        return PairMoments(shift, self.n, self.one + g * self.n, self.two + 2 * g * self.one + g * g * self.n, self.both + g * self.one.T + g.T * self.one + g * g.T * self.n)

    def __add__(self, other: PairMoments) -> PairMoments:
        k, m = np.diag(self.n), np.diag(other.n)
        shift = np.where(k + m > 0, (self.shift * k + other.shift * m) / np.maximum(k + m, 1), 0.0)
        a, b = self.about(shift), other.about(shift)
        return PairMoments(shift, a.n + b.n, a.one + b.one, a.two + b.two, a.both + b.both)

    @classmethod
    def of(cls, x: np.ndarray) -> PairMoments:
        here = ~np.isnan(x)
        m = here.astype(np.float64)
        shift = np.where(here, x, 0).sum(0) / np.maximum(m.sum(0), 1)
        y = np.where(here, x - shift, 0.0)
        return cls(shift, m.T @ m, y.T @ m, (y * y).T @ m, y.T @ y)

    def pack(self) -> list[bytes]:
        return [a.tobytes() for a in (self.shift, self.n, self.one, self.two, self.both)]

    @classmethod
    def unpack(cls, parts: Sequence[bytes]) -> PairMoments:
        shift, *rest = (np.frombuffer(p) for p in parts)
        return cls(shift, *(r.reshape(len(shift), len(shift)) for r in rest))

    def correlation(self) -> np.ndarray:
        """Pearson's correlation of every pair; NaN where it isn't defined."""
        with np.errstate(all="ignore"):
            n = np.where(self.n > 0, self.n, np.nan)
            spread = self.two - self.one * self.one / n
            out = (self.both - self.one * self.one.T / n) / np.sqrt(spread * spread.T)
        out[(spread <= 0) | (spread.T <= 0)] = np.nan
        return out


def _added(df: DataFrame, matrix: Callable[[pa.RecordBatch], np.ndarray], kind: type):
    """The sums of all rows of ``df``, or None without rows."""
    def pack(total) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([total.pack()], pa.list_(pa.binary()))], names=["parts"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK_ROWS):
                own = kind.of(matrix(batch.slice(a, BLOCK_ROWS)))
                total = own if total is None else total + own
        if total is not None:
            yield pack(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for i in range(batch.num_rows):
                own = kind.unpack(batch.column(0)[i].as_py())
                total = own if total is None else total + own
        if total is not None:
            yield pack(total)

    parts, tasks = df.mapInArrow(scan, "parts array<binary>"), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        parts = parts.repartition(tasks).mapInArrow(add, "parts array<binary>")
        if tasks == 1:
            break
        tasks = -(-tasks // GROUP)
    row = parts.first()  # one row of fixed size
    return kind.unpack([bytes(p) for p in row["parts"]]) if row else None


def _columns(cols: Sequence[str]) -> Callable[[pa.RecordBatch], np.ndarray]:
    # NULL becomes NaN
    return lambda b: np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(len(cols))], 1)


def moments(df: DataFrame, cols: Sequence[str]) -> Moments | None:
    """Count, means and co-moments of columns without missing values."""
    return _added(df.select(*[F.col(c).cast("double") for c in cols]), _columns(cols), Moments)


def vector_moments(df: DataFrame, col: str, width: int) -> Moments | None:
    """The same of an array column; every array has ``width`` numbers."""
    return _added(df.select(F.col(col).cast("array<double>").alias("v")), lambda b: b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, width), Moments)


def pair_moments(df: DataFrame, cols: Sequence[str]) -> PairMoments | None:
    """Sums of every pair of columns over the rows where both are present."""
    return _added(df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)]), _columns(cols), PairMoments)

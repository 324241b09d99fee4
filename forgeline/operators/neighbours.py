"""Exact k nearest neighbours over k-d cells.

Index.  Rows with one and the same point are held as that point with its ``k + 1``
smallest keys (a map-side top-k), so a point that a third of all rows share costs as
much as any other.  A bounded sample gives the splits of a k-d tree with at most
MAX_CELLS leaves; every point belongs to one leaf, and each leaf's exact box is known.

Search, in two rounds whatever the data:

1. Inside its own leaf every point finds its ``k + 1`` nearest keys.  The last of
   these distances bounds the true one.
2. A point visits exactly those other leaves whose box lies within that bound, by an
   equi-join on the leaf; leaves with many visitors are dealt in parts.  The lists of
   both rounds are merged.

Inside a leaf, points and visitors are cut into buckets, and only buckets whose boxes
are near enough are compared.  Box distances are worked out like point distances, term by
term, so a bound is never above a distance even after rounding, and ties are kept: the
result equals brute force.  Nothing is capped."""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.joins import join_groups
from ..session import ensure_checkpoint_dir

CELL_POINTS = 4_096  # points of a leaf, until there are MAX_CELLS of them
MAX_CELLS = 16_384  # leaves: their boxes are broadcast
SAMPLE_PER_CELL = 32  # sampled points per leaf that shape the splits
BUCKET = 64


def _cut(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


# -- splits -----------------------------------------------------------------------

def split_tree(points: np.ndarray, cells: int) -> list[tuple[int, float]]:
    """Splits (axis, value) of a full binary tree in level order, at medians of the
    widest axis; a node without spread repeats its only value."""
    levels = max(0, int(np.ceil(np.log2(max(cells, 1)))))
    out: list[tuple[int, float]] = []
    groups = [np.arange(len(points))]
    for _ in range(levels):
        below = []
        for g in groups:
            x = points[g]
            axis = int(np.argmax(x.max(0) - x.min(0))) if len(g) else 0
            value = float(np.median(x[:, axis])) if len(g) else 0.0
            out.append((axis, value))
            left = x[:, axis] < value if len(g) else np.zeros(0, bool)
            below += [g[left], g[~left]]
        groups = below
    return out


def leaf_of(points: np.ndarray, tree: Sequence[tuple[int, float]]) -> np.ndarray:
    """Number of the leaf of every point."""
    at = np.zeros(len(points), np.int64)
    axis, value = np.array([t[0] for t in tree], np.int64), np.array([t[1] for t in tree])
    first, width = 0, 1
    while first < len(tree):
        node = first + at
        at = 2 * at + (points[np.arange(len(points)), axis[node]] >= value[node])
        first, width = first + width, 2 * width
    return at


# -- search inside a leaf -------------------------------------------------------------

def buckets_of(points: np.ndarray, size: int = BUCKET) -> list[np.ndarray]:
    """Row numbers in buckets of at most ``size``, halved along the widest axis."""
    todo, out = [np.arange(len(points))], []
    while todo:
        g = todo.pop()
        if len(g) <= size:
            out += [g] if len(g) else []
            continue
        x = points[g]
        axis = int(np.argmax(x.max(0) - x.min(0)))
        half = len(g) // 2
        order = np.argpartition(x[:, axis], half)
        todo += [g[order[:half]], g[order[half:]]]
    return out


def _box_dist2(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Squared distances between boxes (rows against rows), summed axis by axis."""
    out = None
    for i in range(low.shape[1]):
        gap = np.maximum(np.maximum(lows[None, :, i] - high[:, None, i], low[:, None, i] - highs[None, :, i]), 0.0)
        out = gap * gap if out is None else out + gap * gap
    return out


def _dist2(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = None
    for i in range(a.shape[1]):
        d = a[:, None, i] - b[None, :, i]
        out = d * d if out is None else out + d * d
    return out


def nearest(points: np.ndarray, order: np.ndarray, queries: np.ndarray, k: int, bound: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows (query, point, distance^2), at most k a query, nearest first, ties by
    ``order`` of the points; and how many points each query was compared with.

    ``bound``: distances^2 beyond which nothing is wanted; None: no bound."""
    cells = buckets_of(points)
    low, high = (np.array([f(points[c], 0) for c in cells]) for f in (np.min, np.max))
    sizes = np.array([len(c) for c in cells])
    found, looked = [], np.zeros(len(queries), np.int64)
    for mine in buckets_of(queries):
        x = queries[mine]
        gap = _box_dist2(x.min(0)[None], x.max(0)[None], low, high)[0]
        near = np.argsort(gap, kind="stable")
        if bound is None:
            seed = near[:int(np.searchsorted(np.cumsum(sizes[near]), k)) + 1]
            d = _dist2(x, points[np.concatenate([cells[c] for c in seed])])
            limit = np.partition(d, k - 1, 1)[:, k - 1] if d.shape[1] >= k else np.full(len(x), np.inf)
        else:
            limit = bound[mine]
        use = near[gap[near] <= limit.max()]
        if not len(use):
            continue
        rows = np.concatenate([cells[c] for c in use])
        looked[mine] += len(rows)
        d = _dist2(x, points[rows])
        q, p = np.nonzero(d <= limit[:, None])
        dist = d[q, p]
        rank = np.lexsort((order[rows[p]], dist, q))
        q, p, dist = q[rank], p[rank], dist[rank]
        keep = np.arange(len(q)) - np.searchsorted(q, q) < k
        found.append((mine[q[keep]], rows[p[keep]], dist[keep]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0), looked
    q, p, dist = (np.concatenate(v) for v in zip(*found))
    first = np.argsort(q, kind="stable")
    return q[first], p[first], dist[first], looked


def _lists(q: np.ndarray, values: pa.Array, dist: np.ndarray, n: int) -> pa.Array:
    """One list of (dist2, key) per query; q ascending."""
    ends = np.searchsorted(q, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(dist, pa.float64()), values], names=["dist2", "key"]))


def _order(keys: pa.Array) -> np.ndarray:
    rank = np.empty(len(keys), np.int64)
    rank[pa.compute.sort_indices(keys).to_numpy()] = np.arange(len(keys))
    return rank


# -- the operator -----------------------------------------------------------------------

def point_lists(points: DataFrame, names: Sequence[str], k: int, cells: int | None = None) -> DataFrame:
    """(*names, own, nn, looked) of every distinct point: its own smallest keys, its k
    nearest (dist2, key) with its own among them, and the points compared.

    ``points`` has the columns names, key, and rank (1 .. k) of the key in its point."""
    spark = points.sparkSession
    names, kind = list(names), points.schema["key"].dataType
    arrow_key = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}.get(kind.simpleString())
    if arrow_key is None:
        raise TypeError("the key must be a string, long or int")
    n = points.where("rank = 1").count()
    cells = cells or min(MAX_CELLS, -(-n // CELL_POINTS))
    share = min(1.0, SAMPLE_PER_CELL * cells / max(n, 1))
    drawn = points.where((F.col("rank") == 1) & (F.pmod(F.xxhash64(*names), F.lit(1 << 30)) < int(share * (1 << 30)) + 1))
    sample = drawn.select(*names).limit(4 * SAMPLE_PER_CELL * cells).toPandas().to_numpy(np.float64)  # bounded by MAX_CELLS
    tree = split_tree(sample, cells)
    matrix = lambda t: np.stack([t.column(c).to_numpy() for c in names], 1)

    def place(batches):
        for b in batches:
            if b.num_rows:
                yield b.append_column("leaf", pa.array(leaf_of(matrix(b), tree)))

    fields = [T.StructField(c, T.DoubleType()) for c in names]
    placed = _cut(points.select(*names, "key", "rank").mapInArrow(place, T.StructType([*fields, T.StructField("key", kind), T.StructField("rank", T.IntegerType()), T.StructField("leaf", T.LongType())])))
    boxes = placed.groupBy("leaf").agg(*[F.min(c).alias(f"low{i}") for i, c in enumerate(names)], *[F.max(c).alias(f"high{i}") for i, c in enumerate(names)]).toPandas()  # a row per leaf
    d = len(names)
    shared = spark.sparkContext.broadcast((boxes["leaf"].to_numpy(np.int64), boxes.iloc[:, 1:1 + d].to_numpy(np.float64), boxes.iloc[:, 1 + d:].to_numpy(np.float64)))
    entry = pa.list_(pa.struct([("dist2", pa.float64()), ("key", arrow_key)]))
    entry_type = T.ArrayType(T.StructType([T.StructField("dist2", T.DoubleType()), T.StructField("key", kind)]))

    def own_leaf(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        x, keys = matrix(table), table.column("key").chunk(0)
        first = np.flatnonzero(table.column("rank").to_numpy() == 1)
        asks = x[first]
        q, p, dist, looked = nearest(x, _order(keys), asks, k, None)
        count = np.bincount(q, minlength=len(asks))
        last = np.full(len(asks), np.inf)
        full = count == k
        last[full] = dist[np.cumsum(count)[full] - 1]
        leaves, low, high = shared.value
        here, visits = table.column("leaf")[0].as_py(), []
        for a in range(0, len(asks), BUCKET):
            gap = _box_dist2(asks[a:a + BUCKET], asks[a:a + BUCKET], low, high)
            near = (gap <= last[a:a + BUCKET, None]) & (leaves != here)
            visits += [leaves[row].tolist() for row in near]
        # a point's own keys stand together when sorted by point and rank
        by = np.lexsort((table.column("rank").to_numpy(), *x.T[::-1]))
        start = np.flatnonzero(table.column("rank").to_numpy()[by] == 1)
        own = pa.ListArray.from_arrays(pa.array(np.append(start, len(by)).astype(np.int32)), keys.take(pa.array(by)))
        where = np.empty(len(x), np.int64)
        where[by[start]] = np.arange(len(start))
        return pa.table([*(pa.array(asks[:, i]) for i in range(d)), own.take(pa.array(where[first])), _lists(q, keys.take(pa.array(p)), dist, len(asks)).cast(entry),
                         pa.array(visits, pa.list_(pa.int64())), pa.array(last), pa.array(looked)], names=[*names, "own", "nn", "visits", "bound", "looked"])

    def visited(table: pa.Table, asking: pa.Table) -> pa.Table:
        table, asking = table.combine_chunks(), asking.combine_chunks()
        if not (table.num_rows and asking.num_rows):
            return pa.table([*(pa.array([], pa.float64()) for _ in names), pa.array([], entry), pa.array([], pa.int64())], names=[*names, "nn", "looked"])
        keys, asks = table.column("key").chunk(0), matrix(asking)
        q, p, dist, looked = nearest(matrix(table), _order(keys), asks, k, asking.column("bound").to_numpy())
        return pa.table([*(pa.array(asks[:, i]) for i in range(d)), _lists(q, keys.take(pa.array(p)), dist, len(asks)).cast(entry), pa.array(looked)], names=[*names, "nn", "looked"])

    home = _cut(placed.groupBy("leaf").applyInArrow(own_leaf, T.StructType([*fields, T.StructField("own", T.ArrayType(kind)), T.StructField("nn", entry_type),
                T.StructField("visits", T.ArrayType(T.LongType())), T.StructField("bound", T.DoubleType()), T.StructField("looked", T.LongType())])))
    asks = home.select(*names, "bound", F.explode("visits").alias("leaf"))
    parts = asks.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / F.lit(8 * CELL_POINTS)).cast("long").alias("parts"))  # a row per leaf
    asking = asks.join(F.broadcast(parts), "leaf").withColumn("part", F.pmod(F.xxhash64(*names), F.col("parts")))
    stored = placed.join(F.broadcast(parts), "leaf").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    away = stored.select("leaf", "part", *names, "key").groupBy("leaf", "part").cogroup(asking.select("leaf", "part", *names, "bound").groupBy("leaf", "part")).applyInArrow(
        visited, T.StructType([*fields, T.StructField("nn", entry_type), T.StructField("looked", T.LongType())]))
    both = home.select(*names, "own", "nn", "looked").unionByName(away.withColumn("own", F.lit(None).cast(T.ArrayType(kind))))
    merged = both.groupBy(*names).agg(F.max("own").alias("own"), F.slice(F.array_sort(F.flatten(F.collect_list("nn"))), 1, k).alias("nn"), F.sum("looked").alias("looked"))
    return merged


def knn_exact(df: DataFrame, key: str, features: Sequence[str], k: int = 5, cells: int | None = None) -> DataFrame:
    """(key, nn_key, nn_rank 1..k, dist2) for every row: its k nearest other rows by
    Euclidean distance, ties by nn_key.  ``key`` (string, long or int) must be unique;
    rows with a NULL key or a missing or infinite feature take no part."""
    names = [f"f{i}" for i in range(len(features))]
    usable = F.col("key").isNotNull()
    for c in names:
        usable = usable & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    # adding 0.0 turns -0.0 into 0.0, which is the same point
    rows = df.select(F.col(key).alias("key"), *[(F.col(f).cast("double") + F.lit(0.0)).alias(c) for f, c in zip(features, names, strict=True)]).where(usable)
    mine = Window.partitionBy(*names).orderBy("key")
    points = _cut(rows.withColumn("rank", F.row_number().over(mine)).where(F.col("rank") <= k + 1))
    lists = _cut(point_lists(points, names, k + 1, cells))
    told = lists.select(F.explode("own").alias("key"), "nn")
    more = lists.where(F.size("own") > k)  # points that may have rows beyond their smallest keys
    if not more.isEmpty():
        sizes = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > k + 1)
        point = F.struct(*names)
        groups = more.join(sizes, names).select(point.alias("point"), "own", "nn", "k")
        rest = join_groups(rows.select("key", point.alias("point")), groups, "point", "k").where(F.col("nn").isNotNull() & ~F.array_contains("own", F.col("key")))
        told = told.union(rest.select("key", "nn"))
    others = F.slice(F.filter("nn", lambda x: x["key"] != F.col("key")), 1, k)
    ranked = told.select("key", F.posexplode(others).alias("at", "to"))
    return ranked.select(F.col("key").alias(key), F.col("to.key").alias("nn_key"), (F.col("at") + 1).cast("int").alias("nn_rank"), F.col("to.dist2").alias("dist2"))


__all__ = ["knn_exact", "point_lists"]

"""Connected components of a link table.

Links are dealt into parts of about PART links; each part is contracted by itself
to a star forest, one link per node.  Links that fit one part are done then.  More
parts go on by alternating large and small stars: each round is a minimum per node
(taken before the shuffle as well) and a join back, so a node with very many links
is split by the skew join.  Rounds are materialised in the checkpoint folder; the
loop ends when a round changes no link."""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.llm.common import cut

PART = 500_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Star forest (u, v), v the smallest node of u's component, of one part."""
    up: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (above := up.get(root, root)) != root:
            root = above
        while x != root:
            up[x], x = root, up.get(x, x)
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
            up.setdefault(min(a, b), min(a, b))
    pairs = [(x, r) for x in list(up) if (r := find(x)) != x]
    yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["u", "v"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Directed edges (u, v) with v < u -> edges to the smallest neighbour."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b) links, NULLs and loops ignored -> (node, root) of every linked node
    but the roots themselves; the root is the smallest node."""
    edges = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    parts = -(-edges.count() // PART)
    edges = cut(edges.repartition(max(1, parts)).mapInArrow(_forest, "u long, v long"))
    before = None
    while parts > 1:
        edges = cut(_star(_star(edges, True), False))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))

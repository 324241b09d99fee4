"""Merkle manifest of a table by time-forward processing.

Leaves are row digests; the leaves of one group (a source) in their order are one
tree, and the groups' roots in group order are the leaves of the last tree.  A node
hashes FAN consecutive nodes of the level below it.

A node's label is (tree, level, number).  Messages to labels go through an external
priority queue, which here is Spark's sort: nodes are numbered by a range sort on
(tree, order) and dealt by STRIDE levels of labels, so a task takes the messages of
up to FAN ** STRIDE consecutive labels of one tree, whatever the tree's size.  Inside
a task messages wait in a heap by label: a node's turn comes when all its children
have sent their digests, it hashes them and sends the digest on.  What leaves the
task's labels is dealt again for the next STRIDE levels.  The reversed sweep starts
at the root: every node sends each child its siblings and what the node itself was
sent, until the leaves hold their proofs.  Only the last root, one digest, comes to
the driver.

A proof is an array of (slot, siblings) from the leaf's run up to the last root: the
node's place in its run and the others' digests as one string, left to right.
``fold`` works out the root from a leaf and its proof alone.

Defined cases: a NULL value is written ``-`` and differs from the empty text; NULL
groups are one group, before all others; NULL orders come first; rows of equal order
stand by their digests, so repeated rows are leaves side by side; a lone leaf is its
own root with an empty proof; an empty table gives no rows; extra columns of the
input are ignored and may have any names."""
from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgeline.functions.ordinals import with_ordinal
from forgeline.llm.common import cut

FAN, STRIDE = 16, 3
CHUNK = FAN ** STRIDE
DIGEST = 64  # characters of a digest
BATCH_ROWS = 512  # rows of one Arrow batch of proofs
PROOF = T.ArrayType(T.StructType([T.StructField("slot", T.IntegerType()), T.StructField("siblings", T.StringType())]))
PROOF_ARROW = pa.list_(pa.struct([("slot", pa.int32()), ("siblings", pa.string())]))


# -- digests and proofs as columns ------------------------------------------------

def field(value: Column) -> Column:
    """``-`` for NULL, else UTF-8 byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    def up(digest: Column, step: Column) -> Column:
        left = step["slot"] * DIGEST
        return F.sha2(F.concat(F.substr(step["siblings"], F.lit(1), left), digest, F.substr(step["siblings"], left + 1)), 256)

    return F.aggregate(proof, leaf, up)


def siblings(proof: Column) -> Column:
    """All digests of a proof as one string, leaf to root."""
    return F.array_join(F.transform(proof, lambda step: step["siblings"]), "")


# -- sweeps within a task's labels ---------------------------------------------------

def levels_of(n: int) -> int:
    """Levels above n nodes until one node is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def _hash(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def sweep_up(digests: list[str], levels: int) -> list[list[str]]:
    """Digests by level above the given ones, in label order."""
    tree = [digests, *([] for _ in range(levels))]
    queue = [(1, i // FAN, i % FAN, d) for i, d in enumerate(digests)] if levels else []  # ascending, hence a heap
    while queue:
        level, number, _, first = heapq.heappop(queue)
        run = [first]
        while queue and queue[0][:2] == (level, number):
            run.append(heapq.heappop(queue)[3])
        tree[level].append(_hash(run))
        if level < levels:
            heapq.heappush(queue, (level + 1, number // FAN, number % FAN, tree[level][-1]))
    return tree


def sweep_down(tree: list[list[str]], above: list[tuple[int, str]]) -> list[list[tuple[int, str]]]:
    """The proofs of a tree's lowest nodes; ``above`` is the proof of its top."""
    out: list[list[tuple[int, str]]] = [[] for _ in tree[0]]
    queue = [(1 - len(tree), 0, above)]
    while queue:
        depth, number, proof = heapq.heappop(queue)
        if depth == 0:
            out[number] = proof
            continue
        run = tree[-depth - 1][number * FAN:(number + 1) * FAN]
        for slot in range(len(run)):
            heapq.heappush(queue, (depth + 1, number * FAN + slot, [(slot, "".join(run[:slot] + run[slot + 1:])), *proof]))
    return out


# -- sweeps over the labels of a table ------------------------------------------------

def _in_order(table: pa.Table) -> pa.Table:
    return table.take(pa.array(np.argsort(table.column("number").to_numpy(), kind="stable")))


def climb(nodes: DataFrame) -> list[DataFrame]:
    """Layers of (tree, number, digest, levels), STRIDE levels apart, from (tree,
    number, digest) to one node a tree; ``levels`` are those below the node in
    its part of the layer before."""
    def run(table: pa.Table) -> pa.Table:
        digests = _in_order(table).column("digest").to_pylist()
        tree, own = sweep_up(digests, STRIDE), levels_of(len(digests))
        told = {"tree": table.column("tree")[:1], "number": table.column("chunk")[:1], "lone": [tree[own][0]], "inner": [tree[STRIDE][0]], "own": pa.array([own], pa.int32())}
        return pa.table(told)

    layers = [nodes]
    while True:
        parts = layers[-1].select("tree", "number", "digest", F.expr(f"number div {CHUNK}").alias("chunk"))
        tops = cut(parts.groupBy("tree", "chunk").applyInArrow(run, "tree string, number long, lone string, inner string, own int"))
        last = tops.groupBy("tree").agg(F.max("number").alias("last"))
        alone = F.col("last") == 0  # the tree's only part ends at its root, others at the part's top
        layers.append(cut(tops.join(last, "tree").select("tree", "number", F.when(alone, F.col("lone")).otherwise(F.col("inner")).alias("digest"),
                                                         F.when(alone, F.col("own")).otherwise(STRIDE).alias("levels"))))
        if (tops.agg(F.max("number")).first()[0] or 0) == 0:
            return layers


def descend(nodes: DataFrame, tops: DataFrame, keep: list[str]) -> DataFrame:
    """(tree, number, *keep, subroot, proof) of a layer's nodes from the (tree,
    number, levels, subroot, proof) of the layer above."""
    def run(rows: pa.Table, top: pa.Table) -> pa.Table:
        rows = _in_order(rows)
        tree = sweep_up(rows.column("digest").to_pylist(), top.column("levels")[0].as_py())
        above = [(x["slot"], x["siblings"]) for x in top.column("proof")[0].as_py()]
        proofs = sweep_down(tree, above)
        subroot = top.column("subroot")[0].as_py()
        kept = rows.select(["tree", "number", *keep]).combine_chunks()
        batches = []
        for a in range(0, len(proofs), BATCH_ROWS):
            part = kept.slice(a, BATCH_ROWS)
            told = [*(c.combine_chunks() for c in part.columns), pa.array([subroot] * len(part), pa.string()), pa.array(proofs[a:a + BATCH_ROWS], PROOF_ARROW)]
            batches.append(pa.RecordBatch.from_arrays([c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in told], names=[*kept.column_names, "subroot", "proof"]))
        return pa.Table.from_batches(batches)

    chosen = nodes.select("tree", "number", "digest", *[k for k in keep if k != "digest"], F.expr(f"number div {CHUNK}").alias("chunk"))
    kinds = chosen.select("tree", "number", *keep).schema.fields
    schema = T.StructType([*kinds, T.StructField("subroot", T.StringType()), T.StructField("proof", PROOF)])
    tops = tops.select("tree", F.col("number").alias("chunk"), "levels", "subroot", "proof")
    return chosen.groupBy("tree", "chunk").cogroup(tops.groupBy("tree", "chunk")).applyInArrow(run, schema)


def proofs(layers: list[DataFrame], tops: DataFrame, keep: list[str]) -> DataFrame:
    """``descend`` from a forest's roots (tree, subroot, proof) to its leaves."""
    above = layers[-1].join(tops, "tree").select("tree", "number", "levels", "subroot", "proof")
    for nodes in layers[-2:0:-1]:
        above = cut(descend(nodes, above, ["levels"]))
    return descend(layers[0], above, keep)


# -- the operator ---------------------------------------------------------------------

def manifest(rows: DataFrame, group: Column, order: Column, leaf: Column, keep: dict[str, Column]) -> DataFrame:
    """One row per row: the ``keep`` columns, leaf, subroot, root, proof.

    ``group`` (text) names the row's tree, ``order`` its place there, ``leaf`` is
    its digest (see ``leaf_digest``)."""
    names = [f"kept{i}" for i in range(len(keep))]
    tree = F.coalesce(F.concat(F.lit("+"), group.cast("string")), F.lit(""))  # NULL first, then by bytes
    leaves = rows.select(tree.alias("tree"), order.alias("place"), leaf.alias("digest"), *[c.alias(n) for n, c in zip(names, keep.values(), strict=True)])
    layers = climb(with_ordinal(leaves, ["tree"], ["place", "digest"], "number").drop("place"))
    subroots = layers[-1].select(F.lit("").alias("tree"), "digest", F.col("tree").alias("group"))
    last = climb(with_ordinal(subroots, ["tree"], ["group"], "number"))
    top = last[-1].select("digest").first()
    root = top["digest"] if top else None
    start = last[-1].select("tree", F.lit(None).cast("string").alias("subroot"), F.array().cast(PROOF).alias("proof"))
    groups = cut(proofs(last, start, ["group", "digest"]).select(F.col("group").alias("tree"), F.col("digest").alias("subroot"), "proof"))
    told = proofs(layers, groups, ["digest", *names])
    return told.select(*[F.col(n).alias(k) for n, k in zip(names, keep, strict=True)], F.col("digest").alias("leaf"), "subroot", F.lit(root).cast("string").alias("root"), "proof")

"""Quality selection by importance resampling.

Two generative models over hashed n-gram features, one of target text (the labelled
good documents) and one of raw text (all documents), give every document a log
importance weight: the mean log ratio of its features, shrunk for short texts.
Documents are then drawn without replacement by Gumbel top-k: the k largest of
``scale * weight + Gumbel noise`` with noise from a hash of the id, so a run can be
repeated.  ``scale`` and ``k`` are parameters.  By default k is the number of documents
whose weight reaches a cut fitted on the labelled sample, and the scale is so large
(SCALE) that the noise decides only near the cut: a filter that keeps good documents.
A scale of 1 and a k below the number of documents draw a sample in proportion to the
exponential of the weights.

Features, hashed into BUCKETS: tokens (runs of letters and digits, or of other
signs) with case, their shape, pairs of tokens, and a mark for pairs already seen
in the same text, which stands for repetition.

Bounds: the target model and the cut use at most LABELLED labelled documents, those
with the smallest hashes of their ids (a parameter).  The raw model counts all
documents; tasks add their counts up before they send them, BUCKETS numbers cut
into CHUNKS rows.  The k-th largest key is found by histogram passes over a
checkpointed (id, key) table; at most BINS counts reach the driver.

Defined cases: NULL and empty texts have weight 0; NULL ids share one noise value;
repeated rows have equal keys and stay or go together (so more than k rows stay
when the k-th key is tied); without labels every document stays; an empty table
gives no rows; extra columns are ignored (stage: kept)."""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgeline.llm.common import cut, fresh, text_of
from forgeline.llm.tokens import U, blocks, hash_spans, mix, runs

BUCKETS = 1 << 16
CHUNKS = 64
LABELLED = 20_000
SHRINK = 15.0
SCALE = 40.0
BINS = 4096
REJECTING_GOOD = 5.0  # cost of a good document below the cut, in bad ones above it
SEED = 17

_CLASS = np.full(256, 2, np.uint8)
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASS[[9, 10, 11, 12, 13, 32]] = 0


def features(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every feature of one block."""
    start, end, row = runs(offsets, _CLASS[data])
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    token = hash_spans(data, start, end)
    first, last = data[start], data[end - 1]
    upper = lambda c: (c >= 65) & (c <= 90)
    shape = (_CLASS[first].astype(np.uint64) * U(8) + upper(first).astype(np.uint64) * U(4) + upper(last).astype(np.uint64) * U(2) + ((first >= 48) & (first <= 57)).astype(np.uint64))
    shape = mix(shape + U(0x51A9E))
    same = row[1:] == row[:-1]
    pair = mix(token[:-1] * U(0xD1342543DE82EF95) + token[1:])[same]
    shapes = mix(shape[:-1] * U(0xD1342543DE82EF95) + shape[1:])[same]
    where = row[:-1][same]
    order = np.lexsort((pair, where))
    again = np.zeros(len(pair), bool)
    again[order[1:]] = (pair[order[1:]] == pair[order[:-1]]) & (where[order[1:]] == where[order[:-1]])
    seen = mix(np.where(again, U(0xA6A1), U(0xF125)).astype(np.uint64))
    every = np.concatenate((token, shape, pair, shapes, seen))
    return (every & U(BUCKETS - 1)).astype(np.int64), np.concatenate((row, row, where, where, where))


def feature_counts(texts: DataFrame) -> np.ndarray:
    """Total counts of the buckets over a text column."""
    size = BUCKETS // CHUNKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, offsets, data in blocks(batch.column(0)):
                total += np.bincount(features(offsets, data)[0], minlength=BUCKETS)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(CHUNKS), pa.int32()), pa.array([total[i * size:(i + 1) * size].tobytes() for i in range(CHUNKS)], pa.binary())], names=["chunk", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist())
        return pa.Table.from_pydict({"chunk": table.column("chunk")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros(BUCKETS, np.int64)
    for r in texts.mapInArrow(count, "chunk int, counts binary").groupBy("chunk").applyInArrow(add, "chunk int, counts binary").collect():
        out[r["chunk"] * size:(r["chunk"] + 1) * size] = np.frombuffer(r["counts"], np.int64)
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """doc_id, text and quality of at most ``limit`` labelled documents; of rows that
    repeat an id, the one with the smallest hash of its text."""
    some = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").alias("_l")).agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("_l"), "_l").limit(limit)
    rows = docs.select("doc_id", text_of(docs).alias("text"))
    found = rows.join(F.broadcast(some), rows["doc_id"] == some["_l"])
    one = found.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "quality")).alias("row"))
    return one.select("doc_id", "row.text", "row.quality")


def block_weights(texts: pa.Array, ratio: np.ndarray) -> np.ndarray:
    """The log importance weight of every text of an Arrow column."""
    parts = [np.zeros(0)]
    for _, offsets, data in blocks(texts):
        bucket, row = features(offsets, data)
        rows = len(offsets) - 1
        parts.append(np.bincount(row, ratio[bucket], rows) / (np.bincount(row, minlength=rows) + SHRINK))
    return np.concatenate(parts)


def weights(docs: DataFrame, ratio: np.ndarray, *keep: str) -> DataFrame:
    """Columns ``keep`` and the log importance weight of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(block_weights(batch.column("text"), shared.value))], names=[*keep, "weight"])

    kinds = dict(docs.dtypes)
    return docs.select(*keep, "text").mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "weight double"]))


def fit(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> tuple[np.ndarray, float]:
    """Log ratios of the buckets and the cut, from all documents and the sample."""
    sample = cut(labelled_sample(docs, labels, limit))
    target = feature_counts(sample.where("quality = 1").select("text"))
    raw = feature_counts(docs.select(text_of(docs).alias("text")))
    if not target.any():
        return np.zeros(BUCKETS), -math.inf
    share = lambda c: (c + 0.5) / (c.sum() + 0.5 * BUCKETS)
    ratio = np.log(share(target) / share(raw))
    told = weights(sample, ratio, "quality").toPandas()  # at most ``limit`` rows
    order = np.argsort(told["weight"].to_numpy(), kind="stable")
    w, good = told["weight"].to_numpy()[order], told["quality"].to_numpy()[order] == 1
    below = np.concatenate(([0], np.cumsum(good)))  # good documents lost by a cut before position i
    above = np.concatenate((np.cumsum((~good)[::-1])[::-1], [0]))
    cost = REJECTING_GOOD * below + above
    i = len(cost) - 1 - int(np.argmin(cost[::-1]))
    edge = -math.inf if i == 0 else w[-1] + 1.0 if i == len(w) else (w[i - 1] + w[i]) / 2
    return ratio, float(edge)


def kth_largest(rows: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of a column, by histogram passes."""
    if k <= 0:
        return math.inf
    low, high = rows.agg(F.min(column), F.max(column)).first()
    if low is None:
        return -math.inf
    c, above = F.col(column), 0
    while low < high:
        step = (high - low) / BINS
        if step <= 0 or low + step == low:
            break
        cell = F.least(F.lit(BINS - 1), F.floor((c - F.lit(low)) / F.lit(step)))
        cells = rows.where(c.between(low, high)).groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min(c).alias("a"), F.max(c).alias("b")).collect()  # at most BINS rows
        for r in sorted(cells, key=lambda r: -r["cell"]):
            if above + r["n"] >= k:
                low, high = r["a"], r["b"]
                break
            above += r["n"]
        else:
            return low
    return low


def noise(doc_id) -> Column:
    """Gumbel noise from a hash of the id."""
    u = (F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(SEED)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def _draw(docs: DataFrame, labels: DataFrame, limit: int, scale: float, k: int | None) -> tuple[np.ndarray, DataFrame, float]:
    """Log ratios, the weighed rows and the smallest key that stays."""
    ratio, edge = fit(docs, labels, limit)
    weighed = weights(docs.select("doc_id", text_of(docs).alias("text")), ratio, "doc_id")
    told = cut(weighed.withColumn("gumbel_key", scale * F.col("weight") + noise(F.col("doc_id"))))
    if k is None:
        k = told.where(F.col("weight") >= edge).count()
    return ratio, told, kth_largest(told, "gumbel_key", k)


def select(docs: DataFrame, labels: DataFrame, limit: int = LABELLED, scale: float = SCALE, k: int | None = None) -> DataFrame:
    """One row per document: doc_id, weight, gumbel_key, kept."""
    _, told, least = _draw(docs, labels, limit, scale, k)
    return told.withColumn("kept", F.col("gumbel_key") >= least)


def keep_selected(docs: DataFrame, labels: DataFrame, limit: int = LABELLED, scale: float = SCALE, k: int | None = None) -> DataFrame:
    """The documents that the resampling draws, all columns as they were.  A row's
    key follows from the row, so it is worked out again and no text is shuffled."""
    ratio, _, least = _draw(docs, labels, limit, scale, k)
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    (own,) = fresh(docs, "_noise")
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key = scale * block_weights(batch.column(text), shared.value) + batch.column(batch.num_columns - 1).to_numpy()
                yield batch.filter(pa.array(key >= least)).drop_columns([own])

    return docs.withColumn(own, noise(docs["doc_id"])).mapInArrow(run, docs.schema)

"""Interpolated modified Kneser-Ney bigram model: counted in Spark, stored as
sorted hash arrays, memory-mapped by the workers that score.

Counting.  A task folds its texts into distinct (context, word) pairs with
counts, sorted by context, and sends one block of arrays per shard; the shard of a
pair is the high part of its context's hash.  A reducer merges the blocks of one
shard; contexts are whole there, so their totals and numbers of followers by count
are known.  The followers' continuation counts are merged the same way, by word.
A block holds each pair of a task once, so a pair or a context with a third of all
tokens sends one entry per task.

Model files, one per shard, in the shared folder: sorted hashes of pairs with their
counts; sorted hashes of contexts with total, and followers seen once, twice, more;
sorted hashes of words with the number of distinct contexts before them.  A word's
count is its total as a context (every word is followed by something), so the same
arrays give the unigram base score.  Only counts of counts, ten numbers, reach the
driver.

Scoring.  A worker maps the files (a folder on a shared file system is mapped in
place; from another store a file is fetched to an unlinked temporary file) and
answers the distinct pairs of each block of rows by binary search.  Mapped pages
are the page cache's, so a model larger than a worker's memory still works.

Model: p(w|v) = max(c(v,w) - D(c), 0) / c(v) + g(v) p1(w);
p1(w) = max(n(w) - D1(n), 0) / n + g1 / (V + 1), where n(w) counts the distinct
contexts of w and V the distinct training tokens; unseen words share one place.
Discounts follow the counts of counts; where these give no discount in
[0, count], half the count is used.  Every text begins after a start context and
ends with one end token.

Defined cases: NULL text is empty (one end token); a NULL id counts as training;
repeated rows count and score as often as they stand; without training rows every
token has probability 1 / (V + 1) = 1; an empty table gives no rows; extra columns
are ignored."""
from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.llm.common import cut
from forgeline.llm.tokens import U, blocks, mix, tokens
from forgeline.session import ensure_checkpoint_dir

START, STOP = U(0x5354415254000001), U(0x53544F5000000001)
DOCS_PER_SHARD = 4_000
LEAST_SHARDS = 64
MAPS = 16_384
COUNT_BYTES = 48 << 20  # pairs held by a counting task before they are merged


def sequences(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context, word and row of every token of one block, end tokens included."""
    h, row = tokens(offsets, data)
    rows = len(offsets) - 1
    sizes = np.bincount(row, minlength=rows)
    ends = np.cumsum(sizes + 1) - 1
    word = np.empty(len(h) + rows, np.uint64)
    inside = np.ones(len(word), bool)
    inside[ends] = False
    word[inside] = h
    word[ends] = STOP
    context = np.concatenate(([START], word[:-1])) if len(word) else word.copy()
    context[np.concatenate(([0], ends[:-1] + 1))[:rows]] = START
    return context, word, np.repeat(np.arange(rows), sizes + 1)


def pair_key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(mix(context) + word)


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a hash: its high 32 bits in ``shards`` equal ranges."""
    return ((mix(h) >> U(32)) * U(shards) >> U(32)).astype(np.int64)


def _merge(context: np.ndarray, word: np.ndarray, count: np.ndarray):
    """Distinct pairs, sorted by context, with summed counts."""
    order = np.lexsort((word, context))
    context, word, count = context[order], word[order], count[order]
    first = np.ones(len(context), bool)
    first[1:] = (context[1:] != context[:-1]) | (word[1:] != word[:-1])
    at = np.flatnonzero(first)
    return context[at], word[at], (np.add.reduceat(count, at) if len(at) else count)


BLOCK = pa.schema([("shard", pa.int32()), ("context", pa.binary()), ("followers", pa.binary()), ("word", pa.binary()), ("once", pa.binary()), ("count", pa.binary())])
BLOCK_DDL = "shard int, context binary, followers binary, word binary, once binary, count binary"


def _pack_blocks(context, word, count, shards: int) -> pa.RecordBatch:
    """One row per shard: contexts with their numbers of followers, followers,
    one bit per follower for a count of one, and the other counts."""
    shard = shard_of(context, shards)
    order = np.argsort(shard, kind="stable")
    context, word, count, shard = context[order], word[order], count[order], shard[order]
    edge = np.flatnonzero(np.diff(shard, prepend=-1))
    rows = []
    for a, b in zip(edge, [*edge[1:], len(shard)]):
        c = context[a:b]
        at = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
        once = count[a:b] == 1
        rows.append((int(shard[a]), c[at].tobytes(), np.diff(at, append=b - a).astype("<u4").tobytes(), word[a:b].tobytes(),
                     np.packbits(once).tobytes(), count[a:b][~once].astype("<u4").tobytes()))
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), BLOCK.types)], schema=BLOCK)


def _unpack_blocks(table: pa.Table):
    read = lambda x, t: np.frombuffer(x, t)
    parts = []
    for context, followers, word, once, count in zip(*(table.column(n).to_pylist() for n in BLOCK.names[1:]), strict=True):
        words = read(word, "<u8")
        n = np.ones(len(words), np.int64)
        n[np.unpackbits(read(once, np.uint8), count=len(words)) == 0] = read(count, "<u4")
        parts.append((np.repeat(read(context, "<u8"), read(followers, "<u4")), words, n))
    return tuple(np.concatenate(x) for x in zip(*parts))


def count_pairs(training: DataFrame, shards: int) -> DataFrame:
    """Blocks of distinct pairs per task and shard, from a text column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, offsets, data in blocks(batch.column(0)):
                context, word, _ = sequences(offsets, data)
                held.append(_merge(context, word, np.ones(len(word), np.int64)))
                size += len(held[-1][0]) * 24
                if size > COUNT_BYTES:
                    held = [_merge(*(np.concatenate(x) for x in zip(*held)))]
                    size = len(held[0][0]) * 24
                    if size > COUNT_BYTES // 2:
                        yield _pack_blocks(*held[0], shards)
                        held, size = [], 0
        if held:
            merged = _merge(*(np.concatenate(x) for x in zip(*held)))
            if len(merged[0]):
                yield _pack_blocks(*merged, shards)

    return training.mapInArrow(run, BLOCK_DDL)


# -- model files ------------------------------------------------------------

def _open_store(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def write_arrays(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """One file: a header of lengths, then the arrays, 8-byte aligned.  Written
    aside and renamed, so that a repeated task leaves one whole file."""
    store, path = _open_store(folder)
    store.create_dir(path, recursive=True)
    aside = f"{path}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(aside) as out:
        out.write(np.array([len(a) for a in arrays.values()], "<i8").tobytes())
        for a in arrays.values():
            raw = a.tobytes()
            out.write(raw + bytes(-len(raw) % 8))
    store.move(aside, f"{path}/{name}")


def map_arrays(folder: str, name: str, kinds: dict[str, str]) -> dict[str, np.ndarray] | None:
    """The arrays of a file, memory-mapped; None if there is no such file."""
    store, path = _open_store(folder)
    full = f"{path}/{name}"
    if store.get_file_info(full).type != pafs.FileType.File:
        return None
    if isinstance(store, pafs.LocalFileSystem):
        raw = np.memmap(full, np.uint8, "r")
    else:
        with tempfile.NamedTemporaryFile() as own, store.open_input_stream(full) as source:
            while part := source.read(1 << 22):
                own.write(part)
            own.flush()
            raw = np.memmap(own.name, np.uint8, "r")  # stays mapped when the file is unlinked
    lengths = raw[:8 * len(kinds)].view("<i8")
    at, out = 8 * len(kinds), {}
    for (key, kind), n in zip(kinds.items(), lengths, strict=True):
        size = int(n) * np.dtype(kind).itemsize
        out[key] = raw[at:at + size].view(kind)
        at += size + -size % 8
    return out


PAIRS = {"pair": "<u8", "pair_n": "<u4", "context": "<u8", "total": "<i8", "one": "<u4", "two": "<u4", "more": "<u4"}
WORDS = {"word": "<u8", "before": "<i8"}
STATS = pa.schema([("kind", pa.string()), ("shard", pa.int32()), ("word", pa.binary()), ("before", pa.binary()), ("stats", pa.list_(pa.int64()))])
STATS_DDL = "kind string, shard int, word binary, before binary, stats array<long>"


def _counts_of_counts(n: np.ndarray) -> list[int]:
    return [int((n == i).sum()) for i in (1, 2, 3, 4)]


def build(training: DataFrame, folder: str, shards: int) -> dict:
    """Count the texts and write the model; returns its few global numbers."""
    def reduce_pairs(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        context, word, n = _merge(*_unpack_blocks(table))
        at = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
        total = np.add.reduceat(n, at)
        kinds = [np.add.reduceat((n == 1).astype(np.int64), at), np.add.reduceat((n == 2).astype(np.int64), at), np.add.reduceat((n > 2).astype(np.int64), at)]
        key = pair_key(context, word)
        order = np.argsort(key)
        write_arrays(folder, f"pairs-{shard}", {"pair": key[order], "pair_n": n[order].astype("<u4"), "context": context[at], "total": total, **{k: v.astype("<u4") for k, v in zip(("one", "two", "more"), kinds)}})
        start = context[at] == START
        stop = word == STOP
        words, before = np.unique(word, return_counts=True)
        to = shard_of(words, shards)
        order = np.argsort(to, kind="stable")
        words, before, to = words[order], before[order], to[order]
        edge = np.flatnonzero(np.diff(to, prepend=-1))
        rows = [("words", int(to[a]), words[a:b].tobytes(), before[a:b].astype("<u4").tobytes(), None) for a, b in zip(edge, [*edge[1:], len(to)])]
        stats = [*_counts_of_counts(n), len(n), int(total[~start].sum()), int((~start).sum()), int(n[stop].sum())]
        rows.append(("stats", shard, None, None, stats))
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), STATS.types)], schema=STATS)

    def reduce_words(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        word = np.concatenate([np.frombuffer(x, "<u8") for x in table.column("word").to_pylist()])
        n = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("before").to_pylist()]).astype(np.int64)
        words, place = np.unique(word, return_inverse=True)
        before = np.bincount(place, n).astype(np.int64)
        write_arrays(folder, f"words-{shard}", {"word": words, "before": before})
        stats = [*_counts_of_counts(before), int((before > 2).sum())]
        return pa.Table.from_arrays([pa.array([x], t) for x, t in zip(("words", shard, None, None, stats), STATS.types)], schema=STATS)

    merged = cut(count_pairs(training, shards).groupBy("shard").applyInArrow(reduce_pairs, STATS_DDL))
    total = lambda df, size: [df.agg(*[F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)).alias(f"s{i}") for i in range(size)]).first()[i] for i in range(size)]
    pairs = total(merged.where("kind = 'stats'"), 8)
    words = total(cut(merged.where("kind = 'words'").groupBy("shard").applyInArrow(reduce_words, STATS_DDL)), 5)
    *n, bigrams, tokens_, vocabulary, stops = pairs
    return {"discounts": discounts(n), "word_discounts": discounts(words[:4]), "bigrams": bigrams, "tokens": tokens_ + stops,
            "vocabulary": vocabulary + (stops > 0), "stops": stops, "word_kinds": [words[0], words[1], words[4]], "shards": shards, "folder": folder}


def discounts(n: list[int]) -> list[float]:
    """D1, D2, D3+ of modified Kneser-Ney from the counts of counts."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    out = []
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        d = k - (k + 1) * y * b / a if a and n1 else -1.0
        out.append(d if 0 <= d <= k else k / 2)
    return out


class Model:
    """The mapped arrays of one model, and its probabilities.  A file is mapped when
    it is first asked for; at most MAPS stay mapped, fewer than a process may have."""

    def __init__(self, about: dict):
        self.about = about
        self.file = functools.lru_cache(MAPS)(lambda name, shard: map_arrays(about["folder"], f"{name}-{shard}", PAIRS if name == "pairs" else WORDS))

    def _find(self, name: str, key_name: str, shard: np.ndarray, key: np.ndarray, names: list[str]) -> list[np.ndarray]:
        """Values at the keys, 0 where absent; queries sorted by shard and key."""
        out = [np.zeros(len(key), np.int64) for _ in names]
        order = np.lexsort((key, shard))
        s, k = shard[order], key[order]
        edge = np.flatnonzero(np.diff(s, prepend=-1))
        for a, b in zip(edge, [*edge[1:], len(s)]):
            f = self.file(name, int(s[a]))
            if f is None or not len(f[key_name]):
                continue
            at = np.minimum(np.searchsorted(f[key_name], k[a:b]), len(f[key_name]) - 1)
            hit = f[key_name][at] == k[a:b]
            for o, n in zip(out, names, strict=True):
                o[order[a:b]] = np.where(hit, f[n][at], 0)
        return out

    def counts(self, word: np.ndarray) -> np.ndarray:
        """Training counts of words (the end token's is the number of texts)."""
        (c,) = self._find("pairs", "context", shard_of(word, self.about["shards"]), word, ["total"])
        return np.where(word == STOP, self.about["stops"], c)

    def probabilities(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        a = self.about
        (before,) = self._find("words", "word", shard_of(word, a["shards"]), word, ["before"])
        d = np.array([0.0, *a["word_discounts"]])
        n = max(a["bigrams"], 1)
        rest = sum(x * k for x, k in zip(a["word_discounts"], a["word_kinds"], strict=True)) / n if a["bigrams"] else 1.0
        p1 = (before - d[np.minimum(before, 3)]) / n + rest / (a["vocabulary"] + 1)
        shard = shard_of(context, a["shards"])
        (c,) = self._find("pairs", "pair", shard, pair_key(context, word), ["pair_n"])
        total, one, two, more = self._find("pairs", "context", shard, context, ["total", "one", "two", "more"])
        d = np.array([0.0, *a["discounts"]])
        back = np.where(total > 0, (d[1] * one + d[2] * two + d[3] * more) / np.maximum(total, 1), 1.0)
        return np.where(total > 0, (c - d[np.minimum(c, 3)]) / np.maximum(total, 1), 0.0) + back * p1


@functools.lru_cache(maxsize=1)
def _mapped(folder: str, about: tuple) -> Model:
    return Model(dict(about) | {"folder": folder})


def _frozen(about: dict) -> tuple:
    return tuple((k, tuple(v) if isinstance(v, list) else v) for k, v in about.items() if k != "folder")


SCORE_DDL = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, about: dict) -> DataFrame:
    """Scores of (doc_id, held_out, text) rows under a built model."""
    folder, frozen = about["folder"], _frozen(about)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _mapped(folder, frozen)
        total, size = about["tokens"], about["vocabulary"]
        for batch in batches:
            parts = []
            for _, offsets, data in blocks(batch.column("text")):
                context, word, row = sequences(offsets, data)
                rows = len(offsets) - 1
                words, place = np.unique(word, return_inverse=True)
                c = model.counts(words)
                base = np.log10((c + 0.1) / (total + 0.1 * (size + 1)))
                key = pair_key(context, word)
                _, one, pair = np.unique(key, return_index=True, return_inverse=True)
                logs = np.log10(model.probabilities(context[one], word[one]))
                parts.append((np.bincount(row, minlength=rows), np.bincount(row, (c > 0)[place], rows).astype(np.int64),
                              np.bincount(row, base[place], rows), np.bincount(row, logs[pair], rows)))
            if parts:
                n, known, base, logs = (np.concatenate(x) for x in zip(*parts))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(n.astype(np.int64)), pa.array(known), pa.array(np.full(len(n), total, np.int64)), pa.array(base), pa.array(logs)],
                                                 names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, SCORE_DDL)


def train_and_score(docs: DataFrame) -> DataFrame:
    """Fit on the rows of (doc_id, held_out, text) that aren't held out, score
    all; adds log10 perplexity to the columns of ``score``.  The model's files
    are removed once the scores are written to the checkpoint folder."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/kneser-ney-{uuid.uuid4().hex}"
    shards = max(LEAST_SHARDS, docs.count() // DOCS_PER_SHARD)
    about = build(docs.where(~F.col("held_out")).select("text"), folder, shards)
    scored = cut(score(docs, about))
    drop_model(folder)
    return scored.withColumn("log10_perplexity", -F.col("score") / F.col("n_tokens"))


def drop_model(folder: str) -> None:
    store, path = _open_store(folder)
    if store.get_file_info(path).type == pafs.FileType.Directory:
        store.delete_dir(path)

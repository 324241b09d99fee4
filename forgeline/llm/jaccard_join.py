"""N-gram Jaccard join by prefix trees: near-duplicate components of documents.

Sets: the distinct 5-word shingles of a text (a shorter text is one shingle), as
64-bit hashes.  Documents with equal sets form a class, named by a hash of the set
and its size; a class is worked on once however many copies it has.

Global order: shingles in more documents come first, by a count sketch of fixed
size, then by hash.  Any fixed order gives right results; this one keeps frequent
passages out of the rare ends of the sets.

Steps, each linear in the shingles but for the last, exact one:

1. Candidates.  Sets with Jaccard similarity t share one of the last
   n - ceil(t n) + 1 shingles of the order.  These go to shards by hash, as packed
   arrays; a shingle in very many sets is split by salts.  In every group the most
   central set of each size band (its shingles are the most frequent ones) leads,
   and each set proposes a link to its leader, leaders to the next band's and to
   the other salts'.  No other pairs are formed.
   Groups of two and three propose all their pairs.  A pair is proposed only where
   the shingle's places in both sets allow it to be the rarest one they share.
2. Verification.  Every set has a bitmap of its shingles' parities, about a 64th of
   its size; bits that differ bound what two sets share, exactly, and most proposals
   that don't hold fall out by it before any set is moved.  A leader walks a trie of its proposed members: the sets stand in
   global order, equal beginnings are one path, the overlap along a path is counted
   once, and subtrees are cut when the lengths that remain can't reach the needed
   overlap.
3. The verified links give components.
4. The rest.  A group whose sets are in several components may hide a link between
   two of them.  Components that meet in such a group form a cluster; each cluster
   is cut into chunks, and every set outside the cluster's largest component asks
   every chunk.  The asking sets are cut into parts too, and a (part, chunk) is
   worked on by itself, so that no group is larger than two chunks.  This is done
   twice: first with the bitmaps, which leave the sets that may be linked with one
   of another component, and smaller clusters of these; then with the sets, a
   chunk's as a trie that the asking sets walk.  Thus every pair that could join two
   components is decided exactly; nothing is capped.

Defined cases: NULL and empty texts have an empty set and are linked with nothing;
repeated rows are copies; NULL ids count as larger than every id (alone, such a
component has a NULL id); an empty table gives no rows; extra columns are ignored
(stage: kept)."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.llm.common import cut, fresh, remove_rows, text_of
from forgeline.llm.components import components
from forgeline.llm.tokens import U, blocks, mix, ngrams, tokens

WORDS = 5
NUMERATOR, DENOMINATOR = 75, 100  # linked when DENOMINATOR * |both| >= NUMERATOR * |either|
SKETCH = 1 << 24  # cells, one byte each in the broadcast
SKETCH_CHUNKS = 64
LEVELS = 8  # a cell holds 8 log2(1 + count)
HOT_GROUP = 4_096  # sets of one shingle dealt together
DOCS_PER_SHARD = 4_000
LEAST_SHARDS = 64
SMALL_GROUP = 128  # sets of one shingle compared by place and size before they are kept for the rest
LEADER_GROUP = 2_000  # members of one leader verified together
CHUNK = 1_024  # sets of one trie of the exact rest, and sets that walk it together
MAP_CHUNK = 8_192  # the same for bitmaps, of about a 32nd of a set's bytes
SENT_TOGETHER = 1 << 20  # shingles that a task deals to the shards at once
FILTER_BITS = 1 << 27  # 16 MB


def shingle_sets(offsets: np.ndarray, data: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles and their rows, sorted by row and hash; sizes by row."""
    h, row = tokens(offsets, data)
    rows = len(offsets) - 1
    grams, of = ngrams(h, row, words)
    n = np.bincount(row, minlength=rows)
    short = np.flatnonzero((n > 0) & (n < words))
    if len(short):
        first = np.searchsorted(row, short)
        extra = np.empty(len(short), np.uint64)
        for size in np.unique(n[short]):
            some = n[short] == size
            acc = np.full(int(some.sum()), size, np.uint64)
            for i in range(int(size)):
                acc = mix(acc * U(0xD1342543DE82EF95) + h[first[some] + i])
            extra[some] = acc
        grams, of = np.concatenate((grams, extra)), np.concatenate((of, short))
    order = np.lexsort((grams, of))
    grams, of = grams[order], of[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (of[1:] != of[:-1])
    grams, of = grams[new], of[new]
    return grams, of, np.bincount(of, minlength=rows)


def class_names(grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit name of every set: an order-free hash of its shingles and size."""
    sums = np.concatenate(([U(0)], np.cumsum(mix(grams ^ U(0x5E75)), dtype=np.uint64)))
    end = np.cumsum(sizes)
    return mix((sums[end] - sums[end - sizes]) * U(0x9E3779B97F4A7C15) + sizes.astype(np.uint64)).view(np.int64)


def parities(grams: np.ndarray, of: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Of every set a bitmap of at least as many bits as it has shingles, a power of
    two and at least 64 (none if empty): how often a shingle falls on a bit, odd or even."""
    bits = np.where(sizes > 0, 1 << np.ceil(np.log2(np.maximum(sizes, 64))).astype(np.int64), 0)
    end = np.cumsum(bits)
    at = (end - bits)[of] + (grams & (bits[of] - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(at, minlength=int(bits.sum())) & 1).astype(np.uint8)
    places = np.concatenate(([0], end // 8)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(places), pa.py_buffer(np.packbits(odd, bitorder="little"))])


def fold(maps: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) as they would be with ``size`` words."""
    while maps.shape[1] > size:
        half = maps.shape[1] // 2
        maps = maps[:, :half] ^ maps[:, half:]
    return maps


class Bitmaps:
    """Sets (size, bitmap), by length of the bitmap and by size."""

    def __init__(self, sizes: np.ndarray, maps: list[bytes]):
        lengths, self.kinds = np.array([len(x) for x in maps], np.int64), []
        for length in np.unique(lengths):
            some = np.flatnonzero(lengths == length)
            some = some[np.argsort(sizes[some], kind="stable")]
            self.kinds.append((some, sizes[some], np.frombuffer(b"".join(maps[i] for i in some), "<u8").reshape(len(some), -1)))

    def partners(self, n: int, bits: bytes) -> np.ndarray:
        """Indices of the sets that may be linked with one of n shingles.  Shingles of
        both sets cancel out, so bits that differ are at most the shingles of only one."""
        mine, out = np.frombuffer(bits, "<u8")[None], [np.zeros(0, np.int64)]
        for some, sizes, maps in self.kinds:
            low, high = np.searchsorted(sizes, -(-NUMERATOR * n // DENOMINATOR)), np.searchsorted(sizes, DENOMINATOR * n // NUMERATOR, "right")
            if low < high:
                m, size = sizes[low:high], min(maps.shape[1], mine.shape[1])
                apart = np.bitwise_count(fold(maps[low:high], size) ^ fold(mine, size)).sum(1, dtype=np.int64)
                out.append(some[low:high][np.minimum((n + m - apart) // 2, np.minimum(n, m)) >= needed(n, m)])
        return np.concatenate(out)


def may_link(own: tuple[int, bytes], others: list[tuple[int, bytes]]) -> np.ndarray:
    """Which others (size, bitmap) may be linked with one's own set."""
    out = np.zeros(len(others), bool)
    out[Bitmaps(np.array([m for m, _ in others], np.int64), [x for _, x in others]).partners(*own)] = True
    return out


def needed(n: int, m) -> np.ndarray:
    """Least overlap with which sets of n and m shingles are linked."""
    return -(-NUMERATOR * (n + m) // (NUMERATOR + DENOMINATOR))


def _narrow(x: np.ndarray) -> bytes:
    """Whole numbers in the fewest of 1, 2 and 4 bytes each."""
    top = x.max(initial=0)
    return x.astype("u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4").tobytes()


def _widen(raw: bytes, count: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // max(count, 1) or 1}").astype(np.int64)


def _in_order(grams: np.ndarray, of: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in global order within each row, and their sketch levels."""
    count = sketch[(grams & U(SKETCH - 1)).astype(np.int64)].astype(np.int64)
    order = np.lexsort((grams, -count, of))
    return grams[order], count[order]


# -- pass 1: sets and sketch -------------------------------------------------

def pack_counts(counts: np.ndarray) -> bytes:
    """Counts, most of them none or small: which there are, a byte of each, the large ones."""
    some = counts[counts > 0]
    raw = np.packbits(counts > 0).tobytes() + np.minimum(some, 255).astype(np.uint8).tobytes() + some[some >= 255].astype("<u4").tobytes()
    return len(raw).to_bytes(4, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack_counts(packed: bytes, size: int) -> np.ndarray:
    raw = pa.decompress(packed[4:], int.from_bytes(packed[:4], "little"), "zstd", asbytes=True)
    where = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8, -(-size // 8)), count=size))
    some = np.frombuffer(raw, np.uint8, len(where), -(-size // 8)).astype(np.uint32)
    some[some == 255] = np.frombuffer(raw, "<u4", offset=-(-size // 8) + len(where))
    out = np.zeros(size, np.uint32)
    out[where] = some
    return out


MEASURED = ["doc_id", "content", "n", "name", "bits", "chunk", "counts"]


def measure(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, content, n, name, bits) of every (doc_id, content, text) row, and
    the count sketch."""
    size = SKETCH // SKETCH_CHUNKS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(SKETCH, np.uint32), False
        for batch in batches:
            names, sizes, bits = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [pa.array([], pa.binary())]
            for _, offsets, data in blocks(batch.column("text")):
                grams, of, n = shingle_sets(offsets, data)
                bits.append(parities(grams, of, n))
                cells, times = np.unique(grams & U(SKETCH - 1), return_counts=True)
                total[cells.astype(np.int64)] += times.astype(np.uint32)
                names.append(class_names(grams, n))
                sizes.append(n)
                some = True
            k = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("content"), pa.array(np.concatenate(sizes)), pa.array(np.concatenate(names)), pa.concat_arrays(bits), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names=MEASURED)
        if some:
            packed = [pack_counts(total[i * size:(i + 1) * size]) for i in range(SKETCH_CHUNKS)]
            del total
            k = SKETCH_CHUNKS
            yield pa.RecordBatch.from_arrays([*(pa.nulls(k, pa.int64()) for _ in range(4)), pa.nulls(k, pa.binary()), pa.array(range(k), pa.int32()), pa.array(packed, pa.binary())], names=MEASURED)

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(size, np.uint64)
        for x in table.column("counts").to_pylist():
            total += unpack_counts(x, size)
        total = np.minimum(LEVELS * np.log2(total + 1.0), 255).astype(np.uint8)
        return pa.Table.from_pydict({"chunk": table.column("chunk")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    both = cut(docs.select("doc_id", "content", "text").mapInArrow(run, "doc_id long, content long, n long, name long, bits binary, chunk int, counts binary"))
    sketch = np.zeros(SKETCH, np.uint8)
    parts = both.where("chunk is not null").select("chunk", "counts").groupBy("chunk").applyInArrow(add, "chunk int, counts binary")
    for r in parts.collect():  # SKETCH_CHUNKS rows of fixed size
        sketch[r["chunk"] * size:(r["chunk"] + 1) * size] = np.frombuffer(r["counts"], np.uint8)
    return both.where("chunk is null").select("doc_id", "content", "n", "name", "bits"), sketch


# -- pass 2: candidates ------------------------------------------------------

SENT = ["shard", "key", "split", "whole", "place", "runs", "name", "n", "score"]
FOUND_DDL = "kind int, key long, a long, b long, score float"


def _band(n: np.ndarray) -> np.ndarray:
    """Sets that can be linked are in the same or neighbouring bands."""
    return np.floor(np.log(np.maximum(n, 1)) / np.log(DENOMINATOR / NUMERATOR) + 1e-9).astype(np.int64)


def send(docs: DataFrame, sketch, shards: int) -> DataFrame:
    """The last shingles of every set, dealt to shards as packed arrays; a task sends
    those of many sets together, so that its rows are few whatever the shards."""
    def dealt(held: list[tuple]) -> pa.RecordBatch:
        base = np.cumsum([0, *(len(x[-1]) for x in held[:-1])])
        of = np.concatenate([x[0] + b for x, b in zip(held, base)])
        shard, mixed, key, split, place, names, n, score = (np.concatenate(x) for x in list(zip(*held))[1:])
        order = np.argsort(shard, kind="stable")  # sets stay in order within a shard
        shard, mixed, key, split, place, of = (x[order] for x in (shard, mixed, key, split, place, of))
        edge = np.flatnonzero(np.diff(shard, prepend=-1))
        rows = []
        for a, b in zip(edge, [*edge[1:], len(shard)]):
            first = np.flatnonzero(np.diff(of[a:b], prepend=-1))
            who, hot = of[a:b][first], np.flatnonzero(split[a:b])
            rows.append((int(shard[a]), mixed[a:b].tobytes(), hot.astype("<u4").tobytes(), key[a:b][hot].tobytes(), place[a:b].tobytes(),
                         _narrow(np.diff(first, append=b - a)), names[who].tobytes(), _narrow(n[who]), (256 * score[who]).astype("<u2").tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*rows))], names=SENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, many = [], 0
        counts = sketch.value
        for batch in batches:
            for _, offsets, data in blocks(batch.column(0)):
                grams, of, n = shingle_sets(offsets, data)
                names = class_names(grams, n)
                new = np.zeros(len(n), bool)
                for r in np.flatnonzero(n):
                    if int(names[r]) not in seen:
                        seen.add(int(names[r]))
                        new[r] = True
                some = new[of]
                grams, of = grams[some], of[some]
                if not len(grams):
                    continue
                grams, level = _in_order(grams, of, counts)
                count = np.exp2((level + 1) / LEVELS)  # at least the true one
                end = np.cumsum(np.where(new, n, 0))
                place = end[of] - np.arange(len(grams))  # 1 for the last shingle
                prefix = n - -(-NUMERATOR * n // DENOMINATOR) + 1
                score = np.bincount(of, level, len(n)) / np.maximum(n, 1)
                rare = place <= prefix[of]
                # the place in the prefix as a byte, rounded towards the rare end
                key, of, count, place = grams[rare], of[rare], count[rare], place[rare]
                place = (255 * (place - 1) // np.maximum(prefix[of] - 1, 1)).astype(np.uint8)
                salts = np.maximum(1, np.ceil(count / HOT_GROUP)).astype(np.uint64)
                salt = np.where(salts > 1, mix(names[of].view(np.uint64)) % salts + U(1), U(0))  # 0: not split
                # the high half of the hash gives the shard, the low half is the key in it: shingles
                # that share both form one larger group, which proposes and keeps no less
                mixed = mix(key + salt * U(0x9E3779B97F4A7C15))
                shard = ((mixed >> U(32)) * U(shards) >> U(32)).astype(np.int64)
                held.append((of, shard, mixed.astype("<u4"), key, salt > 0, place, names, n, score))
                many += len(key)
                if many >= SENT_TOGETHER:
                    yield dealt(held)
                    held, many = [], 0
        if held:
            yield dealt(held)

    return docs.select("text").mapInArrow(run, "shard int, " + ", ".join(f"{c} binary" for c in SENT[1:]))


def propose(docs: DataFrame, sketch, shards: int) -> DataFrame:
    """kind 0: proposed links (a, b); 1: (key, a) of groups of four and more;
    2: leaders (key, a, score) of split groups, b their band."""
    def group(table: pa.Table) -> pa.Table:
        parts = []
        high = table.column("shard")[0].as_py() << 32
        for mixed, hot, whole, place, runs, name, n, score in zip(*(table.column(c).to_pylist() for c in SENT[1:]), strict=True):
            name = np.frombuffer(name, "<i8")
            at = np.repeat(np.arange(len(name)), _widen(runs, len(name)))
            mixed = np.frombuffer(mixed, "<u4").astype(np.uint64)
            key, salt = mixed + U(high), np.zeros(len(mixed), np.uint64)  # of a split group: the shingle, and its part
            hot = np.frombuffer(hot, "<u4")
            key[hot], salt[hot] = np.frombuffer(whole, "<u8"), mixed[hot] + U(1)
            n = _widen(n, len(name))[at]
            prefix = n - -(-NUMERATOR * n // DENOMINATOR) + 1
            place = 1 + np.frombuffer(place, np.uint8).astype(np.int64) * (prefix - 1) // 255  # at most the true place
            parts.append((key, salt, name[at], n, (np.frombuffer(score, "<u2") / 256).astype(np.float32)[at], place))
        key, salt, name, n, score, place = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((place, name, salt, key))
        key, salt, name, n, score, place = (x[order] for x in (key, salt, name, n, score, place))
        new = np.ones(len(key), bool)  # a set sent by several tasks, or with two shingles of one key, counts once, at its rarest place
        new[1:] = (key[1:] != key[:-1]) | (salt[1:] != salt[:-1]) | (name[1:] != name[:-1])
        key, salt, name, n, score, place = (x[new] for x in (key, salt, name, n, score, place))
        start = np.ones(len(key), bool)
        start[1:] = (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])
        gid = np.cumsum(start) - 1
        size = np.bincount(gid)
        keep = (size[gid] > 1) | (salt > 0)
        key, salt, name, n, score, gid, place = (x[keep] for x in (key, salt, name, n, score, gid, place))
        if not len(key):
            return pa.Table.from_arrays([pa.array([], t) for t in (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float32())], names=["kind", "key", "a", "b", "score"])

        def possible(x, y) -> np.ndarray:
            """Whether this may be the rarest shingle that two linked sets share."""
            least = needed(n[x], n[y])
            return ((DENOMINATOR * np.minimum(n[x], n[y]) >= NUMERATOR * np.maximum(n[x], n[y]))
                    & (place[x] <= n[x] - least + 1) & (place[y] <= n[y] - least + 1))

        band = _band(n)
        order = np.lexsort((name, -score, band, gid))
        key, salt, name, n, score, gid, band, place = (x[order] for x in (key, salt, name, n, score, gid, band, place))
        few = (size[gid] <= 3) & (salt == 0)
        lead = np.ones(len(key), bool)
        lead[1:] = (gid[1:] != gid[:-1]) | (band[1:] != band[:-1])
        at = np.flatnonzero(lead)
        leader = at[np.cumsum(lead) - 1]
        pairs = [(np.flatnonzero(~lead & ~few), leader[~lead & ~few])]
        near = np.flatnonzero((gid[at][1:] == gid[at][:-1]) & (band[at][1:] == band[at][:-1] + 1) & ~few[at[1:]])
        pairs.append((at[near + 1], at[near]))
        # groups of two and three: every pair, so nothing of them is left to decide
        for step in (1, 2):
            i = np.flatnonzero(few[step:] & (gid[step:] == gid[:-step]))
            x, y = i + step, i
            swap = score[x] > score[y]
            pairs.append((np.where(swap, y, x), np.where(swap, x, y)))
        x, y = (np.concatenate(v) for v in zip(*pairs))
        ok = possible(x, y)
        a, b = name[x[ok]], name[y[ok]]
        _, one = np.unique(mix(a.view(np.uint64)) + b.view(np.uint64), return_index=True)
        a, b = a[one], b[one]
        # larger groups: the sets that may have this as the rarest shingle of some link
        many = ~few
        edge = np.flatnonzero(np.diff(gid, prepend=-1))
        for i, j in zip(edge, [*edge[1:], len(gid)]):
            if many[i] and salt[i] == 0 and j - i <= SMALL_GROUP:
                rows = np.arange(i, j)
                x, y = np.repeat(rows, j - i), np.tile(rows, j - i)
                many[rows[~((possible(x, y) & (x != y)).reshape(j - i, j - i).any(1))]] = False
        told = at[salt[at] > 0]
        kinds = np.repeat([0, 1, 2], [len(a), int(many.sum()), len(told)]).astype(np.int32)
        zero = lambda k: np.zeros(k, np.int64)
        return pa.Table.from_arrays([
            pa.array(kinds), pa.array(np.concatenate((zero(len(a)), key[many].view(np.int64), key[told].view(np.int64)))),
            pa.array(np.concatenate((a, name[many], name[told]))), pa.array(np.concatenate((b, zero(int(many.sum())), band[told]))),
            pa.array(np.concatenate((zero(len(a) + int(many.sum())), score[told])).astype(np.float32))], names=["kind", "key", "a", "b", "score"])

    return send(docs, sketch, shards).repartition(shards, "shard").groupBy("shard").applyInArrow(group, FOUND_DDL)


def leader_links(found: DataFrame) -> DataFrame:
    """Links of the leaders of split groups to their most central one by band,
    and of neighbouring bands."""
    told = found.where("kind = 2").select("key", "a", F.col("b").alias("band"), "score")
    best = told.groupBy("key", "band").agg(F.max_by("a", F.struct("score", "a")).alias("top"), F.count(F.lit(1)).alias("k"))
    same = told.join(best.where("k > 1"), ["key", "band"]).select("a", F.col("top").alias("b"))
    lower = best.select("key", (F.col("band") + 1).alias("band"), F.col("top").alias("b"))
    return same.union(best.join(lower, ["key", "band"]).select(F.col("top").alias("a"), "b")).where("a != b")


# -- pass 3: sets of the classes in question ------------------------------------

def name_filter(names: DataFrame) -> np.ndarray:
    """A bit set of fixed size with the names of a table (column name)."""
    bit = F.col("name").bitwiseAND(F.lit(FILTER_BITS - 1))
    cells = names.groupBy(F.shiftright(bit, 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(cast(1 as bigint), cast(name & 63 as int))")).alias("bits")).toPandas()
    out = np.zeros(FILTER_BITS // 64, np.int64)  # at most as many rows as cells
    out[cells["cell"].to_numpy(np.int64)] = cells["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def fetch_sets(docs: DataFrame, names: DataFrame, sketch) -> DataFrame:
    """(name, n, grams) with the shingles in global order, one row per class."""
    wanted = docs.sparkSession.sparkContext.broadcast(name_filter(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        counts, bits = sketch.value, wanted.value
        for batch in batches:
            for _, offsets, data in blocks(batch.column(0)):
                grams, of, n = shingle_sets(offsets, data)
                name = class_names(grams, n)
                low = name.view(np.uint64) & U(FILTER_BITS - 1)
                hit = (bits[(low >> U(6)).astype(np.int64)] >> (low & U(63)) & U(1)).astype(bool) & (n > 0)
                rows = []
                for r in np.flatnonzero(hit):
                    if int(name[r]) in seen:
                        hit[r] = False
                    else:
                        seen.add(int(name[r]))
                if not hit.any():
                    continue
                some = hit[of]
                grams, _ = _in_order(grams[some], of[some], counts)
                end = np.cumsum(np.where(hit, n, 0))
                for r in np.flatnonzero(hit):
                    rows.append((int(name[r]), int(n[r]), grams[end[r] - n[r]:end[r]].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.binary()))], names=["name", "n", "grams"])

    # what the bit set lets through by chance is in no pair and falls out of the joins
    return docs.select("text").mapInArrow(run, "name long, n int, grams binary").dropDuplicates(["name"])


# -- tries ---------------------------------------------------------------------

class SetTrie:
    """Sets in global order; equal beginnings share one path.  A node holds a run
    of shingles, the depth at its end, the sizes below it, its sets, its children."""

    def __init__(self, sets: list[bytes]):
        self.order = sorted(range(len(sets)), key=sets.__getitem__)
        self.sets = [sets[i] for i in self.order]
        self.sizes = np.array([len(s) // 8 for s in self.sets], np.int64)
        self.nodes: list[tuple] = []  # run, depth, least, most, first, last, children
        self.root = self._build(0, len(self.sets), 0) if self.sets else None

    def _build(self, low: int, high: int, depth: int) -> int:
        """Node of the sets low..high, which agree up to depth."""
        todo, top = [(low, high, depth, None)], None
        while todo:
            low, high, depth, above = todo.pop()
            one, two = self.sets[low], self.sets[high - 1]
            end = min(len(one), len(two)) // 8
            if low + 1 < high:
                a, b = np.frombuffer(one, "<u8", end - depth, depth * 8), np.frombuffer(two, "<u8", end - depth, depth * 8)
                differ = np.flatnonzero(a != b)
                end = depth + int(differ[0]) if len(differ) else end
            sizes = self.sizes[low:high]
            me = len(self.nodes)
            self.nodes.append((np.frombuffer(one, "<u8", end - depth, depth * 8), end, int(sizes.min()), int(sizes.max()), low, high, []))
            if above is None:
                top = me
            else:
                self.nodes[above][6].append(me)
            i = low
            while i < high and len(self.sets[i]) // 8 == end:
                i += 1  # sets that end here
            while i < high:
                mark, j = self.sets[i][end * 8:end * 8 + 8], i + 1
                while j < high and self.sets[j][end * 8:end * 8 + 8] == mark:
                    j += 1
                todo.append((i, j, end, me))
                i = j
        return top

    def partners(self, query: np.ndarray) -> list[int]:
        """Indices of the sets linked with a query (its shingles sorted by hash)."""
        n, out = len(query), []
        if self.root is None or not n:
            return out
        todo = [(self.root, 0)]
        part = NUMERATOR + DENOMINATOR
        while todo:
            node, overlap = todo.pop()
            run, depth, least, most, low, high, children = self.nodes[node]
            if DENOMINATOR * n < NUMERATOR * least or DENOMINATOR * most < NUMERATOR * n:
                continue
            if len(run):
                at = np.searchsorted(query, run)
                at[at == n] = n - 1
                overlap += int((query[at] == run).sum())
            # a set of m below gains at most m - depth: part * (overlap + m - depth) >= NUMERATOR * (n + m)
            if part * (overlap - depth) + DENOMINATOR * most < NUMERATOR * n:
                continue
            for i in range(low, high):
                if self.sizes[i] != depth:
                    break
                if part * overlap >= NUMERATOR * (n + depth):
                    out.append(self.order[i])
            todo += [(c, overlap) for c in children]
        return out


def by_leader(pairs: DataFrame, sets: DataFrame, value: str, decide) -> DataFrame:
    """The proposed links (a, b) that ``decide`` keeps, of ``sets`` (name, n, value).

    A leader b and its members are dealt together, in parts of about LEADER_GROUP
    members, each with the leader's own value; ``decide`` takes the leader's (n,
    value) and its members' and gives the places of those it keeps."""
    sizes = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("k"))
    salted = pairs.join(sizes, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.ceil(F.col("k") / LEADER_GROUP)).alias("salt"))
    wanted = salted.union(salted.select(F.col("b").alias("a"), "b", "salt").distinct())
    told = wanted.join(sets.select(F.col("name").alias("a"), "n", F.col(value).alias("value")), "a").select("b", "salt", "a", "n", "value")

    def part(b: int, rows: list[tuple[int, int, bytes]]) -> list[int]:
        own = next(r[1:] for r in rows if r[0] == b)
        rows = [r for r in rows if r[0] != b]
        return [rows[i][0] for i in decide(own, [r[1:] for r in rows])] if rows else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            left, right = [], []
            for *k, a, n, v in zip(*(batch.column(c).to_pylist() for c in ("b", "salt", "a", "n", "value")), strict=True):
                if k != key:
                    if held:
                        found = part(key[0], held)
                        left += found
                        right += [key[0]] * len(found)
                    key, held = k, []
                held.append((a, n, v))
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])
        if held:
            found = part(key[0], held)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array([key[0]] * len(found), pa.int64())], names=["a", "b"])

    return told.repartition("b", "salt").sortWithinPartitions("b", "salt").mapInArrow(run, "a long, b long")


def bitmaps(measured: DataFrame) -> DataFrame:
    """(name, n, bits), one row per class."""
    return measured.where("n > 0").select("name", "n", "bits").dropDuplicates(["name"])


def near_enough(pairs: DataFrame, measured: DataFrame) -> DataFrame:
    """The proposed links that the bitmaps don't rule out."""
    return by_leader(pairs, bitmaps(measured), "bits", lambda own, others: np.flatnonzero(may_link(own, others)))


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The proposed links that hold: the members form a trie, which the leader walks."""
    return by_leader(pairs, sets, "grams", lambda own, others: SetTrie([g for _, g in others]).partners(np.sort(np.frombuffer(own[1], "<u8"))))


# -- the exact rest ---------------------------------------------------------------

def open_clusters(found: DataFrame, roots: DataFrame) -> DataFrame:
    """(name, root, cluster) of classes in groups that span several components."""
    groups = found.where("kind = 1").select("key", F.col("a").alias("name"))
    rooted = groups.join(roots.withColumnRenamed("node", "name"), "name", "left").select("key", "name", F.coalesce("root", "name").alias("root"))
    spans = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    return clustered(cut(rooted.join(spans.select("key", "low"), "key").select("root", "low", "name").distinct()))


def clustered(meets: DataFrame) -> DataFrame:
    """(name, root, cluster) of (root, low, name): the components root and low meet."""
    clusters = components(meets.select(F.col("root").alias("a"), F.col("low").alias("b")).distinct())
    named = meets.select("name", "root").distinct()
    return named.join(clusters.select(F.col("node").alias("root"), F.col("root").alias("cluster")), "root", "left").select("name", "root", F.coalesce("cluster", "root").alias("cluster"))


def across(members: DataFrame, sets: DataFrame, value: str, chunk: int) -> DataFrame:
    """The (name, root, cluster) members dealt to (cluster, chunk, part) with their
    ``sets`` (name, n, value): all members but for ``asks``, where ``asks`` those
    outside the cluster's largest component, so that any two members of different
    components, one of which asks, come together once or twice."""
    parts = members.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("k"))
    whole = parts.groupBy("cluster").agg(F.max_by("root", F.struct("k", "root")).alias("largest"), F.sum("k").alias("size"), F.max("k").alias("most"))
    told = (members.join(whole, "cluster").join(sets.select("name", "n", F.col(value).alias("value")), "name")
            .withColumn("chunks", F.ceil(F.col("size") / chunk).cast("int")).withColumn("parts", F.ceil((F.col("size") - F.col("most")) / chunk).cast("int")))
    own = lambda n: F.pmod(F.xxhash64("name"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    stored = told.select("cluster", own("chunks").alias("chunk"), every("parts").alias("part"), F.lit(False).alias("asks"), "name", "root", "n", "value")
    asking = told.where("root != largest").select("cluster", every("chunks").alias("chunk"), own("parts").alias("part"), F.lit(True).alias("asks"), "name", "root", "n", "value")
    return stored.union(asking)


def may_join(members: DataFrame, maps: DataFrame) -> DataFrame:
    """(name, root, cluster) of those members that may, by their bitmaps, be linked with
    one of another component of their cluster; clusters of the components so joined."""
    def run(table: pa.Table) -> pa.Table:
        asks = np.array(table.column("asks").to_pylist(), bool)
        name, root, n = (table.column(c).to_numpy() for c in ("name", "root", "n"))
        bits = table.column("value").to_pylist()
        stored = np.flatnonzero(~asks)
        held = Bitmaps(n[stored], [bits[i] for i in stored])
        roots, of = np.unique(root, return_inverse=True)
        up, some = list(range(len(roots))), np.zeros(len(name), bool)

        def find(x: int) -> int:
            while up[x] != x:
                up[x] = x = up[up[x]]
            return x

        for q in np.flatnonzero(asks):
            near = stored[held.partners(int(n[q]), bits[q])]
            near = near[of[near] != of[q]]
            if len(near):
                some[q] = some[near] = True
                for r in np.unique(of[near]):
                    a, b = find(int(of[q])), find(int(r))
                    up[max(a, b)] = min(a, b)  # the roots are sorted
        at = np.flatnonzero(some)
        low = [int(roots[find(int(x))]) for x in of[at]]
        return pa.Table.from_arrays([pa.array(root[at], pa.int64()), pa.array(low, pa.int64()), pa.array(name[at], pa.int64())], names=["root", "low", "name"])

    dealt = across(members, maps, "bits", MAP_CHUNK)
    return clustered(cut(dealt.groupBy("cluster", "chunk", "part").applyInArrow(run, "root long, low long, name long").distinct()))


def decide_clusters(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between different components of a cluster, of (name, root,
    cluster) members: at least one for every pair of components with a link."""
    def run(table: pa.Table) -> pa.Table:
        asks = np.array(table.column("asks").to_pylist(), bool)
        name, root = table.column("name").to_numpy(), table.column("root").to_numpy()
        grams = table.column("value").to_pylist()
        stored = np.flatnonzero(~asks)
        trie = SetTrie([grams[i] for i in stored])
        left, right, seen = [], [], set()
        for q in np.flatnonzero(asks):
            for t in trie.partners(np.sort(np.frombuffer(grams[q], "<u8"))):
                s = stored[t]
                if root[s] != root[q] and (root[q], root[s]) not in seen:
                    seen.add((root[q], root[s]))
                    left.append(int(name[q]))
                    right.append(int(name[s]))
        return pa.Table.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return across(members, sets, "grams", CHUNK).groupBy("cluster", "chunk", "part").applyInArrow(run, "a long, b long")


# -- the operator -------------------------------------------------------------------

def label(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, content (xxhash64 of the text), n, root (a
    number per component, NULL for empty sets), component_id."""
    t = text_of(docs, text)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(t).alias("content"), t.alias("text"))
    context = docs.sparkSession.sparkContext
    measured, counts = measure(rows)
    sketch = context.broadcast(counts)
    shards = max(LEAST_SHARDS, measured.count() // DOCS_PER_SHARD)
    found = cut(propose(rows, sketch, shards))
    pairs = found.where("kind = 0").select("a", "b").union(leader_links(found)).distinct()
    pairs = cut(near_enough(cut(pairs), measured))
    asked = pairs.select(F.col("a").alias("name")).union(pairs.select("b")).distinct()
    links = cut(verify(pairs, fetch_sets(rows, asked, sketch)))
    roots = components(links)
    members = cut(open_clusters(found, roots))
    if not members.isEmpty():
        members = cut(may_join(members, bitmaps(measured)))
    if not members.isEmpty():
        more = cut(decide_clusters(members, fetch_sets(rows, members.select("name"), sketch)))
        if not more.isEmpty():
            roots = components(links.union(more))
    named = measured.withColumnRenamed("name", "node")
    classes = named.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    classes = classes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "least")
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    final = cut(classes.join(least, "root").select("node", "root", "component_id"))
    joined = named.where("n > 0").join(final, "node").select("doc_id", "content", "n", "root", "component_id")
    return joined.union(measured.where("n = 0").select("doc_id", "content", "n", F.lit(None).cast("long"), "doc_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    return label(docs, id_col, text).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one row of every component, the one with the smallest id
    (of equal ids, with the smallest content hash), and all with empty sets; all
    columns as they were."""
    rows = cut(label(docs, id_col, text))
    linked = rows.where("root is not null")
    mine = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("content"))
    won = linked.groupBy("root").agg(F.min(mine).alias("won"))
    lost = linked.join(won, "root").where(~(F.col("won.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("won.content") == F.col("content"))))
    kept = remove_rows(docs, cut(lost.select("doc_id", "content").distinct()), id_col, text)
    # a winner may be a row that stands several times; those rows alone are dealt by their key
    again = cut(linked.groupBy("root", "doc_id", "content").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
                .join(won, "root").where(F.col("won.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("won.content") == F.col("content"))).select("doc_id", "content"))
    if again.isEmpty():
        return kept
    once = remove_rows(kept, again, id_col, text)
    i, c = fresh(docs, "_again_id", "_again_content")
    other = again.select(F.col("doc_id").alias(i), F.col("content").alias(c))
    content = F.xxhash64(text_of(kept, text))
    repeated = kept.join(other, (content == other[c]) & kept[id_col].eqNullSafe(other[i]), "left_semi")
    return once.unionByName(repeated.withColumn(c, F.xxhash64(text_of(repeated, text))).dropDuplicates([id_col, c]).drop(c))

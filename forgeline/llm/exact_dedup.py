"""Exact deduplication through a cuckoo-filter index of live digests.

The index maps the SHA-256 digest of a text without white space to the row that
stays and the number of live copies.  Its filter holds 16-bit fingerprints in
buckets of four slots; every slot has its full key beside it, so a filter hit is
always verified against the content of the two candidate buckets and a
fingerprint collision can never merge two texts.  When an insertion finds no
free slot the table is doubled and refilled from the stored keys.

Distribution: each input partition first folds its own copies into one entry per
digest (so a text with a third of all rows sends one row per task), the entries
are dealt by digest, and the same index merges them.  A task holds the distinct
digests of its partition only.

Defined cases: NULL text is the empty text; NULL doc_id sorts after every other
id; repeated rows count as copies and exactly one of them is kept; an empty
table gives an empty result; extra columns are ignored."""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.llm.common import cut, fresh, text_of

SPACES = " \t\n\x0b\x0c\r"
SLOTS = 4
MAX_KICKS = 200


class CuckooIndex:
    """Cuckoo filter with its keys: insert, look up and delete live digests."""

    def __init__(self, buckets: int = 256):
        self.size = 0
        self._allocate(buckets)

    def _allocate(self, buckets: int) -> None:
        self.buckets = buckets  # a power of two
        self.filter = [[0] * SLOTS for _ in range(buckets)]
        self.content: list[list] = [[None] * SLOTS for _ in range(buckets)]

    def _places(self, key: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(key[:2], "big") or 1
        one = int.from_bytes(key[2:10], "big") & (self.buckets - 1)
        return mark, one, self._other(one, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x5BD1E995 & (self.buckets - 1))

    def _slot(self, key: bytes):
        mark, one, two = self._places(key)
        for b in (one, two):
            marks = self.filter[b]
            if mark in marks:
                for s in range(SLOTS):
                    if marks[s] == mark and self.content[b][s][0] == key:
                        return b, s
        return None

    def get(self, key: bytes):
        """The entry of a live digest, or None."""
        at = self._slot(key)
        return self.content[at[0]][at[1]][1] if at else None

    def put(self, key: bytes, entry) -> None:
        """Insert a digest or replace its entry."""
        at = self._slot(key)
        if at:
            self.content[at[0]][at[1]] = (key, entry)
            return
        held = (key, entry)
        self.size += 1
        while held is not None:
            held = self._place(held)
            if held is not None:
                self._grow()

    def _place(self, held):
        """Put one pair, moving others; returns the pair left over, if any."""
        mark, one, two = self._places(held[0])
        for b in (one, two):
            if self._fill(b, mark, held):
                return None
        b = one
        for kick in range(MAX_KICKS):
            s = kick % SLOTS
            mark, self.filter[b][s] = self.filter[b][s], mark
            held, self.content[b][s] = self.content[b][s], held
            b = self._other(b, mark)
            if self._fill(b, mark, held):
                return None
        return held

    def _fill(self, b: int, mark: int, held) -> bool:
        marks = self.filter[b]
        if 0 in marks:
            s = marks.index(0)
            marks[s] = mark
            self.content[b][s] = held
            return True
        return False

    def _grow(self) -> None:
        pairs = list(self.pairs())
        more = self.buckets * 2
        while pairs:
            self._allocate(more)
            if all(self._place(p) is None for p in pairs):
                return
            more *= 2
        self._allocate(more)

    def delete(self, key: bytes) -> bool:
        """Remove a live digest; false if it isn't there."""
        at = self._slot(key)
        if not at:
            return False
        self.filter[at[0]][at[1]] = 0
        self.content[at[0]][at[1]] = None
        self.size -= 1
        return True

    def pairs(self) -> Iterator[tuple[bytes, object]]:
        for row in self.content:
            for pair in row:
                if pair is not None:
                    yield pair


ENTRY = "digest binary, keep_chars long, keep_id long, copies long"
OUT = pa.schema([("digest", pa.binary()), ("keep_chars", pa.int64()), ("keep_id", pa.int64()), ("copies", pa.int64())])
EMIT = 50_000


def _better(a: tuple, b: tuple) -> bool:
    """Whether (chars, id) ``a`` goes before ``b``: longer, then smaller id."""
    if a[0] != b[0]:
        return a[0] > b[0]
    return b[1] is None and a[1] is not None or a[1] is not None and a[1] < b[1]


def fold_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One entry per digest of a partition, through the index."""
    index = CuckooIndex()
    for batch in batches:
        for key, chars, doc, copies in zip(*(batch.column(n).to_pylist() for n in OUT.names), strict=True):
            old = index.get(key)
            if old is None:
                index.put(key, (chars, doc, copies))
            else:
                best = (chars, doc) if _better((chars, doc), old) else old[:2]
                index.put(key, (*best, old[2] + copies))
    rows = []
    for key, entry in index.pairs():
        rows.append((key, *entry))
        if len(rows) == EMIT:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), OUT.types)], schema=OUT)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), OUT.types)], schema=OUT)


def digests(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_code_points and digest of the text without white space."""
    t = text_of(docs, text)
    plain = F.translate(t, SPACES, "")
    return docs.select(docs[id_col].alias("doc_id"), F.char_length(t).cast("long").alias("chars"),
                       F.unhex(F.sha2(plain, 256)).alias("digest"))


def live_groups(rows: DataFrame) -> DataFrame:
    """(doc_id, chars, digest) rows -> one entry per digest."""
    entries = rows.select("digest", F.col("chars").alias("keep_chars"), F.col("doc_id").alias("keep_id"),
                          F.lit(1).cast("long").alias("copies"))
    local = entries.mapInArrow(fold_copies, ENTRY)
    return local.repartition(F.col("digest")).mapInArrow(fold_copies, ENTRY)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    ``kept`` is true for one row of each group: the most code points in the
    original text, then the smallest doc_id."""
    rows = cut(digests(docs, id_col, text))
    groups = live_groups(rows)
    distinct = rows.groupBy("digest", "chars", "doc_id").agg(F.count(F.lit(1)).alias("times"))
    joined = distinct.join(groups, "digest")
    first = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
    return (joined.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("nth"))
            .select("doc_id", "keep_id", F.col("copies").alias("group_size"),
                    (first & (F.col("nth") == 1)).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one row of each group, all columns as they were.

    Rows are told apart by (id, length, digest); of rows that agree in all
    three, which are the same document repeated, one is kept."""
    winners = live_groups(cut(digests(docs, id_col, text)))
    t = text_of(docs, text)
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    key = fresh(docs, "_digest", "_chars", "_name")
    own = (F.unhex(F.sha2(F.translate(t, SPACES, ""), 256)), F.char_length(t).cast("long"), name(docs[id_col]))
    keyed = docs.withColumns(dict(zip(key, own, strict=True)))
    won = winners.select(F.col("digest").alias(key[0]), F.col("keep_chars").alias(key[1]), name(F.col("keep_id")).alias(key[2]))
    # the join and the aggregation share one partitioning and sort order
    return keyed.join(won, key, "left_semi").dropDuplicates(key).drop(*key)


def apply_changes(live: DataFrame, changes: DataFrame) -> DataFrame:
    """Maintain an index table: ``live`` (digest, copies) and ``changes``
    (seq, digest, op of 'insert' or 'delete') give the live digests afterwards.
    A deletion takes one copy; the last one removes the digest, and deleting an
    absent digest does nothing.  Changes of one digest apply in order of seq."""
    net = changes.groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("seq", F.when(F.col("op") == "delete", -1).otherwise(1).alias("step")))).alias("steps"))
    both = live.groupBy("digest").agg(F.sum("copies").alias("copies")).join(net, "digest", "full_outer")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CuckooIndex()
        for batch in batches:
            for key, copies, steps in zip(*(batch.column(n).to_pylist() for n in ("digest", "copies", "steps")), strict=True):
                if copies:
                    index.put(key, copies)
                for s in steps or []:
                    n = (index.get(key) or 0) + s["step"]
                    if n > 0:
                        index.put(key, n)
                    else:
                        index.delete(key)
        rows = list(index.pairs())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64())], names=["digest", "copies"])

    return both.mapInArrow(fold, "digest binary, copies long")

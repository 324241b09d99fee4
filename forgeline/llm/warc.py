"""WARC archives: writing pages, and reading records by verified chains.

Writing.  A record is one text value, header and content; Spark's text writer ends
each value with the two line ends that end a WARC record, so plain part files are
archives.  Of pages with equal payloads of LEAST_REVISIT bytes or more one is
written as response, the others as revisit records that name it.

Reading.  Spark's text reader cuts files at the magic, wherever it stands, also in a
payload, and deals the splits of large files to tasks.  A piece that looks like a
header is a candidate record, and its content length gives the offset of the next
record.  The true records are those that a chain of such steps reaches from the
start of the file:

1. Every split's task emits its candidates and their successors, contracted: pointer
   jumping inside the split gives each candidate the place where its chain leaves it.
2. Prefix sums of the splits' lengths turn places into file offsets.  Of all
   candidates only those where some chain enters a split are kept, and pointer
   jumping by joins (each round doubles the steps) marks those that are reachable
   from the file's start.
3. With its entry point known, each split is read again and only the records on the
   chain are put out.  A magic inside a payload starts no record: its bytes are put
   back where they belong, over split borders too.

A record counts when its successor is a candidate or the end of the file; where a
file breaks off or is damaged the records before that stay, and ``chains`` tells how
far each file is verified.

Defined cases: NULL texts are empty; a NULL id is written ``-`` and stands after all
ids; rows that repeat the smallest id of equal payloads are all responses; control
characters in urls are percent-encoded, a NULL url is left out; an empty table gives
no records; extra columns are ignored and may have any names."""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgeline.llm.common import cut, join_groups, text_of

MAGIC, END, BLANK = "WARC/1.", "\r\n\r\n", "\r\n\r\n"
LEAST_REVISIT = 100
DATE = "1970-01-01T00:00:00Z"  # pages carry no date of their own
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BROADCAST_SPLITS = 100_000
LENGTH = re.compile(rb"\r\nContent-Length:[ \t]*([0-9]{1,18})[ \t]*(?=\r\n|\Z)", re.IGNORECASE)
VERSION = re.compile(rb"[0-9]\r\n")


# -- writing --------------------------------------------------------------------

def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines; fields whose value is NULL are left out."""
    return F.concat_ws("", *[F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")) for name, value in fields])


def record_id(page: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("-")), F.lit(":"), digest, F.lit(">"))


def plan_records(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, payload, digest, first: the page whose record a revisit names
    (struct with page_id), NULL for responses."""
    payload = text_of(pages, html)
    rows = pages.select(pages[id_col].alias("page_id"), pages[url].cast("string").alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    rows = rows.withColumn("large", F.when(F.octet_length("payload") >= LEAST_REVISIT, F.col("digest")))
    groups = rows.where("large is not null").groupBy("large").agg(F.min("page_id").alias("least"), F.count(F.lit(1)).alias("k")).where("k > 1")
    found = join_groups(rows, groups, "large", "k")
    later = F.col("least").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("least")))
    return found.select("page_id", "url", "payload", "digest", F.when(later, F.struct(F.col("least").alias("page_id"))).alias("first"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Pages as uncompressed WARC files in ``folder``, one record per row."""
    rows = plan_records(pages, id_col, url, html)
    target = F.col("url")
    for code in (*range(0x21), 0x7F):
        target = F.replace(target, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    target = F.when(F.col("url").rlike(r"[\x00-\x20\x7F]"), target).otherwise(F.col("url"))
    answer = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit(BLANK), F.col("payload"))
    again = F.col("first").isNotNull()
    content = F.when(again, F.lit("")).otherwise(answer)
    header = _lines(
        ("WARC-Type", F.when(again, "revisit").otherwise("response")),
        ("WARC-Record-ID", record_id(F.col("page_id"), F.col("digest"))),
        ("WARC-Target-URI", target),
        ("WARC-Date", F.lit(DATE)),
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        ("WARC-Refers-To", F.when(again, record_id(F.col("first.page_id"), F.col("digest")))),
        ("WARC-Profile", F.when(again, F.lit(PROFILE))),
        ("Content-Type", F.lit("application/http;msgtype=response")),
        ("Content-Length", F.octet_length(content).cast("string")))
    record = F.concat(F.lit(f"{MAGIC}1\r\n"), header, F.lit("\r\n"), content)
    rows.select(record.alias("value")).write.option("lineSep", END).text(folder)


# -- reading: pieces and chains ----------------------------------------------------

def pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, split, size, value: the text between magics, in the order of a split."""
    lines = spark.read.text(path, lineSep=MAGIC)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("_metadata.file_size").alias("size"), "value")


def _span(value: Column) -> Column:
    """Bytes from a candidate's magic to the record after it, NULL if the piece
    is no header."""
    head = F.substring_index(value, BLANK, 1)
    length = F.regexp_extract(head, r"(?i)\r\nContent-Length:[ \t]*([0-9]{1,18})[ \t]*(?=\r\n|\z)", 1)
    is_head = (F.instr(value, BLANK) > 0) & head.rlike(r"\A[0-9]\r\n") & (length != "")
    return F.when(is_head, F.octet_length(head) + len(MAGIC) + len(BLANK) + len(END) + length.cast("long"))


def contract(length: np.ndarray, span: np.ndarray, headless: bool) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Of one split's pieces: total bytes; candidates' places, the places where
    their chains leave the split (-1: broken before), and the last records on them.

    ``span`` is 0 for what is no candidate; ``headless``: the first piece has no
    magic before it (the file begins there)."""
    size = length + len(MAGIC)
    if headless and len(size):
        size[0] -= len(MAGIC)
        span = np.concatenate(([0], span[1:]))
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    some = span > 0
    at = (ends - size)[some]
    to = at + span[some]
    jump = np.arange(len(at))
    inside = to < total
    place = np.minimum(np.searchsorted(at, to), max(len(at) - 1, 0))
    holds = inside & (at[place] == to) if len(at) else inside
    jump[holds] = place[holds]
    leave = np.where(inside, -1, to)
    while len(at) and (jump[jump] != jump).any():
        jump = jump[jump]
    return total, at, leave[jump], at[jump]


SPLIT = pa.schema([("file", pa.string()), ("split", pa.int64()), ("size", pa.int64()), ("total", pa.int64()), ("at", pa.binary()), ("leave", pa.binary()), ("last", pa.binary())])


def split_chains(found: DataFrame) -> DataFrame:
    """One row per split: its length and contracted candidates, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, length, span = None, [], []

        def told() -> pa.RecordBatch:
            total, *arrays = contract(np.concatenate(length), np.concatenate(span), key[1] == 0)
            row = [*key, total, *(a.astype("<i8").tobytes() for a in arrays)]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, SPLIT.types, strict=True)], schema=SPLIT)

        for batch in batches:
            split, n, s = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("split", "n", "span"))
            names = batch.column("file").dictionary_encode()
            code = names.indices.to_numpy()
            edge = np.flatnonzero(np.diff(code, prepend=-1) | np.diff(split, prepend=-1))
            for a, b in zip(edge, [*edge[1:], batch.num_rows]):
                own = (names.dictionary[code[a]].as_py(), int(split[a]), batch.column("size")[int(a)].as_py())
                if own != key and key is not None:
                    yield told()
                    length, span = [], []
                key = own
                length.append(n[a:b].astype(np.int64))
                span.append(s[a:b].astype(np.int64))
        if key is not None:
            yield told()

    sizes = found.select("file", "split", "size", F.octet_length("value").cast("long").alias("n"), F.coalesce(_span(F.col("value")), F.lit(0)).cast("long").alias("span"))
    return sizes.mapInArrow(run, "file string, split long, size long, total long, at binary, leave binary, last binary")


def _nodes(splits: DataFrame) -> DataFrame:
    """(file, split, size, at, leave, last) of all candidates, in file offsets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, split, size, base, *packed in zip(*(batch.column(c).to_pylist() for c in ("file", "split", "size", "base", "at", "leave", "last")), strict=True):
                at, leave, last = (np.frombuffer(x, "<i8") for x in packed)
                k = len(at)
                yield pa.RecordBatch.from_arrays([pa.array([file] * k, pa.string()), pa.array(np.full(k, split)), pa.array(np.full(k, size)), pa.array(at + base), pa.array(np.where(leave < 0, -1, leave + base)), pa.array(last + base)],
                                                 names=["file", "split", "size", "at", "leave", "last"])

    return splits.mapInArrow(run, "file string, split long, size long, at long, leave long, last long")


def reachable(nodes: DataFrame) -> DataFrame:
    """The nodes (file, at, leave, ..) that chains reach from offset 0, by pointer
    jumping: after k rounds a jump is 2^k steps."""
    jump = nodes.select("file", "at", F.col("leave").alias("to"))
    reach, known = nodes.where("at = 0").select("file", "at"), -1
    while True:
        more = reach.join(jump, ["file", "at"]).select("file", F.col("to").alias("at")).join(nodes, ["file", "at"], "left_semi")
        reach = cut(reach.union(more).distinct())
        count = reach.count()
        if count == known:
            return nodes.join(reach, ["file", "at"], "left_semi")
        known = count
        then = jump.select("file", F.col("at").alias("to"), F.col("to").alias("then"))
        jump = cut(jump.join(then, ["file", "to"], "left").select("file", "at", F.coalesce("then", "to").alias("to")))


def chains(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries (file, split, base, entry, verified) of the splits, and files
    (file, size, verified): the offset up to which the chain of records holds."""
    splits = cut(split_chains(found))
    by_file = Window.partitionBy("file").orderBy("split")  # one row per split
    based = splits.withColumn("base", F.coalesce(F.sum("total").over(by_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    nodes = _nodes(based)
    enters = nodes.where("leave >= 0").select("file", F.col("leave").alias("at")).union(nodes.where("at = 0").select("file", "at")).distinct()
    true = cut(reachable(cut(nodes.join(enters, ["file", "at"], "left_semi"))))
    ends = true.join(true.select("file", F.col("at").alias("leave")), ["file", "leave"], "left_anti")
    ends = ends.groupBy("file").agg(F.max(F.when(F.col("leave") == F.col("size"), F.col("size")).otherwise(F.col("last"))).alias("verified"))
    files = splits.select("file", "size").distinct().join(ends, "file", "left").select("file", "size", F.coalesce("verified", F.lit(0)).alias("verified"))
    first = true.groupBy("file", "split").agg(F.min("at").alias("first"))
    later = by_file.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    entries = based.select("file", "split", "base").join(first, ["file", "split"], "left").join(files.select("file", "verified"), "file")
    entries = entries.select("file", "split", "base", F.coalesce(F.first("first", ignorenulls=True).over(later), F.col("verified")).alias("entry"), "verified")
    return cut(entries), files


# -- reading: records ----------------------------------------------------------------

RAW = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("end", pa.int64()), ("whole", pa.bool_()), ("content", pa.binary())])


class Walk:
    """Records of one split, piece by piece, from its entry point on."""

    def __init__(self, file: str, split: int, base: int, entry: int, verified: int):
        self.file, self.at, self.entry, self.verified = file, base, entry, verified
        self.headless = split == 0
        self.tail: list[bytes] = []
        self.tail_at = base
        self.record: list[bytes] = []
        self.offset = self.need = self.have = 0

    def take(self, value: bytes) -> tuple | None:
        """One more piece; the record that it completes, if any."""
        if self.headless:  # what stands before the first magic
            self.headless = False
            self.at += len(value)
            return None
        start, raw = self.at, MAGIC.encode() + value
        self.at += len(raw)
        if start >= self.verified:
            return None
        if start < self.entry:
            self.tail.append(raw)
            return None
        if not self.record:
            head = value[:value.index(b"\r\n\r\n")]
            self.offset, self.have = start, 0
            self.need = len(MAGIC) + len(head) + len(BLANK) + len(END) + int(LENGTH.search(head)[1])
        self.record.append(raw)
        self.have += len(raw)
        if self.have < self.need:
            return None
        done = (self.file, self.offset, self.offset + self.need, True, b"".join(self.record))
        self.record = []
        return done

    def rest(self) -> list[tuple]:
        """Parts of records that cross the split's borders."""
        out = [(self.file, self.tail_at, self.entry, False, b"".join(self.tail))] if self.tail else []
        if self.record:
            out.append((self.file, self.offset, self.offset + self.need, False, b"".join(self.record)))
        return out


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), RAW.types)], schema=RAW)
    key, walk = None, None
    for batch in batches:
        rows = []
        for file, split, base, entry, verified, value in zip(*(batch.column(c).to_pylist() for c in ("file", "split", "base", "entry", "verified", "value")), strict=True):
            if (file, split) != key:
                rows += walk.rest() if walk else []
                key, walk = (file, split), Walk(file, split, base, entry, verified)
            if (done := walk.take(value)) is not None:
                rows.append(done)
        if rows:
            yield pack(rows)
    if walk and (rows := walk.rest()):
        yield pack(rows)


def raw_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, content) of the records on the chains, with their headers."""
    found = pieces(spark, path)
    entries, _ = chains(found)
    values = found.select("file", "split", F.col("value").cast("binary").alias("value"))
    if entries.count() <= BROADCAST_SPLITS:
        dealt = values.join(F.broadcast(entries), ["file", "split"])
    else:
        dealt = values.withColumn("place", F.monotonically_increasing_id()).join(entries, ["file", "split"]).repartition("file", "split").sortWithinPartitions("file", "split", "place")
    walked = dealt.select("file", "split", "base", "entry", "verified", "value").mapInArrow(_walk, "file string, offset long, end long, whole boolean, content binary")
    records = walked.where("whole").select("file", "offset", "content")
    if entries.where("entry > base and base < verified").isEmpty():
        return records  # no record crosses a border of splits in several pieces
    parts = walked.where("not whole").groupBy("file", "end").agg(F.sort_array(F.collect_list(F.struct("offset", "content"))).alias("parts"))  # parts of one record
    joined = F.aggregate(F.slice("parts", 2, F.size("parts")), F.col("parts")[0]["content"], lambda done, part: F.concat(done, part["content"]))
    return records.union(parts.select("file", F.col("parts")[0]["offset"].alias("offset"), joined.alias("content")))


def parse(raw: DataFrame) -> DataFrame:
    """file, offset, warc_type, record_id, target_uri, refers_to, payload_digest,
    payload of raw records; the payload of an HTTP answer is its body."""
    whole = F.col("content").cast("string")
    head = F.substring_index(whole, BLANK, 1)
    told = raw.select("file", "offset", "content", head.alias("head"))
    value = lambda name: F.nullif(F.regexp_extract("head", rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1), F.lit(""))
    block = F.substr("content", F.octet_length("head") + len(BLANK) + 1, F.octet_length("content") - F.octet_length("head") - len(BLANK) - len(END))
    told = told.select("file", "offset", F.lower(value("WARC-Type")).alias("warc_type"), value("WARC-Record-ID").alias("record_id"), value("WARC-Target-URI").alias("target_uri"),
                       value("WARC-Refers-To").alias("refers_to"), value("WARC-Payload-Digest").alias("payload_digest"), F.lower(value("Content-Type")).alias("kind"), block.alias("block"))
    answer = F.substr("block", F.octet_length(F.substring_index(F.col("block").cast("string"), BLANK, 1)) + len(BLANK) + 1)
    is_answer = (F.col("warc_type") == "response") & F.col("kind").startswith("application/http")
    return told.withColumn("payload", F.when(is_answer, answer).otherwise(F.col("block"))).drop("kind", "block")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The verified records of the WARC files at ``path``; see ``parse``."""
    return parse(raw_records(spark, path))


def resolve(records: DataFrame) -> DataFrame:
    """record_id, refers_to, warc_type, payload_bytes, payload_sha256 of records:
    for revisits those of the response they name."""
    own = cut(records.select("record_id", "refers_to", "warc_type", F.octet_length("payload").cast("long").alias("bytes"), F.sha2("payload", 256).alias("digest")))
    asked = own.where("refers_to is not null").groupBy(F.col("refers_to").alias("named")).agg(F.count(F.lit(1)).alias("k"))
    named = own.where("warc_type = 'response'").groupBy(F.col("record_id").alias("named")).agg(F.max("bytes").alias("full_bytes"), F.max("digest").alias("full_digest"))
    found = join_groups(own.withColumn("named", F.col("refers_to")), asked.join(named, "named"), "named", "k")
    return found.select("record_id", "refers_to", "warc_type", F.coalesce("full_bytes", "bytes").alias("payload_bytes"), F.coalesce("full_digest", "digest").alias("payload_sha256"))

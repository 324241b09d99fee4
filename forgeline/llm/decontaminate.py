"""Benchmark decontamination by template windows.

Canonical form: a text becomes words (runs of letters) and numbers (runs of
digits with inner points or commas), case and punctuation aside.  A number becomes
the placeholder NUM, a unit word after a number UNIT, and a capitalised word NAME;
what a placeholder stands for is its slot value.  A capitalised word at the beginning
of a sentence may be a name or not, so every text has three readings: with such
words as they are, with them as NAME, and the exact one without placeholders, in
which a verbatim copy matches whatever stands before it and however it is spelled.

Windows of WINDOW canonical words with at least LITERALS plain words are hashed
(an item with fewer words is one window).  Windows of documents pass a bit set of
the benchmark's window hashes, which has a fixed size whatever the tables, and the
rest are hash-joined with the benchmark's windows; the join removes what the bit
set let through by chance.

Slots: along one alignment of a document with an item, equal slot values of the
item must stand for equal values in the document.  Windows with a slot that
breaks this are not counted.  So a question with other numbers, names or units is
found, and text that merely has the same shape isn't.

A document is contaminated by an item when the windows found, in any reading, cover
at least COVERAGE of the item's windows that are eligible in one of its readings, or
when VERBATIM consecutive words of the item stand in it, whatever their share.

Short and unspaced items: in the exact reading every window is eligible, so an item
of few plain words is found by its exact whole.  One of fewer than LITERALS words
must stand as a sentence or line of its own, or any text with such a word would be
contaminated.  A character of a script written without spaces is a word.

Defined cases: NULL and empty texts have no windows and are clean; repeated rows are judged each; repeated items
are reported each under their ids; NULL ids are kept; an empty benchmark leaves
all documents clean; extra columns are ignored (stage: kept)."""
from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgeline.llm.common import cut, remove_rows, text_of
from forgeline.llm.tokens import U, blocks, hash_spans, mix, runs

WINDOW = 8
LITERALS = 4
COVERAGE = 0.5
VERBATIM = 13
FILTER_BITS = 1 << 27  # 16 MB
LITERAL, NUM, UNIT, NAME = 0, 1, 2, 3
EXACT, RUN = 2, 3  # the exact reading; its windows of VERBATIM words
# fixed: unit words, lower case
UNITS = """m cm mm km in inch inches ft foot feet yd yard yards mile miles g kg mg lb lbs oz ounce ounces pound pounds ton tons l ml litre litres
liter liters gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years hz khz mhz ghz
w kw mw j kj cal kcal v kv a ma k c f mph kmh kb mb gb tb percent dollar dollars euro euros cent cents usd eur gbp degree degrees""".split()

_KIND = np.zeros(256, np.uint8)
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2
_JOINS = np.zeros(256, bool)
_JOINS[[44, 46]] = True  # , and . between digits
_STOPS = np.zeros(256, np.int32)
_STOPS[[10, 33, 46, 58, 63]] = 1  # line feed ! . : ?


def _kinds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kind of every byte (letters 1, digits 2, unspaced characters 3 and 4 in turn)
    and stops."""
    kind, stops = _KIND[data], _STOPS[data]
    lead = np.flatnonzero(data >= 0xE0)
    lead = lead[lead + 2 < len(data)]
    if len(lead):
        code = (data[lead].astype(np.int32) & 15) << 12 | (data[lead + 1].astype(np.int32) & 63) << 6 | data[lead + 2].astype(np.int32) & 63
        wide = data[lead] >= 0xF0  # four bytes: the planes of rare ideographs
        among = lambda *spans: np.any([(code >= a) & (code <= b) for a, b in spans], axis=0) & ~wide
        marks = lead[among((0x3000, 0x3004), (0x3008, 0x3020), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20))]
        for i in range(3):
            kind[marks + i] = 0
        stops[lead[among((0x3002, 0x3002), (0xFF01, 0xFF01), (0xFF1A, 0xFF1A), (0xFF1F, 0xFF1F))]] = 1
        # Thai, Lao; Burmese; Khmer; kana; ideographs
        ideograph = wide & (data[lead] == 0xF0) & (data[lead + 1] >= 0xA0) & (data[lead + 1] <= 0xB3) & (lead + 3 < len(data))
        one = among((0xE01, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3041, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF)) | ideograph
        at, long, turn = lead[one], ideograph[one], 3 + (np.arange(int(one.sum())) & 1)
        for i in range(3):
            kind[at + i] = turn
        kind[at[long] + 3] = turn[long]
    return kind, stops


def _lowered(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 letters in lower case, byte by byte."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    latin = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    out[1:][latin] += 32
    return out


_UNIT_HASHES = None


def _unit_hashes() -> np.ndarray:
    global _UNIT_HASHES
    if _UNIT_HASHES is None:
        raw = np.frombuffer("".join(UNITS).encode(), np.uint8)
        end = np.cumsum([len(u) for u in UNITS])
        _UNIT_HASHES = np.sort(hash_spans(raw, end - [len(u) for u in UNITS], end))
    return _UNIT_HASHES


def readings(offsets: np.ndarray, data: np.ndarray):
    """Start, end and row of the canonical words of a block, their hash and type in
    each reading, and whether they begin a sentence."""
    kind, marks = _kinds(data)
    inner = np.zeros(len(data), bool)
    inner[1:-1] = _JOINS[data[1:-1]] & (kind[:-2] == 2) & (kind[2:] == 2)
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    inner[edges] = inner[edges - 1] = False
    kind[inner] = 2
    start, end, row = runs(offsets, kind)
    low = _lowered(data)
    h = hash_spans(low, start, end)
    n = len(start)
    form = np.zeros(n, np.uint8)
    number = kind[start] == 2
    form[number] = NUM
    first = np.ones(n, bool)
    first[1:] = row[1:] != row[:-1]
    after_number = np.zeros(n, bool)
    after_number[1:] = number[:-1] & ~first[1:]
    form[after_number & ~number & np.isin(h, _unit_hashes())] = UNIT
    stops = np.concatenate(([0], np.cumsum(marks)))
    begins = first.copy()
    begins[1:] |= stops[start[1:]] > stops[end[:-1]]
    changed = low != data
    upper = changed[start] | changed[np.minimum(start + 1, end - 1)] & (data[start] == 0xC3)
    size = np.where(data[start] >= 0xC0, 2, 1)  # bytes of the first letter
    rest = np.concatenate(([0], np.cumsum(changed)))
    title = upper & (end - start > size) & (rest[end] == rest[np.minimum(start + size, end)])
    told = []
    for name in (title & ~begins, title):
        typed = np.where((form == LITERAL) & name, NAME, form).astype(np.uint8)
        told.append((np.where(typed == LITERAL, h, mix(typed.astype(np.uint64) + U(0xABCDEF))), typed))
    return start, end, row, [*told, (h, np.zeros(n, np.uint8))], begins


def canonical(offsets: np.ndarray, data: np.ndarray):
    """Hash, type, start, end and row of the canonical words of a block, first reading."""
    start, end, row, ((h, form), *_), _ = readings(offsets, data)
    return h, form, start, end, row


def windows(h: np.ndarray, form: np.ndarray, row: np.ndarray, n: int, literals: int = LITERALS):
    """Hash and first word of the windows of ``n`` words with enough plain ones."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    acc = np.full(m, n, dtype=np.uint64)
    for i in range(n):
        acc = mix(acc * U(0xD1342543DE82EF95) + h[i:i + m])
    plain = np.concatenate(([0], np.cumsum(form == LITERAL)))
    ok = (row[:m] == row[n - 1:]) & (plain[n:] - plain[:m] >= literals)
    return acc[ok], np.flatnonzero(ok)


def reading_windows(told, row: np.ndarray, n: int):
    """The windows in each reading; in the last, the exact one, all."""
    return [windows(h, form, row, n, LITERALS if k < EXACT else 0) for k, (h, form) in enumerate(told)]


SLOTS = pa.list_(pa.string())


def _slots(data, form, start, end, at: int, n: int) -> list[str]:
    """Slot values of a window as type:value, in order."""
    return [f"{form[i]}:{data[start[i]:end[i]].tobytes().decode('utf-8', 'replace').lower()}" for i in range(at, at + n) if form[i]]


def _run_windows(told, row: np.ndarray, a: int, b: int):
    h, form = told[EXACT]
    wh, at = windows(h[a:b], form[a:b], row[a:b], VERBATIM, 0)
    return wh.view(np.int64), at


ITEM = pa.schema([("item_id", pa.int64()), ("pos", pa.int32()), ("size", pa.int32()), ("h", pa.int64()), ("slots", SLOTS), ("reading", pa.int32()), ("within", pa.list_(pa.int32())), ("n_windows", pa.list_(pa.int32()))])


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, pos, size, h, slots, reading of the benchmark's windows; within: by
    reading, whether it is eligible there; n_windows: by reading, the eligible ones.
    The reading RUN has the windows of VERBATIM words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for base, offsets, data in blocks(batch.column(1)):
                start, end, row, told, _ = readings(offsets, data)
                edge = np.searchsorted(row, np.arange(len(offsets)))
                for r in range(len(offsets) - 1):
                    a, b = edge[r], edge[r + 1]
                    n = min(WINDOW, b - a)
                    if not n:
                        continue
                    found = reading_windows([(h[a:b], form[a:b]) for h, form in told], row[a:b], n)
                    counts, places = [len(at) for _, at in found], [set(at.tolist()) for _, at in found]
                    for k, (wh, at) in enumerate(found):
                        for x, p in zip(wh.view(np.int64).tolist(), at.tolist()):
                            out.append((ids[base + r], p, int(n), x, _slots(data, told[k][1], start, end, a + p, n), k, [int(p in q) for q in places], counts))
                    for x, p in zip(*(v.tolist() for v in _run_windows(told, row, a, b))):
                        out.append((ids[base + r], p, VERBATIM, x, [], RUN, [0] * len(counts), counts))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), ITEM.types)], schema=ITEM)

    return benchmark.select(benchmark[id_col].cast("long").alias("item_id"), text_of(benchmark, text).alias("text")).mapInArrow(run, "item_id long, pos int, size int, h long, slots array<string>, reading int, within array<int>, n_windows array<int>")


def bit_set(items: DataFrame) -> np.ndarray:
    """FILTER_BITS bits, set at the low bits of the windows' hashes."""
    bit = F.col("h").bitwiseAND(F.lit(FILTER_BITS - 1))
    cells = items.groupBy((F.shiftright(bit, 6)).alias("cell")).agg(F.bit_or(F.expr("shiftleft(cast(1 as bigint), cast(h & 63 as int))")).alias("bits")).toPandas()
    out = np.zeros(FILTER_BITS // 64, "<i8")  # at most as many rows as cells
    out[cells["cell"].to_numpy(np.int64)] = cells["bits"].to_numpy(np.int64)
    return out.view(np.uint8)


def document_key(docs: DataFrame, id_col: str, text: str) -> list[Column]:
    """What tells rows apart: the id, and the content for repeated ids."""
    return [docs[id_col].alias("doc_id"), F.xxhash64(text_of(docs, text)).alias("content")]


def document_windows(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, content, pos, h, slots of documents' windows in the bit set."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_set(items))
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # at most WINDOW + 1 sizes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            out = []
            for base, offsets, data in blocks(batch.column("text")):
                start, end, row, told, begins = readings(offsets, data)
                first = np.searchsorted(row, np.arange(len(offsets)))
                ends = np.append(begins[1:], True)  # the next word begins a sentence or a row
                for n, k in itertools.product(sizes, range(len(told))):
                    if k < EXACT and not LITERALS <= n <= WINDOW:
                        continue
                    h, form = told[k]
                    wh, at = windows(h, form, row, n, LITERALS if k < EXACT else 0)
                    if n < LITERALS:
                        alone = begins[at] & ends[at + n - 1]
                        wh, at = wh[alone], at[alone]
                    low = wh & U(FILTER_BITS - 1)
                    hit = np.flatnonzero(bits[(low >> U(3)).astype(np.int64)] >> (low & U(7)).astype(np.uint8) & 1)
                    for x, p in zip(wh[hit].view(np.int64).tolist(), at[hit].tolist()):
                        r = int(row[p])
                        out.append((base + r, p - int(first[r]), x, _slots(data, form, start, end, p, n)))
            if out:
                rows = pa.array([o[0] for o in out])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(rows), batch.column("content").take(rows), pa.array([o[1] for o in out], pa.int32()), pa.array([o[2] for o in out], pa.int64()), pa.array([o[3] for o in out], SLOTS)], names=["doc_id", "content", "pos", "h", "slots"])

    return docs.select(*document_key(docs, id_col, text), text_of(docs, text).alias("text")).mapInArrow(run, "doc_id long, content long, pos int, h long, slots array<string>")


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, content, item_id, coverage, verbatim of every document and item that
    share a window with consistent slots."""
    items = cut(item_windows(benchmark))
    found = document_windows(docs, items, id_col, text).withColumnsRenamed({"pos": "at", "slots": "values"}).dropDuplicates(["doc_id", "content", "at", "h"])
    pairs = found.join(items, "h").where(F.size("values") == F.size("slots")).withColumn("shift", F.col("at") - F.col("pos"))
    line = ["doc_id", "content", "item_id", "shift", "reading"]
    slotted = pairs.where(F.size("slots") > 0).select(*line, "pos", F.explode(F.arrays_zip("slots", "values")).alias("s"))
    values = slotted.groupBy(*line, F.col("s.slots").alias("slot")).agg(F.min("s.values").alias("a"), F.max("s.values").alias("b"), F.collect_set("pos").alias("where"))
    broken = values.where(F.col("a") != F.col("b")).select(*line, F.explode("where").alias("pos")).distinct()
    same = lambda c: F.col(f"p.{c}").eqNullSafe(F.col(f"b.{c}"))
    on = same("doc_id") & (F.col("p.content") == F.col("b.content")) & same("item_id") & (F.col("p.shift") == F.col("b.shift")) & (F.col("p.reading") == F.col("b.reading")) & (F.col("p.pos") == F.col("b.pos"))
    sound = pairs.alias("p").join(broken.alias("b"), on, "left_anti")
    pair, run = ["doc_id", "content", "item_id", "n_windows"], F.col("reading") == RUN
    share = lambda k: F.when(F.col("n_windows")[k] > 0, F.sum(F.col("within")[k]) / F.col("n_windows")[k])
    return (sound.select(*pair, "pos", "within", run.alias("run")).distinct().groupBy(*pair)
            .agg(F.greatest(*map(share, range(RUN))).alias("coverage"), F.max("run").alias("verbatim")).drop("n_windows"))


def contaminates(coverage: float) -> Column:
    return (F.col("coverage") >= coverage) | F.col("verbatim")


def report(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, contaminated, item_ids, best_coverage."""
    hits = matches(docs, benchmark, id_col, text)
    per_doc = hits.groupBy("doc_id", "content").agg(F.array_sort(F.collect_set(F.when(contaminates(coverage), F.col("item_id")))).alias("found"), F.max("coverage").alias("best"), F.max(contaminates(coverage)).alias("bad"))
    rows = docs.select(*document_key(docs, id_col, text))
    other = per_doc.select(F.col("doc_id").alias("_d"), F.col("content").alias("_c"), "found", "best", "bad")
    joined = rows.join(other, (rows["content"] == other["_c"]) & rows["doc_id"].eqNullSafe(other["_d"]), "left")
    best = F.coalesce("best", F.lit(0.0))
    return joined.select("doc_id", F.coalesce("bad", F.lit(False)).alias("contaminated"), F.coalesce("found", F.array().cast("array<long>")).alias("item_ids"), best.alias("best_coverage"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents no item contaminates, all columns as they were."""
    bad = matches(docs, benchmark, id_col, text).where(contaminates(coverage)).select("doc_id", "content").distinct()
    return remove_rows(docs, cut(bad), id_col, text)

"""Best-fit packing of tokenised documents by bin completion.

Tokens: every text is encoded by a public word-piece vocabulary and ended by
id 0.  Encoding acts on pre-tokens, which hold no white space, independently, so a
worker encodes each distinct word once and joins the stored id bytes; texts with
one of the vocabulary's special strings, or with a character that Python's Unicode
tables don't know (so that tables may differ about it), are encoded whole.  Only documents above the capacity are cut.

Plan: what matters to packing is how many pieces there are of each length, at
most ``capacity`` numbers whatever the input.  On that histogram the solver fills
sequences around the largest remaining piece: it enumerates, depth-first over the
sums that can be reached, the fillings of the gap that no other dominates, bounds
them by the waste that a better plan may have, and repeats a filling as often as
its rarest length lasts, or half as often, down to once.  The incumbent is best-fit
decreasing; branches whose bins so far plus the lower bound of the rest reach it
are cut, those with fewest deviations from the first choices come first, and the
search ends when it is exhausted, at the lower bound or after ``nodes`` nodes.  So
the plan has a few thousand patterns however many rows.

Placement: pieces of one length are interchangeable.  They are numbered within
(length, salt), the salts' sizes give offsets, and a number falls into one range
of the plan, which gives the sequence and the offset.

Defined cases: NULL and empty texts are one token (the end id); repeated rows and
repeated ids are packed each; an empty table gives no rows; extra columns are
ignored; a very long text becomes full pieces and a rest."""
from __future__ import annotations

import functools
import heapq
import itertools
import re
import unicodedata
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgeline.llm.common import cut, text_of

CAPACITY = 2048
END_ID = 0
CACHE_WORDS = 800_000
SALT_ROWS = 200_000
STEPS = 1_000  # of a search for fillings, that count as one node
# fixed: the vocabulary's own pre-token pattern and special strings
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ODD = re.compile(r"<\|(?:startoftext|endoftext)\|>|[\x1c-\x1f]")
# the letters that byte-level vocabularies write for the 256 bytes: printable ones as they are, the others from 256 on
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [b for b in range(256) if b not in _PRINTED]
BYTE_LETTERS = {b: chr(b) for b in _PRINTED} | {b: chr(256 + i) for i, b in enumerate(_OTHERS)}


@functools.cache
def unknown_characters() -> re.Pattern:
    """A class of all code points without a meaning in Python's Unicode tables."""
    edges, before = [], False
    for c in range(0x80, 0x110000):
        if (now := unicodedata.category(chr(c)) == "Cn") != before:
            edges.append(c)
            before = now
    edges += [0x110000] * before
    return re.compile("[" + "".join(f"{chr(a)}-{chr(b - 1)}" for a, b in zip(edges[::2], edges[1::2], strict=True)) + "]")


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    ``ids`` holds the bytes of words and pre-tokens met so far; it is emptied
    when it holds CACHE_WORDS entries, so a worker's memory is bounded."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.split = regex.compile(PRE_TOKEN).findall
        self.ids: dict[str, bytes] = {}

    def _pre_token(self, token: str) -> bytes:
        known = self.ids.get(token)
        if known is None:
            spelled = token.encode().decode("latin-1").translate(BYTE_LETTERS)
            known = self.ids[token] = array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
        return known

    def _words(self, words: list[str]) -> bytes | None:
        """Ids of words; None if one has a character that tables may differ about."""
        if len(self.ids) > CACHE_WORDS:
            self.ids = {}
        new = {w for w in words if w not in self.ids}
        if any(unknown_characters().search(w) for w in new if not w.isascii()):
            return None
        for w in new:
            self.ids[w] = b"".join(map(self._pre_token, self.split(w)))
        return b"".join(map(self.ids.__getitem__, words))

    def encode(self, text: str) -> bytes:
        ids = None
        if not ODD.search(text):  # special strings; separators that only str.split takes as white space
            plain = text if unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text)
            ids = self._words(plain.replace("\u03a3", "\u03c3").lower().split())  # the vocabulary knows no final sigma
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes() if ids is None else ids


@functools.cache
def encoder_of(path: str) -> WordEncoder:
    """One encoder per worker process, kept from task to task."""
    return WordEncoder(path)


PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def tokenize_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        last = array("I", [END_ID]).tobytes()
        for batch in batches:
            rows = []
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoder.encode(t) + last
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), PIECE.types)], schema=PIECE)

    return docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text).alias("text")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def lower_bound(left: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: by total length, and by large pieces
    (above capacity - k, each alone among those) plus what the middle overflows."""
    sizes = np.arange(len(left))
    best = -(-int((left * sizes).sum()) // capacity)
    for k in (0, capacity // 8, capacity // 4, capacity // 3, capacity // 2):
        big = int(left[capacity - k + 1:].sum()) if k else 0
        half = left[capacity // 2 + 1:capacity - k + 1]
        half_n = int(half.sum())
        half_len = int((half * sizes[capacity // 2 + 1:capacity - k + 1]).sum())
        small_len = int((left[max(k, 1):capacity // 2 + 1] * sizes[max(k, 1):capacity // 2 + 1]).sum())
        best = max(best, big + half_n + max(0, -(-(small_len - (half_n * capacity - half_len)) // capacity)))
    return best


def quick_fillings(left: np.ndarray, gap: int, width: int, effort: int) -> list[list[int]]:
    """Up to ``width`` fillings of a gap by scans over one, two and three pieces
    beside the best-fit one, least waste first; of equal waste, fewer and larger
    pieces.  They only come first; ``fillings`` has the rest."""
    have = np.flatnonzero(left[:gap + 1])
    have = have[have > 0]
    if not len(have):
        return [[]]
    greedy, room, used = [], gap, {}
    k = len(have) - 1
    while room > 0 and k >= 0:
        k = min(k, int(np.searchsorted(have, room, "right")) - 1)
        if k < 0:
            break
        x = int(have[k])
        take = min(int(left[x]) - used.get(x, 0), room // x)
        greedy += [x] * take
        used[x] = used.get(x, 0) + take
        room -= take * x
        k -= 1
    found = {(room, len(greedy), tuple(greedy))}
    bound, steps = room, 0
    # one or two pieces, whole range at once
    if bound:
        one = int(have[-1])
        found.add((gap - one, 1, (one,)))
        rest = gap - have
        j = np.searchsorted(have, rest, "right") - 1
        ok = j >= 0
        a, b = have[ok], have[j[ok]]
        pair = (a != b) | (left[a] > 1)
        a, b = a[pair], b[pair]
        if len(a):
            waste = gap - a - b
            for i in np.argsort(waste, kind="stable")[:width]:
                x, y = int(max(a[i], b[i])), int(min(a[i], b[i]))
                found.add((int(waste[i]), 2, (x, y)))
        bound = min(f[0] for f in found)
    # three pieces and more, largest first, cut by the waste bound
    for x in have[::-1]:
        if not bound or steps >= effort:
            break
        left[x] -= 1
        rest = gap - int(x)
        inner = np.flatnonzero(left[:min(rest, int(x)) + 1])
        inner = inner[inner > 0]
        if len(inner):
            j = np.searchsorted(inner, rest - inner, "right") - 1
            ok = j >= 0
            a, b = inner[ok], inner[j[ok]]
            pair = (a != b) | (left[a] > 1)
            a, b = a[pair], b[pair]
            steps += len(inner)
            if len(a):
                waste = rest - a - b
                i = int(np.argmin(waste))
                if waste[i] < bound:
                    found.add((int(waste[i]), 3, tuple(sorted((int(x), int(a[i]), int(b[i])), reverse=True))))
                    bound = int(waste[i])
        left[x] += 1
    ranked = sorted(found, key=lambda f: (f[0], f[1], [-v for v in f[2]]))
    return [list(f[2]) for f in ranked[:width]]


def fillings(left: np.ndarray, gap: int, slack: int) -> Iterator[list[int] | None]:
    """The fillings of a gap, of any number of pieces, that waste at most
    ``slack`` and that no other dominates, least waste first; of equal waste, those
    of one or two pieces first, then larger pieces first.  None after every STEPS
    steps of the search.

    A filling is dominated if a piece left over fits into its waste, or can take
    the place of some of its pieces that are together no larger."""
    have = [int(x) for x in np.flatnonzero(left[:gap + 1])[::-1] if x]
    count = [int(left[x]) for x in have]
    full = (1 << gap + 1) - 1
    reach = [1]  # bit s of reach[k]: pieces of the lengths have[k:] add up to s
    for x, n in zip(have[::-1], count[::-1], strict=True):
        sums, n, k = reach[-1], min(n, gap // x), 1
        while n and sums != full:
            sums |= sums << x * min(k, n) & full
            n, k = n - min(k, n), 2 * k
        reach.append(sums)
    reach.reverse()
    spare = sum(1 << x for x in have)
    steps = 0

    def smear(bits: int, low: int, high: int) -> int:
        """The sums s with a set bit among s + low .. s + high."""
        bits, width = bits >> low, 1
        while width < high - low + 1:
            more = min(width, high - low + 1 - width)
            bits, width = bits | bits >> more, width + more
        return bits if high >= low else 0

    def walk(k: int, rest: int, waste: int, most: int, chosen: list, some: int, many: int, spare: int):
        """``some`` and ``many``: sums of any and of two or more chosen pieces."""
        nonlocal steps
        if not rest:
            if not spare & ((1 << waste + 1) - 1):
                yield chosen
            return
        while k < len(have) and reach[k] >> rest & 1:
            x = have[k]
            steps += 1
            if not steps % STEPS:
                yield None
            if x <= rest and (most > 1 or x == rest):
                turns = []
                s, m = some, many
                settled = spare & (-1 << x + 1)  # left-over lengths above x
                larger, alone = smear(settled, 0, waste), smear(settled, 1, waste) >> x & 1
                for c in range(1, min(count[k], rest // x, most) + 1):
                    m |= (s ^ 1) << x
                    s |= s << x
                    if m & larger or alone:
                        break
                    if reach[k + 1] >> rest - c * x & 1:
                        turns.append((c, s, m))
                for c, s, m in reversed(turns):
                    yield from walk(k + 1, rest - c * x, waste, most - c, chosen + [x] * c, s, m, spare ^ (1 << x) if c == count[k] else spare)
            k += 1

    for waste in range(min(slack, gap) + 1):
        if reach[0] >> gap - waste & 1:
            yield from walk(0, gap - waste, waste, 2, [], 1, 0, spare)
            yield from (f for f in walk(0, gap - waste, waste, gap, [], 1, 0, spare) if f is None or len(f) > 2)


def _repeats(left: np.ndarray, pattern: list[int]) -> int:
    need: dict[int, int] = {}
    for x in pattern:
        need[x] = need.get(x, 0) + 1
    return min(int(left[x]) // n for x, n in need.items())


def _take(left: np.ndarray, pattern: list[int], times: int) -> None:
    for x in pattern:
        left[x] -= times


def _complete(left: np.ndarray, choose) -> list[tuple[list[int], int]]:
    plan = []
    while left.any():
        big = int(np.flatnonzero(left)[-1])
        left[big] -= 1
        rest = choose(left, len(left) - 1 - big)
        left[big] += 1
        pattern = [big, *rest]
        times = _repeats(left, pattern)
        _take(left, pattern, times)
        plan.append((pattern, times))
    return plan


def best_fit(left: np.ndarray, gap: int) -> list[int]:
    """The incumbent's filling: always the largest piece that still fits."""
    out, room, used = [], gap, {}
    have = np.flatnonzero(left[:gap + 1])
    for x in have[::-1]:
        x = int(x)
        if x == 0 or x > room:
            continue
        take = min(int(left[x]), room // x)
        out += [x] * take
        room -= take * x
    return out


def options(left: np.ndarray, big: int, capacity: int, slack: int, width: int, effort: int) -> Iterator[tuple[list[int], int] | None]:
    """Patterns around a piece ``big`` with numbers of sequences: each filling as
    often as its rarest length and the slack allow, the quick ones first; every third
    is an earlier pattern half as often, down to once."""
    gap, inner = capacity - big, left.copy()
    inner[big] -= 1
    quick = [f for f in quick_fillings(inner, gap, width, effort) if gap - sum(f) <= slack]
    found = itertools.chain(quick, (f for f in fillings(inner, gap, slack) if f not in quick))
    shorter: deque[tuple[list[int], int]] = deque()
    for turn in itertools.count(1):
        rest = next(found, ()) if turn % 3 or not shorter else ()
        if rest is None:
            yield None
            continue
        if rest != ():
            pattern = [big, *rest]
            times, waste = _repeats(left, pattern), gap - sum(rest)
            times = min(times, slack // waste) if waste else times
        elif shorter:
            pattern, times = shorter.popleft()
        else:
            return
        yield pattern, times
        if times > 1:
            shorter.append((pattern, times // 2))


def solve(histogram: dict[int, int], capacity: int = CAPACITY, nodes: int = 4_000, width: int = 3, effort: int = 60_000) -> list[tuple[list[int], int]]:
    """Patterns (lengths of one sequence) with their numbers of sequences."""
    whole = np.zeros(capacity + 1, dtype=np.int64)
    for size, n in histogram.items():
        whole[size] = n
    least = lower_bound(whole, capacity)
    sizes = np.arange(capacity + 1)
    count = lambda plan: sum(n for _, n in plan)

    best = _complete(whole.copy(), best_fit)
    if count(best) > least:
        tried = _complete(whole.copy(), lambda rest, gap: quick_fillings(rest, gap, 1, effort)[0])
        best = min(best, tried, key=count)
    # branch and bound: fewest deviations from the first options first, then those of the larger pieces
    heap, budget, pushed = [(0, 0, 0, 0, None, ())], nodes, 0
    while heap and budget > 0 and count(best) > least:
        turns, _, _, taken, slack, node = heapq.heappop(heap)
        plan, at = [], node
        while at:
            at, *step = at
            plan.append(tuple(step))
        plan.reverse()
        now, bins = whole.copy(), count(plan)
        for pattern, times in plan:
            _take(now, pattern, times)
        while budget > 0:
            if not now.any():
                best = min(best, plan, key=count)
                break
            if bins + lower_bound(now, capacity) >= count(best):
                break
            if slack is None:  # what a better plan may waste from here on
                slack = (count(best) - 1 - bins) * capacity - int((now * sizes).sum())
            big = int(np.flatnonzero(now)[-1])
            option = next(itertools.islice(options(now, big, capacity, slack, width, effort), taken, None), ())
            budget -= 1
            if option == ():
                break
            pushed += 1
            heapq.heappush(heap, (turns + (taken == 0) + (taken + 1) // 4, len(plan), pushed, taken + 1, slack, node))
            if option is None:
                break
            _take(now, *option)
            plan, bins, node = [*plan, option], bins + option[1], (node, *option)
            taken, slack = 0, None
    return best


def plan_ranges(plan: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """The plan by number of piece within its length: sorted ranges of numbers,
    each with its first sequence, sequences, offset and length."""
    rows, used, sequence = [], {}, 0
    for pattern, times in plan:
        at, i = 0, 0
        while i < len(pattern):
            x, j = pattern[i], i
            while j < len(pattern) and pattern[j] == x:
                j += 1
            rows.append((x, used.get(x, 0), sequence, times, at))
            used[x] = used.get(x, 0) + times * (j - i)
            at += x * (j - i)
            i = j
        sequence += times
    rows.sort()
    names = ("length", "low", "sequence", "times", "offset")
    return {n: np.array([r[i] for r in rows], dtype=np.int64) for i, n in enumerate(names)}


def number_pieces(pieces: DataFrame, rows: int) -> DataFrame:
    """Adds ``number``, 0.. within each length, without one task per length."""
    salts = max(64, rows // SALT_ROWS)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    sizes = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inner = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    return (salted.join(starts, ["length", "salt"])
            .withColumn("number", F.col("first") + F.row_number().over(inner) - 1).drop("first", "salt"))


PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def place(numbered: DataFrame, ranges: dict[str, np.ndarray]) -> DataFrame:
    """Sequence and offset of every numbered piece, by the plan's ranges (at most
    the distinct lengths of each pattern, whatever the number of rows)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (ranges["length"] << 48) | ranges["low"]
        for batch in batches:
            size, number = (batch.column(n).to_numpy() for n in ("length", "number"))
            at = np.searchsorted(key, (size << 48) | number, "right") - 1
            turn = number - ranges["low"][at]
            sequence = ranges["sequence"][at] + turn % ranges["times"][at]
            offset = ranges["offset"][at] + turn // ranges["times"][at] * size
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in PIECE.names), pa.array(sequence), pa.array(offset)], names=[*PIECE.names, "sequence_id", "offset"])

    return numbered.mapInArrow(run, PLACED)


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = cut(tokenize_pieces(docs, vocabulary or default_vocabulary(), capacity, id_col, text))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows
    plan = plan_ranges(solve(histogram, capacity))
    return place(number_pieces(pieces, sum(histogram.values())), plan)

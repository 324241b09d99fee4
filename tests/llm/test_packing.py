"""Packing: exact tokens, gapless sequences, the solver's optimality on small cases."""
import random
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from forgeline.llm import packing

VOCABULARY = packing.default_vocabulary()
TEXTS = ["", None, "Hello, don't stop 12ab!", "İstanbul ΣΑΣ ς I'LL", "a <|endoftext|> b", "x \x1c y", "a b　漢字é ½", "word " * 3000, "tie", "tie", "é é", "​", "''s 's"]


def ids_of(text):
    return [*Tokenizer.from_file(VOCABULARY).encode(text or "", add_special_tokens=False).ids, 0]


def test_pieces_and_places_against_the_tokenizer(documents, clashing):
    pairs = [*enumerate(TEXTS), (3, "same id"), (None, "no id"), (3, "same id")]
    rows = packing.pack(clashing(documents(pairs)), capacity=64).collect()
    want = sorted((str(i), k, a, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for i, t in pairs for ids in [ids_of(t)] for k, a in enumerate(range(0, len(ids), 64)) for p in [ids[a:a + 64]])
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    at = defaultdict(list)
    for r in rows:
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in at.values():
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end += n
        assert end <= 64
    assert len(at) >= packing.lower_bound(np.bincount([w[3] for w in want], minlength=65), 64)


def test_word_store_stays_bounded(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 5)
    encoder = packing.WordEncoder(VOCABULARY)
    for t in ["a b c d e f g h", "i j k a", "a b, c! d"] * 3:
        assert encoder.encode(t) == np.array(ids_of(t)[:-1], "<u4").tobytes()
        assert len(encoder.ids) <= 5 + 3 * 8


def optimal(sizes, capacity):
    """Fewest sequences, by search over all placements."""
    best = [len(sizes)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity and bins[k] not in bins[:k]:
                place(i + 1, bins[:k] + [bins[k] + sizes[i]] + bins[k + 1:])
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(30))
def test_solver_is_optimal_on_small_cases(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 11))), reverse=True)
    histogram = {s: sizes.count(s) for s in sizes}
    plan = packing.solve(histogram, 20)
    used = defaultdict(int)
    for pattern, times in plan:
        assert sum(pattern) <= 20 and times > 0
        for x in pattern:
            used[x] += times
    assert used == histogram
    assert sum(n for _, n in plan) == optimal(sizes, 20)


def test_solver_cost_does_not_follow_the_counts():
    rng = random.Random(1)
    small = {s: rng.randint(1, 50) for s in range(1, 2049)}
    one, big = packing.solve(small), packing.solve({s: n * 10**6 for s, n in small.items()})
    assert len(big) < 3 * len(one)
    left = np.zeros(2049, np.int64)
    left[list(small)] = list(small.values())
    assert sum(n for _, n in one) <= 1.01 * packing.lower_bound(left, 2048)
    assert sum(n for _, n in big) <= 1.01 * packing.lower_bound(left * 10**6, 2048)


def test_large_groups_of_few_lengths_fill_every_sequence():
    plan = packing.solve(dict.fromkeys((600, 500, 400, 300, 248), 3000))
    assert sum(n for _, n in plan) == 3000 and all(sum(p) == 2048 for p, _ in plan)


@pytest.mark.parametrize("seed", range(20))
def test_fillings_are_all_that_none_dominates(seed):
    rng = random.Random(seed)
    left = np.array([0, *(rng.choice([0, 0, 1, 2, 3]) for _ in range(14))])
    gap, slack = rng.randint(8, 14), rng.randint(0, 3)
    every = [()]
    for x in range(14, 0, -1):
        every = [f + (x,) * c for f in every for c in range(left[x] + 1) if sum(f) + c * x <= gap]

    def dominated(f):
        parts = [tuple(x for i, x in enumerate(f) if bits >> i & 1) for bits in range(1 << len(f))]
        return any(sum(p) <= x <= sum(p) + gap - sum(f) and p != (x,) for p in parts for x in range(1, gap + 1) if f.count(x) < left[x])

    got = [tuple(f) for f in packing.fillings(left, gap, slack) if f is not None]
    assert sorted(got) == sorted(f for f in every if gap - sum(f) <= slack and not dominated(f))
    assert [gap - sum(f) for f in got] == sorted(gap - sum(f) for f in got)


def test_empty_table(documents):
    assert packing.pack(documents([])).count() == 0


def test_every_code_point_is_encoded_like_the_tokenizer():
    encoder = packing.WordEncoder(packing.default_vocabulary())
    whole = lambda t: array("I", encoder.whole.encode(t, add_special_tokens=False).ids).tobytes()
    for c in [*range(0xD800), *range(0xE000, 0x110000)]:
        if c < 0x3000 or c % 7 == 3 or 0xA000 <= c < 0xB000 or 0x18C00 <= c < 0x19000 or 0x323A0 <= c < 0x323D0:
            t = f"a{chr(c)}b {chr(c)}"
            assert encoder.encode(t) == whole(t), hex(c)

"""Near-duplicate components against brute force, with every split forced."""
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from forgeline.llm import jaccard_join
from forgeline.llm.components import components
from forgeline.llm.jaccard_join import SetTrie

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(pairs):
    """component id and set size by row; None sorts last."""
    sets = [shingles(t) for _, t in pairs]
    parent = list(range(len(pairs)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    where = defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in where[g])
        for j, k in common.items():
            if 100 * k >= 75 * (len(s) + len(sets[j]) - k):
                parent[find(i)] = find(j)
        for g in s:
            where[g].append(i)
    least = {}
    for i, (d, _) in enumerate(pairs):
        r = find(i)
        least[r] = min(least.get(r, (True, 0)), (d is None, d or 0))
    ids = [None if least[find(i)][0] else least[find(i)][1] for i in range(len(pairs))]
    return [(d, len(s), c if s else d) for (d, _), s, c in zip(pairs, sets, ids)]


def corpus(seed, hot=60):
    """Families of near copies with few and many edits, chains, shared passages."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]

    def edited(words, k):
        words = list(words)
        for _ in range(k):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        return words

    docs = []
    base = text(80)
    docs += [edited(base, rng.choice((0, 1, 1, 2, 3, 4))) for _ in range(hot)]  # the most central one may be missing
    for _ in range(8):
        b = text(rng.randrange(5, 120))
        docs += [edited(b, rng.randrange(0, 4)) for _ in range(rng.randrange(1, 7))]
    chain = text(60)
    for _ in range(12):
        docs.append(chain)
        chain = chain[3:] + text(3)
    passage = text(55)
    docs += [passage + text(rng.randrange(5, 90)) for _ in range(30)]
    docs += [["a", "b"], ["A", "b"], ["a"], [], ["a", "b", "c", "d"], ["a", "b", "c", "d", "e"], ["a", "b", "c", "d", "e"] * 9]
    out = [(i, " ".join(w)) for i, w in enumerate(docs)]
    rng.shuffle(out)
    return out


def got(df):
    return [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()]


order = lambda rows: sorted(rows, key=str)


@pytest.mark.parametrize("seed, hot, chunk", [(1, 4_096, 4_096), (2, 3, 5), (3, 1, 2)])
def test_components_equal_brute_force(documents, clashing, monkeypatch, seed, hot, chunk):
    monkeypatch.setattr(jaccard_join, "HOT_GROUP", hot)
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    monkeypatch.setattr(jaccard_join, "LEADER_GROUP", chunk)
    monkeypatch.setattr(jaccard_join, "SMALL_GROUP", 128 if hot > 3 else 4)
    pairs = corpus(seed)
    assert order(got(jaccard_join.near_duplicates(clashing(documents(pairs))))) == order(brute(pairs))


def test_nulls_repeats_ties_and_stage(documents, clashing):
    long = " ".join(f"x{i % 977}" for i in range(60000))
    some = "one two three four five six seven eight"
    pairs = [(1, None), (2, ""), (3, " \n"), (4, some), (4, some), (None, some.upper()), (None, "null alone in its own set"), (7, long), (8, long + " end"), (9, "un sept"), (9, some + " other words entirely here to be sure of it"), (10, "un  SEPT"), (10, "un  SEPT")]
    docs = clashing(documents(pairs))
    assert order(got(jaccard_join.near_duplicates(docs))) == order(brute(pairs))
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "2", "3", "4", "None", "7", "9", "9"])


def test_empty_table(documents):
    assert jaccard_join.near_duplicates(documents([])).count() == 0
    assert jaccard_join.keep_one(documents([])).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_trie_finds_all_partners(seed):
    rng = np.random.default_rng(seed)
    pool = rng.integers(0, 2**63, 60).astype(np.uint64)
    sets = [np.sort(rng.choice(pool, rng.integers(1, 40), replace=False)) for _ in range(150)]
    trie = SetTrie([s.astype("<u8").tobytes() for s in sets])
    for s in sets[:40]:
        want = [i for i, t in enumerate(sets) if 100 * (k := len(np.intersect1d(s, t))) >= 75 * (len(s) + len(t) - k)]
        assert sorted(trie.partners(s)) == want


@pytest.mark.parametrize("part", [500_000, 7])
def test_connected_components(spark, monkeypatch, part):
    import sys
    monkeypatch.setattr(sys.modules["forgeline.llm.components"], "PART", part)
    links = [(i, i + 1) for i in range(30)] + [(100, x) for x in range(200, 260)] + [(5, 5), (7, 400), (None, 3)]
    got_ = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long").repartition(4)).collect()}
    want = {i: 0 for i in [*range(1, 31), 400]} | {i: 100 for i in range(200, 260)}
    assert got_ == want


@pytest.mark.parametrize("seed", range(3))
def test_bitmaps_rule_out_no_link(seed):
    rng = np.random.default_rng(seed)
    sets = []
    for n in (1, 2, 5, 63, 64, 65, 127, 130, 400, 520, 3_000):
        base = rng.integers(0, 2**63, n, dtype=np.uint64)
        for share in (1.0, 0.95, 0.87, 0.8, 0.5, 0.0):
            kept = base[:int(n * share)]
            for more in (0, n - len(kept), n // 7):
                sets.append(np.unique(np.concatenate((kept, rng.integers(0, 2**63, more, dtype=np.uint64)))))
    sets.append(np.array([], np.uint64))
    sizes = np.array([len(x) for x in sets])
    maps = jaccard_join.parities(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), sizes).to_pylist()
    assert maps[-1] == b"" and all(len(m) * 8 >= n for m, n in zip(maps, sizes))
    full = [i for i in range(len(sets)) if sizes[i]]
    linked = dropped = 0
    for i in full:
        kept = jaccard_join.may_link((int(sizes[i]), maps[i]), [(int(sizes[j]), maps[j]) for j in full])
        for j, may in zip(full, kept):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 75 * (sizes[i] + sizes[j] - both):
                linked += 1
                assert may
            else:
                dropped += not may
    assert linked > 200 and dropped > 0.9 * (len(full) ** 2 - linked)


@pytest.mark.parametrize("seed, hot", [(4, 3), (5, 1)])
def test_components_with_small_parts(documents, monkeypatch, seed, hot):
    for name, value in (("HOT_GROUP", hot), ("CHUNK", 4), ("MAP_CHUNK", 3), ("LEADER_GROUP", 5), ("SMALL_GROUP", 4), ("SENT_TOGETHER", 50)):
        monkeypatch.setattr(jaccard_join, name, value)
    pairs = corpus(seed)
    assert order(got(jaccard_join.near_duplicates(documents(pairs)))) == order(brute(pairs))


def test_rest_fetches_only_what_may_be_linked(documents, monkeypatch):
    """Sets that share a passage, three fifths of their shingles: one group, no link."""
    monkeypatch.setattr(jaccard_join, "SMALL_GROUP", 4)
    met, decided = [], []
    for name, seen in (("open_clusters", met), ("decide_clusters", decided)):
        def spy(*a, f=getattr(jaccard_join, name), name=name, seen=seen):
            out = f(*a)
            seen.append((out if name == "open_clusters" else a[0]).count())
            return out
        monkeypatch.setattr(jaccard_join, name, spy)
    rng = random.Random(1)
    text = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    passage = text(560)
    pairs = [(i, f"{passage} {text(180)}") for i in range(40)]
    assert order(got(jaccard_join.near_duplicates(documents(pairs)))) == order(brute(pairs))
    assert met == [40] and sum(decided) < 4


def test_tasks_send_few_rows(spark, documents):
    rng = random.Random(2)
    pairs = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(2_000))) for i in range(300)]  # four blocks
    sketch = spark.sparkContext.broadcast(np.zeros(jaccard_join.SKETCH, np.uint8))
    rows = jaccard_join.send(documents(pairs).coalesce(1), sketch, 16).collect()
    assert sorted(r["shard"] for r in rows) == list(range(16))
    assert sum(len(r["place"]) for r in rows) == sum(len(s) // 4 + 1 for s in (shingles(t) for _, t in pairs))


def test_sketch_parts_are_small_and_come_back():
    rng = np.random.default_rng(3)
    counts = rng.poisson(0.25, 100_003).astype(np.uint32)
    counts[rng.integers(0, len(counts), 90)] = rng.integers(250, 2**32, 90)
    packed = jaccard_join.pack_counts(counts)
    assert (jaccard_join.unpack_counts(packed, len(counts)) == counts).all()
    assert len(packed) < len(counts) / 6
    none = np.zeros(64, np.uint32)
    assert (jaccard_join.unpack_counts(jaccard_join.pack_counts(none), 64) == none).all()

"""Exact deduplication: the index, the operator against brute force."""
import hashlib
import random
from collections import defaultdict

from forgeline.llm import exact_dedup
from forgeline.llm.exact_dedup import CuckooIndex


def test_index_inserts_deletes_and_grows():
    rng = random.Random(5)
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(5000)]
    index, model = CuckooIndex(buckets=4), {}
    for k in rng.choices(keys, k=20000):
        if k in model and rng.random() < 0.5:
            assert index.delete(k)
            del model[k]
        else:
            index.put(k, len(model))
            model[k] = index.get(k)
    assert index.size == len(model) == len(dict(index.pairs()))
    assert all((index.get(k) is not None) == (k in model) for k in keys)
    assert not index.delete(b"\0" * 32)


def test_fingerprint_collisions_are_verified():
    # equal fingerprint and buckets, different content
    a, b = b"\1" * 20 + b"a" * 12, b"\1" * 20 + b"b" * 12
    index = CuckooIndex()
    index.put(a, 1)
    assert index.get(b) is None and not index.delete(b)
    index.put(b, 2)
    assert (index.get(a), index.get(b)) == (1, 2)


def brute(pairs):
    groups = defaultdict(list)
    for i, t in pairs:
        t = t or ""
        groups["".join(c for c in t if c not in " \t\n\x0b\x0c\r")].append((-len(t), i is None, i or 0, i))
    return {k: (min(v)[3], len(v)) for k, v in groups.items()}


PAIRS = [(5, "a b"), (3, "ab"), (4, "a  b"), (9, "a\tb "), (1, None), (2, ""), (7, " \n"), (8, "ab "), (10, "é 😀"), (11, "é😀 "), (None, "zz"), (12, "zz"), (None, "yy"), (6, "w" * 50000), (13, "w" * 50000 + " ")]


def test_operator_equals_brute_force(documents, clashing):
    pairs = PAIRS + [(i, "hot copy") for i in range(100, 400)]
    want = brute(pairs)
    rows = exact_dedup.deduplicate(clashing(documents(pairs))).collect()
    assert len(rows) == len(pairs)
    by_hash = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
    assert all((r["keep_id"], r["group_size"]) == by_hash[r["text_sha256"]] for r in rows)
    kept = [r["text_sha256"] for r in rows if r["kept"]]
    assert sorted(kept) == sorted(by_hash)


def test_repeated_rows_keep_one_and_stage_agrees(documents, clashing):
    pairs = PAIRS + [(5, "a b")] * 3 + [(3, "other"), (3, "other")]
    docs = clashing(documents(pairs))
    rows = exact_dedup.deduplicate(docs).collect()
    assert len(rows) == len(pairs) and sum(r["kept"] for r in rows) == len(brute(pairs))
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(brute(pairs))
    assert sorted(str(r["doc_id"]) for r in rows if r["kept"]) == sorted(str(r["doc_id"]) for r in kept.collect())


def test_empty_table(documents):
    assert exact_dedup.deduplicate(documents([])).count() == 0
    assert exact_dedup.keep_one(documents([])).count() == 0


def test_changes_to_live_digests(spark):
    live = spark.createDataFrame([(b"a", 2), (b"b", 1)], "digest binary, copies long")
    changes = spark.createDataFrame([(1, b"a", "delete"), (2, b"b", "delete"), (3, b"c", "insert"), (4, b"c", "delete"), (5, b"c", "insert"), (6, b"d", "delete")], "seq long, digest binary, op string")
    got = {bytes(r["digest"]): r["copies"] for r in exact_dedup.apply_changes(live, changes).collect()}
    assert got == {b"a": 1, b"c": 1}

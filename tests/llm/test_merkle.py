"""Merkle manifest: sweeps, proofs and the operator against brute force."""
import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from forgeline.llm import merkle
from forgeline.llm.queries import QUERIES

FAN = merkle.FAN


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree_of(leaves):
    """Root, and every leaf's steps (slot, siblings), level by level."""
    steps, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for k in range(len(leaves)):
            run = level[at[k] // FAN * FAN:][:FAN]
            slot = at[k] % FAN
            steps[k].append((slot, "".join(run[:slot] + run[slot + 1:])))
            at[k] //= FAN
        level = [H(*level[i:i + FAN]) for i in range(0, len(level), FAN)]
    return level[0], steps


def brute(rows):
    """{(doc_id, leaf): (subroot, root, proof)} of (doc_id, source, lang, n_chars, text)."""
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append((r[0] is not None, r[0] or 0, H(*map(field, r)), r[0]))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree_of([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in sources]
    root, tops = tree_of([t[0] for t in trees])
    out = {}
    for s, (subroot, steps), top in zip(sources, trees, tops):
        for x, own in zip(sorted(by[s], key=lambda x: x[:3]), steps):
            out.setdefault((x[3], x[2]), []).append((subroot, root, tuple(own + top)))
    return out


def run(docs):
    leaf = merkle.leaf_digest(*[docs[c] for c in ("doc_id", "source", "lang", "n_chars", "text")])
    return merkle.manifest(docs, docs["source"], docs["doc_id"], leaf, {"doc_id": docs["doc_id"]})


def same(docs, rows):
    found = defaultdict(list)
    for r in run(docs).collect():
        found[(r["doc_id"], r["leaf"])].append((r["subroot"], r["root"], tuple((s["slot"], s["siblings"]) for s in r["proof"])))
    want = brute(rows)
    key = lambda d: {k: sorted(v) for k, v in d.items()}
    assert key(found) == key(want)


@pytest.fixture
def table(spark):
    from tests.llm.conftest import DOC
    return lambda rows: spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3]) for r in rows], DOC).repartition(5)


@pytest.mark.parametrize("n", [0, 1, 2, 15, 16, 17, 255, 256, 257, 4096, 4097])
def test_sweeps(n):
    leaves = [H(str(i)) for i in range(n)]
    if not n:
        return
    tree = merkle.sweep_up(leaves, merkle.levels_of(n))
    root, steps = tree_of(leaves)
    assert tree[-1] == [root] and merkle.sweep_down(tree, [(3, "above")]) == [[*s, (3, "above")] for s in steps]


SIZES = {"a": 1, "b": 15, "c": 16, "d": 17, "é": 300, None: 33, "": 2, "hot": 5000}


def make(sizes, seed=3):
    rng = random.Random(seed)
    ids = rng.sample(range(-5000, 100000), sum(sizes.values()))
    rows = [(ids.pop(), s, rng.choice(["en", None]), rng.choice([None, 7]), rng.choice([None, "", "A b", "ÄÖ 😀 X" * rng.randrange(4)])) for s, n in sizes.items() for _ in range(n)]
    return rows


def test_equals_brute_force(table, clashing):
    rows = make(SIZES)
    rows += [(None, "d", None, None, None), (None, "d", None, None, "x"), (77, "b", "en", 1, "t" * 300_000)]
    rows += [rows[0], rows[0], rows[40], rows[-4]]  # repeated rows and ids
    same(clashing(table(rows)).withColumns({c: F.lit("x") for c in ("leaf", "tree", "number", "digest", "proof", "root", "subroot")}), rows)


def test_many_layers_and_sources(table, monkeypatch):
    monkeypatch.setattr(merkle, "STRIDE", 1)
    monkeypatch.setattr(merkle, "CHUNK", FAN)
    rows = make({f"s{i}": 1 + i % 3 for i in range(20)} | {"hot": 300})
    same(table(rows), rows)


def test_empty_and_lone(table):
    assert run(table([])).collect() == []
    (r,) = run(table([(4, None, None, None, None)])).collect()
    assert r["leaf"] == r["subroot"] == r["root"] == H("1:4", "-", "-", "-", "-") and r["proof"] == []


def test_fold_detects_any_change(table):
    rows = run(table(make({"a": 40, "b": 20, "c": 1})))
    fold = merkle.fold(F.col("leaf"), F.col("proof"))
    assert rows.where(fold == F.col("root")).count() == 61
    assert rows.where(merkle.fold(F.sha2("leaf", 256), F.col("proof")) == F.col("root")).count() == 0
    changed = F.transform("proof", lambda s: F.struct(s["slot"].alias("slot"), F.translate(s["siblings"], "0", "1").alias("siblings")))
    hit = F.exists("proof", lambda s: s["siblings"].contains("0"))
    assert rows.where(hit & (merkle.fold(F.col("leaf"), changed) == F.col("root"))).count() == 0


def test_query_tampers_only_letters(table, spark, tmp_dir):
    import zlib
    rows = make({"a": 50, None: 20}, 9)
    table(rows).write.parquet(f"{tmp_dir}/documents.parquet")
    texts = {r[0]: r[4] for r in rows}
    for r in QUERIES["op11_merkle_manifest"](spark, tmp_dir).collect():
        t = texts[r["doc_id"]] or ""
        changed = zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in t)
        assert r["verified"] == (not changed) and (r["folded_root"] == r["root"]) == r["verified"]

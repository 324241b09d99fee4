"""Hard negatives: curve, bounds, the operator against brute force."""
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from forgeline.llm import hard_negatives as hn


def test_curve_visits_neighbours():
    for n, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=n)))
        key = hn.hilbert(cells, bits)
        assert sorted(key.tolist()) == list(range(len(cells)))
        assert np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(1).max() == 1


def test_bounds_hold():
    rng = np.random.default_rng(1)
    for _ in range(50):
        x, rows = rng.integers(-300, 300, (4, 6)).astype(float), rng.integers(-300, 300, (20, 6)).astype(float)
        low, high = hn._bounds(x, rows.min(0)[None], rows.max(0)[None])
        scores = x @ rows.T
        assert (scores >= low).all() and (scores <= high).all()


def brute(rows, positives=5, negatives=10, low=30, high=90, every=10):
    best = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        best[i] = min(best.get(i, (label, v)), (label, v))
    q = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in best.items()}
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = set()
    for a, (label, v) in q.items():
        if a % every:
            continue
        told = sorted((-score(v, w), i, other) for i, (other, w) in q.items() if i != a)
        for s, p, _ in [t for t in told if t[2] == label][:positives]:
            inside = [t for t in told if t[2] != label and low * -s <= 100 * -t[0] <= high * -s][:negatives]
            out |= {(a, p, r, t[1], -s, -t[0]) for r, t in enumerate(inside, 1)}
    return out


@pytest.fixture
def run(spark):
    def go(rows, every=10, change=lambda df: df, **kind):
        df = change(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5))
        got = hn.mine(df, df["vec_id"], df["embedding"], df["label"], df["vec_id"] % every == 0, **kind)
        return {tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()}
    return go


def vectors(n, labels=4, width=6, seed=2, levels=8):
    rng = random.Random(seed)
    return [(i, [rng.randrange(-levels, levels) / 16 for _ in range(width)], rng.randrange(labels)) for i in range(n)]


ODD = [(10_000, None, 1), (10_010, [0.5] * 6, None), (10_020, [None] + [0.5] * 5, 1), (10_030, [math.nan] * 6, 1), (10_040, [math.inf] + [0.1] * 5, 1), (None, [0.5] * 6, 1),
       (10_050, [], 2), (10_060, [0.5, 0.25], 2), (10_070, [0.5] * 9, 2), (10_080, [0.5] * 6, 77), (10_090, [0.0] * 6, 1)]


def test_equals_brute_force(run, clashing, monkeypatch):
    for name, value in (("BLOCK", 32), ("GROUP", 8), ("PAGE", 4), ("SEEDS", 1)):
        monkeypatch.setattr(hn, name, value)
    rows = vectors(700) + ODD
    rows += [(i, [0.25] * 6, 3) for i in range(20_000, 20_200)]  # ties: a third of a label in one point
    rows += rows[:30] + [(5, [0.1] * 6, 0), (50, [0.2] * 6, 1)]  # repeated rows, repeated ids
    assert run(rows, change=lambda df: clashing(df).withColumns({c: F.lit("x") for c in ("id", "vector", "asks", "place", "block", "grp")})) == brute([(i, v and [float(np.float32(x)) if x is not None else None for x in v], lab) for i, v, lab in rows])


def test_other_limits_and_defaults(run):
    rows = vectors(500, labels=3, seed=5, levels=3)
    assert run(rows, positives=2, negatives=3, low=50, high=100) == brute(rows, 2, 3, 50, 100)


def test_small_and_empty(run):
    assert run([]) == set()
    assert run([(0, [0.5], 1), (1, [0.5], 1)]) == set()  # no row of another label
    rows = [(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2), (3, [0.95], 2), (4, [-0.5], 2)]
    assert run(rows) == brute(rows) == {(0, 1, 1, 2, 65536, 32768)}


def test_large_components(run):
    rows = [(i, [x * 3.0e6 for x in v], lab) for i, v, lab in vectors(300)]
    assert run(rows) == brute([(i, [float(np.float32(x)) for x in v], lab) for i, v, lab in rows])


def test_zone_maps_save_reads(spark, monkeypatch, tmp_dir):
    """Rows in tight clusters: the bounds leave few blocks to read."""
    for name, value in (("BLOCK", 16), ("GROUP", 8)):
        monkeypatch.setattr(hn, name, value)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(40, 16))
    rows = [(i, (centre[i % 40] + rng.normal(size=16) * 0.02).tolist(), i % 5) for i in range(8000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    used, pick = [], hn.pick
    monkeypatch.setattr(hn, "pick", lambda asked, pages, same, seeds: used.append((asked, pick(asked, pages, same, seeds))) or used[-1][1])
    told = hn.mine(df, df["vec_id"], df["embedding"], df["label"], df["vec_id"] % 100 == 0)
    assert told.count() > 0
    pairs = sum(p.count() for _, p in used)
    groups = max(a.count() for a, _ in used)
    assert pairs < 0.5 * groups * 8000 / 16

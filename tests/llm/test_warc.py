"""WARC: chains of record boundaries, archives read back under hostile payloads."""
import glob
import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from forgeline.llm import warc
from forgeline.llm.queries import QUERIES

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999:x>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
PAGES = [(1, "http://a/", "<p>one</p>"), (2, "http://a/x y\r\nWARC-Type: no", "x" * 200), (3, None, "x" * 200), (4, "u", None), (5, "u", ""), (None, "u", "x" * 200),
         (6, "u", FAKE), (7, "u", FAKE * 40), (8, "u", "WARC/1."), (9, "u", "WARC/1.1\r\n" * 30 + "é😀" * 60), (10, "u", "y" * 99), (11, "u", "y" * 99), (12, "u", "\r\n\r\nWARC/1.0\r\nContent-Length: 0\r\n\r\n" * 9),
         (13, "http://a/100%20", "z" * 30_000), (14, "u", "a\r\n\r\nb" + "é" * 99), (15, "u", "a\r\n\r\nb" + "é" * 99), (1, "again", "x" * 200), (None, "u", "q" * 150)]


def brute(pages):
    out, groups = [], {}
    for i, _, html in pages:
        raw = (html or "").encode()
        if len(raw) >= 100 and i is not None:
            groups[raw] = min(i, groups.get(raw, i))
    for i, _, html in pages:
        raw = (html or "").encode()
        least = groups.get(raw)
        again = least is not None and (i is None or i > least)
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", least if again else None))
    return Counter(out)


@pytest.fixture
def table(spark):
    return lambda rows: spark.createDataFrame(rows, "page_id long, url string, html string")


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "6000")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def run(spark, folder):
    return Counter(tuple(r) for r in QUERIES["op12_warc"](spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())


def test_round_trip(spark, table, tmp_dir, clashing):
    clashing(table(PAGES)).withColumns({c: F.lit("x") for c in ("digest", "payload", "first", "value", "file", "split")}).write.parquet(f"{tmp_dir}/pages.parquet")
    assert run(spark, tmp_dir) == brute(PAGES)


def test_round_trip_over_many_splits(spark, table, tmp_dir, small_splits):
    rng = random.Random(2)
    pages = PAGES + [(100 + i, "u", FAKE * rng.randrange(30) + "w" * rng.randrange(900) + "WARC/1." * rng.randrange(3)) for i in range(60)]
    table(pages).coalesce(1).write.parquet(f"{tmp_dir}/pages.parquet")
    assert run(spark, tmp_dir) == brute(pages)


def test_splits_by_shuffle(spark, table, tmp_dir, small_splits, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_SPLITS", 0)
    table(PAGES).coalesce(1).write.parquet(f"{tmp_dir}/pages.parquet")
    assert run(spark, tmp_dir) == brute(PAGES)


def test_empty_table(spark, table, tmp_dir):
    table([]).write.parquet(f"{tmp_dir}/pages.parquet")
    assert not run(spark, tmp_dir)


def test_headers(spark, table, tmp_dir):
    warc.write_archives(table(PAGES), f"{tmp_dir}/w")
    rows = {r["record_id"]: r for r in warc.read_archives(spark, f"{tmp_dir}/w").collect()}
    by = {(k.split(":")[2], r["target_uri"]): r for k, r in rows.items()}
    assert ("13", "http://a/100%20") in by and ("2", "http://a/x%20y%0D%0AWARC-Type:%20no") in by and ("3", None) in by
    revisit = by[("3", None)]
    assert revisit["warc_type"] == "revisit" and rows[revisit["refers_to"]]["payload"] == b"x" * 200
    assert revisit["payload"] == b"" and revisit["payload_digest"] == "sha256:" + hashlib.sha256(b"x" * 200).hexdigest()
    raw = b"".join(open(f, "rb").read() for f in glob.glob(f"{tmp_dir}/w/part*"))
    assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")


def write_raw(folder, parts):
    os.makedirs(folder)
    with open(f"{folder}/a.warc", "wb") as f:
        f.write(b"".join(parts))


def record(i, payload):
    return f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <{i}>\r\ncontent-length:{len(payload)}\r\n\r\n".encode() + payload + b"\r\n\r\n"


def test_foreign_bytes_damage_and_truncation(spark, tmp_dir):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        good = [record(i, bytes(range(256)) + FAKE.encode() * (i % 5)) for i in range(20)]
        ends = np.cumsum([len(g) for g in good])
        cases = {"whole": (good, 20), "cut": ([*good[:-1], good[-1][:-30]], 19), "bad": ([*good[:7], b"junk", *good[7:]], 6), "late": ([b"junk", *good], 0)}
        for name, (parts, n) in cases.items():
            write_raw(f"{tmp_dir}/{name}", parts)
            got = warc.read_archives(spark, f"{tmp_dir}/{name}").collect()
            assert sorted(int(r["record_id"][1:-1]) for r in got) == list(range(n)), name
            assert all(r["payload"] == bytes(range(256)) + FAKE.encode() * (int(r["record_id"][1:-1]) % 5) for r in got)
            if name in ("cut", "bad"):
                _, files = warc.chains(warc.pieces(spark, f"{tmp_dir}/{name}"))
                assert files.select("verified").first()[0] == (int(ends[n - 1]) if n else 0)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_contract_equals_steps():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randrange(1, 12)
        length = np.array([rng.randrange(0, 9) for _ in range(n)])
        span = np.array([rng.choice([0, rng.randrange(1, 40)]) for _ in range(n)])
        headless = rng.random() < 0.5
        total, at, leave, last = warc.contract(length.copy(), span.copy(), headless)
        size = [x + 7 for x in length]
        if headless:
            size[0] -= 7
        start = [sum(size[:i]) for i in range(n)]
        steps = {s: s + int(p) for i, (s, p) in enumerate(zip(start, span)) if p and not (headless and i == 0)}
        assert total == sum(size) and at.tolist() == sorted(steps)
        for a, out, end in zip(at.tolist(), leave.tolist(), last.tolist()):
            while steps[a] in steps and steps[a] < total:
                a = steps[a]
            assert end == a and out == (steps[a] if steps[a] >= total else -1)

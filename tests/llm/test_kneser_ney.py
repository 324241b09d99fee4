"""The language model against a plain Python one."""
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from forgeline.llm import kneser_ney
from forgeline.llm.common import crc_mod, text_of

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(t):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), None]


class Plain:
    def __init__(self, texts):
        self.uni, self.bi = Counter(), Counter()
        for t in texts:
            w = words(t)
            self.uni.update(w)
            self.bi.update(zip(["<s>", *w[:-1]], w))
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        of = lambda c: [sum(x == k for x in c.values()) for k in (1, 2, 3, 4)]
        self.before = Counter(w for _, w in self.bi)
        self.d, self.e = [0, *kneser_ney.discounts(of(self.bi))], [0, *kneser_ney.discounts(of(self.before))]
        self.total, self.kinds = Counter(), defaultdict(lambda: [0, 0, 0, 0])
        for (v, _), c in self.bi.items():
            self.total[v] += c
            self.kinds[v][min(c, 3)] += 1

    def p(self, v, w):
        pairs = max(len(self.bi), 1)
        rest = sum(self.e[min(c, 3)] for c in self.before.values()) / pairs if self.bi else 1.0
        n = self.before.get(w, 0)
        one = (n - self.e[min(n, 3)]) / pairs + rest / (self.v + 1)
        if v not in self.total:
            return one
        c = self.bi.get((v, w), 0)
        return (c - self.d[min(c, 3)]) / self.total[v] + sum(self.d[k] * self.kinds[v][k] for k in (1, 2, 3)) / self.total[v] * one

    def base(self, w):
        return math.log10((self.uni.get(w, 0) + 0.1) / (self.n + 0.1 * (self.v + 1)))


def scored(df):
    return kneser_ney.train_and_score(df.select("doc_id", (crc_mod(df["doc_id"], 10) == 0).alias("held_out"), text_of(df).alias("text")))


def held(i):
    return zlib.crc32(str(i).encode()) % 10 == 0


PAIRS = [(i, " ".join(f"W{(i * 7 + j * j) % 23}" for j in range(i % 17))) for i in range(120)] + [
    (200, None), (201, ""), (202, "The THE the É É\tx y\x0bz"), (203, "a b c"), (203, "a b c"), (204, "x " * 30000), (205, "Unseen words"), (206, "a" * 40000)]


def test_scores_equal_the_plain_model(documents, clashing):
    rows = scored(clashing(documents(PAIRS))).collect()
    model = Plain([t for i, t in PAIRS if not held(i)])
    texts = dict(PAIRS)
    assert sorted(r["doc_id"] for r in rows) == sorted(i for i, _ in PAIRS)
    for r in rows:
        w = words(texts[r["doc_id"]])
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held(r["doc_id"]), len(w), model.n)
        assert r["n_known"] == sum(x in model.uni for x in w)
        assert r["base_score"] == pytest.approx(sum(map(model.base, w)), rel=1e-9)
        assert r["score"] == pytest.approx(sum(math.log10(model.p(a, b)) for a, b in zip(["<s>", *w[:-1]], w)), rel=1e-9)


def test_probabilities_sum_to_one():
    model = Plain([t for _, t in PAIRS])
    for v in ("<s>", "w3", "never"):
        assert sum(model.p(v, w) for w in model.uni) + model.p(v, "nowhere") == pytest.approx(1)


def test_empty_tables_and_no_training_rows(documents):
    assert scored(documents([])).count() == 0
    only = next(i for i in range(1000) if held(i))
    r = scored(documents([(only, "a b")])).first()
    assert (r["train_tokens"], r["n_known"], r["base_score"], r["score"]) == (0, 0, 0.0, 0.0)


def test_counting_merges_over_flushes(documents, monkeypatch, tmp_path):
    monkeypatch.setattr(kneser_ney, "COUNT_BYTES", 1000)
    rows = {r["doc_id"]: r["score"] for r in scored(documents(PAIRS)).collect()}
    monkeypatch.undo()
    again = {r["doc_id"]: r["score"] for r in scored(documents(PAIRS)).collect()}
    assert rows == pytest.approx(again, rel=1e-12)


def test_model_files_round_trip(tmp_path):
    folder = f"file://{tmp_path}"
    arrays = {"word": np.arange(5, dtype="<u8"), "before": np.arange(5, dtype="<i8") * 3}
    kneser_ney.write_arrays(folder, "words-0", arrays)
    back = kneser_ney.map_arrays(folder, "words-0", kneser_ney.WORDS)
    assert all((back[k] == arrays[k]).all() for k in arrays) and isinstance(back["word"], np.memmap)
    assert kneser_ney.map_arrays(folder, "words-1", kneser_ney.WORDS) is None
    kneser_ney.drop_model(folder)
    assert kneser_ney.map_arrays(folder, "words-0", kneser_ney.WORDS) is None


def test_few_mapped_files_answer_alike(spark, tmp_path, monkeypatch):
    texts = [(" ".join(f"w{i * j % 37}" for j in range(20)),) for i in range(50)]
    about = kneser_ney.build(spark.createDataFrame(texts, "text string"), f"file://{tmp_path}", 16)
    data = " ".join(t for t, in texts).encode()
    context, word, _ = kneser_ney.sequences(np.array([0, len(data)]), np.frombuffer(data, np.uint8))
    whole = kneser_ney.Model(about)
    assert whole.file.cache_info().currsize == 0  # nothing is mapped before it is asked for
    expected = whole.probabilities(context, word)
    monkeypatch.setattr(kneser_ney, "MAPS", 2)
    few = kneser_ney.Model(about)
    assert np.array_equal(few.probabilities(context, word), expected) and np.array_equal(few.counts(word), whole.counts(word))
    assert few.file.cache_info().currsize <= 2 < whole.file.cache_info().currsize

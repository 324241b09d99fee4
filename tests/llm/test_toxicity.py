"""Toxicity: the automaton against edit distances, contexts, held-out accuracy."""
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forgeline.llm import toxicity
from forgeline.llm.common import crc_mod
from forgeline.llm.toxicity import Matcher, Trie

TERMS = [("idiot", True, 2.0), ("moron", True, 3.0), ("worthless", True, 4.0), ("ass", True, 1.0), ("achlich", False, 2.5), ("ach", False, 0.5)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain(word):
    """What a word should meet, by comparing it with every term."""
    whole = [(t, w, distance(word, t)) for t, is_whole, w in TERMS if is_whole]
    exact = [(w, Matcher.EXACT) for t, w, d in whole if d == 0]
    if exact:
        return exact[0]
    fuzzy = [(w, Matcher.FUZZY) for t, w, d in whole if d <= (0 if len(t) < 5 else 1 if len(t) < 9 else 2)]
    if fuzzy:
        return max(fuzzy)
    starts = [(len(t), w) for t, is_whole, w in TERMS if not is_whole and word.startswith(t)]
    return (max(starts)[1], Matcher.BEGIN) if starts else None


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text("idotmrnwhlesacx", max_size=11), st.builds(lambda t, i, c, k: (t[:i % (len(t) + 1)] + c + t[i % (len(t) + 1) + k:]), st.sampled_from([t for t, _, _ in TERMS]), st.integers(0, 9), st.text("idotaxs", max_size=2), st.integers(0, 2))))
def test_automaton_equals_edit_distance(word):
    if word:
        assert MATCHER._run(word) == plain(word)


MATCHER = Matcher(Trie(TERMS))


def test_look_alikes_marks_and_case():
    matcher = Matcher(Trie(TERMS))
    assert matcher.match("1d10t!!")[1] == Matcher.EXACT and matcher.match('"moron"')[1] == Matcher.EXACT
    assert matcher.match("wortless")[1] == Matcher.FUZZY and matcher.match("clown") is None


def test_context_separates_quotation_from_abuse():
    matcher = Matcher(Trie(TERMS))
    abuse, quote, said, neither = (toxicity.text_features(t, matcher)[-1] for t in ("you are an idiot", 'the word "idiot" was printed', "he said idiot", "an idiot went by"))
    assert abuse > neither == 0 > quote and said < 0


def corpus(n=600):
    rng = random.Random(2)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "tu", "re") for b in ("pan", "sol", "ter", "vin", "gud")]
    docs, toxic = [], {}
    for i in range(n):
        toxic[i] = rng.random() < 0.25
        w = [rng.choice(words) for _ in range(rng.randrange(5, 60))]
        if toxic[i]:
            for _ in range(rng.randrange(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(("blockhead", "nitwit", "blokhead", "N1twit!")))
        docs.append((i, " ".join(w)))
    return docs, toxic


def test_held_out_accuracy_and_unseen_labels(documents, spark, clashing):
    docs, toxic = corpus()
    held = crc_mod(F.col("doc_id"), 5) == 0
    table = lambda flip: spark.createDataFrame([(i, 1, int(t) if not flip else 1 - int(t)) for i, t in toxic.items()], "doc_id long, quality int, toxic int")
    df = clashing(documents(docs))
    model = toxicity.fit(toxicity.training_sample(df, table(False), held))
    # labels of held-out rows don't matter
    mixed = table(False).where(~held).union(table(True).where(held))
    other = toxicity.fit(toxicity.training_sample(df, mixed, held))
    assert sorted(model[0]) == sorted(other[0])
    rows = toxicity.score(df.select("doc_id", held.alias("h"), "text"), model, "doc_id", "h").collect()
    out = [r for r in rows if r["h"]]
    assert len(rows) == len(docs) and len(out) > 50
    assert sum((r["score"] >= 0.5) == toxic[r["doc_id"]] for r in out) >= 0.97 * len(out)


def test_defined_cases(documents, spark):
    docs, toxic = corpus(200)
    labels = spark.createDataFrame([(i, 1, int(t)) for i, t in toxic.items()] + [(0, 1, 0), (None, 1, 1), (1, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(toxicity.training_sample(documents(docs), labels, F.lit(False)))
    pairs = [(1, ""), (2, "same nitwit"), (2, "same nitwit"), (None, "x"), (3, "calm " * 50000), (4, "\n\t")]
    rows = toxicity.score(documents(pairs).select("doc_id", "text"), model, "doc_id").collect()
    assert len(rows) == len(pairs) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 2}) == 1
    none = spark.createDataFrame([], labels.schema)
    assert toxicity.fit(toxicity.training_sample(documents(docs), none, F.lit(False))) is None
    assert [r["score"] for r in toxicity.score(documents([(1, "a")]).select("doc_id", "text"), None, "doc_id").collect()] == [0.0]
    assert toxicity.score(documents([]).select("doc_id", "text"), model, "doc_id").count() == 0


def test_of_beginnings_the_shortest_without_more_false_hits_stay():
    from forgeline.llm.toxicity import shortest_beginnings
    found = {"tra*": (5, 1.0), "tras*": (2, 1.5), "trash*": (2, 1.5), "trash": (1, 2.0), "trashy": (0, 2.0), "idi*": (0, 3.0), "idiot*": (0, 3.0)}
    assert sorted(shortest_beginnings(found)) == [("idi", False, 3.0), ("tra", False, 1.0), ("tras", False, 1.5), ("trash", True, 2.0), ("trashy", True, 2.0)]

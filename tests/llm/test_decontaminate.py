"""Benchmark decontamination: exact, re-parameterised and clean cases."""
import numpy as np
import pytest

from forgeline.llm import decontaminate
from forgeline.llm.tokens import blocks

ITEMS = [
    (1, "Alice has 12 apples and gives 5 apples to her brother Tom; how many apples does Alice keep now?"),
    (2, "A train travels 300 km in 4 hours at constant speed before it stops, so what was the speed of that train?"),
    (3, "The quick brown fox jumps over the lazy dog while a grey cat sleeps under the old tree near the river."),
    (4, "short item here now"), (5, None), (6, "two words"), (3, "The quick brown fox jumps over the lazy dog while a grey cat sleeps under the old tree near the river."),
]
FILL = "some plain filler text that stands around the passage and means nothing at all"
DOCS = {
    1: f"{FILL} {ITEMS[2][1]} {FILL}", 2: f"{FILL}. Alice has 31 apples and gives 7 apples to her brother Bob; how many apples does Alice keep now? {FILL}",
    3: f"{FILL}. A train travels 120 miles in 9 minutes at constant speed before it stops, so what was the speed of that train?",
    4: FILL, 5: "", 6: None, 7: f"| {ITEMS[2][1].upper()} |", 8: ITEMS[2][1].replace(" ", "%%% "), 9: "The quick brown fox jumps over the lazy dog. " + FILL,
    10: f"{FILL}. short item here now and more", 11: f"{FILL} " * 3000 + ITEMS[2][1],
}


@pytest.fixture
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_found_and_clean(documents, items, clashing):
    docs = clashing(documents([*DOCS.items(), (None, DOCS[1]), (1, DOCS[1]), (1, FILL)]))
    rows = decontaminate.report(docs, clashing(items)).collect()
    got = {r["doc_id"]: sorted(r["item_ids"]) for r in rows if r["doc_id"] not in (None, 1)}
    assert got == {2: [1], 3: [2], 4: [], 5: [], 6: [], 7: [3], 8: [3], 9: [], 10: [4], 11: [3]}
    assert sorted((str(r["doc_id"]), r["contaminated"]) for r in rows if r["doc_id"] in (None, 1)) == [("1", False), ("1", True), ("1", True), ("None", True)]
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 5, 6, 9]


def test_inconsistent_slots_are_not_counted(documents, spark):
    item = "we know that Alice has 12 apples and that later on Alice gives 12 apples to the kind man called Tom today"
    same, other = ((f"we know that {a} has {m} apples and that later on {b} gives {n} apples to the kind man called Jim today") for a, m, b, n in (("Bob", 31, "Bob", 31), ("Bob", 31, "Dora", 7)))
    rows = {r["doc_id"]: r for r in decontaminate.report(documents([(1, same), (2, other), (3, item)]), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert (rows[1]["best_coverage"], rows[3]["best_coverage"]) == (1.0, 1.0)
    assert not rows[2]["contaminated"]


def test_names_and_copies_at_sentence_beginnings(documents, spark):
    tom = "Tom has 5 apples. Tom buys 3 more apples. How many apples has Tom?"
    tides = "What causes the red tides in warm seas"
    docs = {1: f"{FILL}. " + tom.replace("Tom", "Ann"), 2: "Ann has 5 apples. Bob buys 3 more apples. How many apples has Jim?", 3: f"{FILL} question {tides} and why", 4: tom.lower(), 5: tides.title(), 6: f"{FILL}. {FILL}"}
    found = decontaminate.report(documents(docs.items()), spark.createDataFrame([(1, tom), (2, tides)], "item_id long, text string")).collect()
    assert {r["doc_id"]: r["item_ids"] for r in found} == {1: [1], 2: [], 3: [2], 4: [1], 5: [2], 6: []}


def test_verbatim_runs_short_and_unspaced_items(documents, spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    chinese = "小明有五个苹果，他给了妹妹两个，请问现在还剩几个苹果？"
    items = [(1, " ".join(words)), (2, "What is 17 * 23 + 5?"), (3, chinese), (4, "Name Paris"), (5, "12 * 7 = 84")]
    docs = {1: f"{FILL} {' '.join(words[50:63])} {FILL}", 2: f"{FILL} {' '.join(words[50:62])} {FILL}", 3: f"{FILL} what is 17 * 23 + 5 {FILL}", 4: f"{FILL} what is 17 * 24 + 5 {FILL}",
            5: f"我们知道{chinese}答案是三个", 6: "小红有五本书。", 7: f"{FILL}\nName Paris.\n{FILL}", 8: f"{FILL} name Paris {FILL}", 9: f"{FILL}. 12 * 7 = 84", 10: f"{FILL}. 12 * 7 = 85"}
    found = decontaminate.report(documents(docs.items()), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r["doc_id"]: r["item_ids"] for r in found} == {1: [1], 2: [], 3: [2], 4: [], 5: [3], 6: [], 7: [4], 8: [], 9: [5], 10: []}
    assert {r["doc_id"] for r in found if r["contaminated"]} == {1, 3, 5, 7, 9}


def test_empty_tables(documents, items, spark):
    assert decontaminate.report(documents([]), items).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r["contaminated"] for r in decontaminate.report(documents([(1, "x y z")]), none).collect()] == [False]


def words_of(text):
    import pyarrow as pa
    (_, offsets, data), = blocks(pa.array([text]))
    h, form, start, end, row = decontaminate.canonical(offsets, data)
    return [("word", "NUM", "UNIT", "NAME")[f] if f else data[a:b].tobytes().decode().lower() for f, a, b in zip(form, start, end)]


def test_canonical_form():
    assert words_of("The 3.5 kg bag, of Élan cost 1,200 dollars. Élan said: It is 5km") == "the NUM UNIT bag of NAME cost NUM UNIT élan said it is NUM UNIT".split()
    assert words_of("USA kg x") == ["usa", "kg", "x"]


def test_windows_do_not_cross_rows():
    import pyarrow as pa
    (_, offsets, data), = blocks(pa.array(["a b c d", None, "e f g h"]))
    h, form, _, _, row = decontaminate.canonical(offsets, data)
    assert list(decontaminate.windows(h, form, row, 4)[1]) == [0, 4] and np.unique(row).tolist() == [0, 2]

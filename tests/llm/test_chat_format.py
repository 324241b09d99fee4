"""Chat formatting: folding, exact round trips, the mask."""
from hypothesis import given, settings
from hypothesis import strategies as st

from forgeline.llm import chat_format

LOG = "conv_id long, seq long, op string, target string, role string, text string"
NASTY = ["\\### Assistant: </turn> ok", "\\", "\\\\", "\\e", "\\\\e", "</turn", ">", "### ", "##", ": ", "a</turn>\n### user: b", "", None, "é😀: \n", "\\h\\c\\\\</turn>\\"]


def rendered(spark, turns):
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    return {r["conv_id"]: r for r in chat_format.read_back(chat_format.render(chat_format.turns_to_events(df))).collect()}


def check(rows, turns):
    want = {}
    for c, t, r, x in turns:
        want.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    assert set(rows) == set(want)
    for c, w in want.items():
        w = [(r, x) for _, _, r, x in sorted(w)]
        assert [tuple(t) for t in rows[c]["turns"]] == w
        assert rows[c]["loss_text"] == "".join(x for r, x in w if r == "assistant")
        assert rows[c]["formatted"].count("</turn>") == len(w) == rows[c]["n_turns"]


def test_round_trip_of_control_strings(spark):
    turns = [(1, i, "assistant" if i % 2 else "user", x) for i, x in enumerate(NASTY)] + [(2, i, x, y) for i, (x, y) in enumerate(zip(NASTY, reversed(NASTY)))]
    turns += [(None, 0, "user", "null id"), (3, None, "user", "null turn"), (3, 1, "assistant", "x"), (4, 1, "user", "same"), (4, 1, "user", "same"), (4, 1, "user", "tie"), (5, 0, "user", "long " * 40000)]
    check(rendered(spark, turns), turns)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["\\", "#", " ", "<", "/", "turn", ">", "e", "h", "c", ":", "\n", "### ", "</turn>"]), max_size=8).map("".join), min_size=1, max_size=6))
def test_round_trip_property(spark, texts):
    turns = [(1, i, "assistant" if i % 2 else "user", x) for i, x in enumerate(texts)]
    check(rendered(spark, turns), turns)


def test_folds_deltas_edits_and_regenerations(spark):
    log = [(1, 0, "message", "u", "user", "hi"), (1, 1, "message", "a", "assistant", None), (1, 2, "delta", "a", None, "he"), (1, 3, "delta", "a", None, "llo"),
           (1, 4, "regenerate", "a", None, None), (1, 5, "delta", "a", None, "good "), (1, 7, "delta", "a", None, "day"), (1, 8, "message", "b", "user", "x"), (1, 9, "edit", "b", None, "y"),
           (1, 10, "delta", "orphan", "tool", "alone"), (2, 0, "message", "u", "user", "one"), (2, 1, "message", "u", "user", "two"), (2, 2, "delta", "u", None, "!")]
    rows = {r["conv_id"]: r for r in chat_format.read_back(chat_format.render(spark.createDataFrame(log, LOG).repartition(4))).collect()}
    assert [tuple(t) for t in rows[1]["turns"]] == [("user", "hi"), ("assistant", "good day"), ("user", "y"), ("tool", "alone")]
    assert rows[1]["loss_text"] == "good day"
    assert [tuple(t) for t in rows[2]["turns"]] == [("user", "one"), ("user", "two!")]


def test_empty_log_and_no_python(spark):
    empty = spark.createDataFrame([], LOG)
    out = chat_format.read_back(chat_format.render(empty))
    assert out.count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

"""Chat formatting by event-sourced reconstruction, in DataFrame functions only.

A log holds events (conv_id, seq, op, target, role, text).  ``message`` opens a
message under the id ``target``; ``delta`` appends its text; ``edit`` replaces
the text so far; ``regenerate`` throws the text so far away and starts anew with
its own.  Events are folded in order of seq (ties: message, regenerate, edit,
delta, then text).  Several ``message`` events under one target are several
messages; later events of that target belong to the last.  An event before any
``message`` of its target opens a message itself.

Folding is dealt by (conversation, message); only the finished messages are
gathered by conversation, because a rendered conversation is one value.

Rendering: ``### role: text</turn>`` and a line feed per message.  Control
strings inside roles and texts are escaped reversibly, so ``</turn>`` and
``### `` occur in the output only as marks.

Defined cases: NULL text or role is empty; a NULL seq sorts first; NULL conv_id
is a conversation of its own; repeated rows are repeated turns; an empty log
gives no rows; extra columns are ignored."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, END = "### ", "</turn>"
SEPARATOR = ": "
OPS = ("message", "regenerate", "edit", "delta")


def escape(c: Column) -> Column:
    """Backslash first, then each control string, so that no mark is left."""
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    c = F.replace(c, F.lit(END), F.lit("\\e"))
    c = F.replace(c, F.lit(HEAD), F.lit("\\h"))
    return F.replace(c, F.lit(SEPARATOR), F.lit("\\c"))


def unescape(c: Column) -> Column:
    """Inverse of ``escape``: between doubled backslashes, read from the left,
    every other backslash begins a control string."""
    def plain(part: Column) -> Column:
        for code, mark in (("\\e", END), ("\\h", HEAD), ("\\c", SEPARATOR)):
            part = F.replace(part, F.lit(code), F.lit(mark))
        return part

    return F.array_join(F.transform(F.split(c, r"\\\\", -1), plain), "\\")


def turns_to_events(turns: DataFrame) -> DataFrame:
    """A table of finished turns (conv_id, turn, role, text) as a log."""
    return turns.select("conv_id", F.col("turn").cast("long").alias("seq"), F.lit("message").alias("op"),
                        F.col("turn").cast("string").alias("target"), "role", "text")


def fold_messages(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, seq, target, nth, role, text."""
    rank = F.array_position(F.array(*map(F.lit, OPS)), F.coalesce(F.col("op"), F.lit("delta")))
    one = F.struct(F.col("seq"), rank.alias("rank"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("role", F.lit("")).alias("role"))
    log = events.groupBy("conv_id", "target").agg(F.array_sort(F.collect_list(one)).alias("log"))
    n = F.size("log")
    opens = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(F.col("log"), i)["rank"] == 1))
    log = log.withColumn("opens", opens)

    def message(start: Column, k: Column) -> Column:
        stop = F.coalesce(F.get(F.col("opens"), k + 1), n)
        part = F.slice("log", start + 1, stop - start)
        resets = F.filter(F.sequence(F.lit(0), F.size(part) - 1), lambda i: (i == 0) | (F.get(part, i)["rank"] < 4))
        last = F.element_at(resets, -1)
        text = F.array_join(F.transform(F.slice(part, last + 1, F.size(part) - last), lambda e: e["text"]), "")
        return F.struct(F.get(F.col("log"), start)["seq"].alias("seq"), k.alias("nth"), F.get(F.col("log"), start)["role"].alias("role"), text.alias("text"))

    return log.select("conv_id", "target", F.inline(F.transform("opens", message)))


def render(events: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss_spans.

    ``loss_spans`` are the places (code points, end exclusive) of the texts of
    ``loss_role`` in ``formatted``."""
    body = escape(F.col("text"))
    head = F.concat(F.lit(HEAD), escape(F.col("role")), F.lit(SEPARATOR))
    order = ["seq", "role", "text", "target", "nth"]
    told = fold_messages(events).select("*", F.concat(head, body, F.lit(END + "\n")).alias("line"), F.char_length(head).cast("long").alias("skip"), F.char_length(body).cast("long").alias("size"))
    before = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = told.withColumn("at", F.coalesce(F.sum(F.char_length("line").cast("long")).over(before), F.lit(0)) + F.col("skip"))
    span = F.when(F.col("role") == loss_role, F.struct(F.col("at").alias("start"), (F.col("at") + F.col("size")).alias("end")))
    lines = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.col("at"), F.col("line"), span.alias("loss")))).alias("lines"))
    return lines.select("conv_id", F.size("lines").cast("long").alias("n_turns"),
                        F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("formatted"),
                        F.filter(F.transform("lines", lambda x: x["loss"]), lambda x: x.isNotNull()).alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse rendered conversations: adds ``turns`` (role, text) and
    ``loss_text``, the unescaped text under the loss mask."""
    parts = F.split("formatted", END + "\n", -1)
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def turn(p: Column) -> Column:
        bare = F.substring(p, len(HEAD) + 1, 2**31 - 1)
        role = F.substring_index(bare, SEPARATOR, 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substr(bare, F.char_length(role) + len(SEPARATOR) + 1)).alias("text"))

    masked = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int"))))
    return formatted.withColumns({"turns": F.transform(parts, turn), "loss_text": F.array_join(masked, "")})

r"""Secret scan with multipart credential linking, in DataFrame functions only.

Strong parts are reported wherever they stand:

- ``assign``  a keyword assignment whose value has 8 or more characters,
- ``access``  an access identifier ``AKIA...`` of 16 or more characters,
- ``hex``     a run of 32 or more lower-case hexadecimal digits.

Weak parts are reported only when a complementary part stands in scope, that is
when the weak part begins within ``SCOPE`` code points of the other part in the
same document:

- ``key40``    a bare 40-character base64 token, next to an ``access`` part,
- ``login``    a user/login/pass assignment of any value, next to an ``endpoint``,
- ``endpoint`` a service URL, next to a ``login``, ``assign`` or ``short`` part,
- ``short``    a keyword assignment whose value has fewer than 8 characters, next to an
  ``endpoint`` or ``access`` part.

A weak part that overlaps a strong one is the same credential and isn't
reported twice.

Positions come from one anchored pattern per kind: ``\G(.*?)(part)`` yields the
text before every match, and the running sum of lengths is its place; this is the
leftmost non-overlapping match, in code points.  The interval join deals parts by
(document, scope cell); weak parts are kept by a left-semi join, so pairs are
never emitted, and a cell holds at most the parts of a few hundred characters.

Defined cases: NULL text is empty; an empty text has no spans and the digest of
the empty string; repeated rows each get their own row; ties sort by start,
kind, end; NULL doc_id is kept; an empty table gives no rows; extra columns are
ignored."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgeline.llm.common import cut, text_of

SCOPE = 256
VALUE = r"[A-Za-z0-9+/_.=-]+"
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
KINDS = ("assign", "access", "hex", "key40", "login", "endpoint", "short")  # also the order of ties
PATTERNS = {
    "assign": f"{ASSIGN}({VALUE})",
    "access": r"(AKIA[A-Z0-9]+)",
    "hex": r"([0-9a-f]{32,})",
    "key40": r"((?<![A-Za-z0-9/+])[A-Za-z0-9/+]{40}(?![A-Za-z0-9/+=]))",
    "login": r"""(?i:user(?:name)?|login|pwd|pass)["']?\x20*[:=]\x20*["']?([^\s"',;]+)""",
    "short": f"{ASSIGN}({VALUE})",
    "endpoint": r"""((?i:https?|ftp|ssh|jdbc|postgres|mysql|mongodb|redis|amqp)://[^\s"'<>]+)""",
}
LEAST = {"assign": 8, "access": 16, "hex": 32}  # characters of the value
MOST = {"short": 7}
STRONG = ("assign", "access", "hex")
COMPLEMENTS = {"key40": ("access",), "login": ("endpoint",), "endpoint": ("login", "assign", "short"), "short": ("endpoint", "access")}
SPAN = "array<struct<start:bigint,rank:int,end:bigint>>"


def find_spans(text: Column, kind: str) -> Column:
    """Places of one kind in a text: array of (start, rank of kind, end)."""
    pattern = rf"(?s)\G(.*?)({PATTERNS[kind]})"
    pick = lambda group: F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    lengths = lambda group: F.transform(pick(group), lambda s: F.char_length(s).cast("bigint"))
    found = F.arrays_zip(lengths(1).alias("gap"), lengths(2).alias("whole"), lengths(3).alias("value"))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(acc: Column, m: Column) -> Column:
        begin = acc["at"] + m["gap"]
        end = begin + m["whole"]
        span = F.struct(begin.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"))
        fits = m["value"] >= LEAST.get(kind, 1)
        fits = fits & (m["value"] <= MOST[kind]) if kind in MOST else fits
        more = F.when(fits, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), more.alias("spans"))

    spans = F.aggregate(found, start, step, lambda acc: acc["spans"])
    # texts without a match, most of them, are read once
    return F.when(F.size(pick(2)) > 0, spans).otherwise(F.array().cast(SPAN))


def spell(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_parts(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, content key, strong spans and weak candidate spans per row."""
    t = text_of(docs, text)
    rows = docs.select(docs[id_col].alias("doc_id"), t.alias("text"))
    rows = rows.select("doc_id", "text", *[find_spans(F.col("text"), k).alias(k) for k in KINDS])
    base = F.array_sort(F.concat(*STRONG))
    weak = F.filter(F.concat(*COMPLEMENTS), lambda w: ~F.exists(F.col("base"), lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
    return (rows.withColumn("base", base).withColumn("weak", weak)
            .select("doc_id", F.when(F.size("weak") > 0, F.sha2("text", 256)).alias("content"), "base", "weak"))


def link_weak(parts: DataFrame) -> DataFrame:
    """Weak spans with a complementary part in scope: doc_id, content, linked."""
    open_ = parts.where(F.size("weak") > 0)
    names = F.array(*map(F.lit, KINDS))
    weak = open_.select("doc_id", "content", F.explode("weak").alias("w")).select("doc_id", "content", "w", F.floor(F.col("w.start") / SCOPE).alias("cell"), F.get(names, F.col("w.rank")).alias("kind"))
    others = open_.select("doc_id", "content", F.explode(F.concat("base", "weak")).alias("p")).withColumn("needs", F.get(names, F.col("p.rank")))
    low, high = F.col("p.start") - SCOPE, F.col("p.end") + SCOPE
    others = others.select("doc_id", "content", "needs", low.alias("low"), high.alias("high"), F.explode(F.sequence(F.floor(low / SCOPE), F.floor(high / SCOPE))).alias("cell"))
    wants = F.create_map(*[x for k, v in COMPLEMENTS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    weak = weak.withColumn("needs", F.explode(F.element_at(wants, F.col("kind"))))
    a, b = weak.alias("a"), others.alias("b")
    scope = ((F.col("a.content") == F.col("b.content")) & F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.cell") == F.col("b.cell"))
             & (F.col("a.needs") == F.col("b.needs")) & F.col("a.w.start").between(F.col("b.low"), F.col("b.high")))
    return a.join(b, scope, "left_semi").groupBy("doc_id", "content").agg(F.collect_set("w").alias("linked"))


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, base and all (arrays of start, rank, end;
    the rank is the place in KINDS), sorted."""
    parts = cut(scan_parts(docs, id_col, text))
    linked = link_weak(parts).select(F.col("doc_id").alias("_doc"), F.col("content").alias("_content"), "linked")
    both = parts.join(linked, (parts["content"] == linked["_content"]) & parts["doc_id"].eqNullSafe(linked["_doc"]), "left")
    every = F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast(SPAN))))
    return both.select("doc_id", "base", every.alias("spans"))

"""The registered queries opN_<name>: each reads its whole table through its
operator and derives the columns of its contract."""
from __future__ import annotations

import string
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.llm import chat_format, decontaminate, exact_dedup, hard_negatives, html_extract, importance, jaccard_join, kneser_ney, merkle, packing, secret_scan, toxicity, warc
from forgeline.llm.common import crc_mod, read, text_of
from forgeline.llm.registry import ORACLE, QUERIES, query  # noqa: F401
from forgeline.session import ensure_checkpoint_dir


@query("op1_secret_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = secret_scan.scan(read(spark, sf_dir, "documents"))
    count = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")
    return spans.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(secret_scan.spell(F.col("base")), 256).alias("base_sha256"), secret_scan.spell(F.col("spans")).alias("spans"))


OP6_SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER w = 1 AS kept, h AS text_sha256
FROM t WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id)
"""


@query("op6_exact_dedup", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(read(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, replace(replace(replace(replace(role, '\', '\\'), '</turn>', '\e'), '### ', '\h'), ': ', '\c') AS er,
                replace(replace(replace(replace(text, '\', '\\'), '</turn>', '\e'), '### ', '\h'), ': ', '\c') AS et FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(4 + length(er) + 2 + length(et) + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op9_chat_formatting", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit("\\### Assistant: </turn> ok").alias("text"))
    back = chat_format.read_back(chat_format.render(chat_format.turns_to_events(turns.unionByName(probe))))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))


@query("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


@query("op3_lm_scoring")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return kneser_ney.train_and_score(docs.select("doc_id", (crc_mod(docs["doc_id"], 10) == 0).alias("held_out"), text_of(docs).alias("text")))


@query("op5_html_extraction")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(read(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op4_benchmark_decontamination")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op10_quality_classifier")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = importance.select(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return told.select("doc_id", "weight", "gumbel_key", "kept")


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    model = toxicity.fit(toxicity.training_sample(docs, read(spark, sf_dir, "labels"), held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), text_of(docs).alias("text"))
    told = toxicity.score(rows, model, "doc_id", "held_out")
    return told.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


OP7_SQL = r"""
WITH RECURSIVE t AS (SELECT doc_id, [x FOR x IN string_split_regex(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS g FROM t),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
l AS (SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
r AS (SELECT doc_id, doc_id AS c FROM s UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.c = l.x)
SELECT s.doc_id, CAST(len(any_value(s.g)) AS BIGINT) AS n_shingles, min(r.c) AS component_id
FROM s JOIN r ON s.doc_id = r.doc_id GROUP BY s.doc_id
"""


@query("op7_ngram_jaccard_join", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read(spark, sf_dir, "documents"))


def _merkle_levels(name: str, levels: int) -> str:
    """CTEs of a forest of (t, i, d, n) nodes: runs ``name``_r0.. of each level."""
    return ",\n".join(f"""{name}_r{k} AS (SELECT t, i // 16 AS i, string_agg(d, '' ORDER BY i) AS run, any_value(n) AS n FROM {name}_l{k} GROUP BY t, i // 16),
{name}_l{k + 1} AS (SELECT t, i, CASE WHEN n > 1 THEN sha256(run) ELSE run END AS d, (n + 15) // 16 AS n FROM {name}_r{k})""" for k in range(levels))


def _merkle_steps(source: str, name: str, t: str, i: str, levels: int) -> tuple[str, str]:
    """CTEs that fold ``f`` and lengthen the proof ``p`` level by level."""
    out, last = [], source
    for k in range(levels):
        place = f"CAST({i} // {16 ** k} % 16 AS BIGINT)"
        left, right = f"left(r.run, 64 * {place})", f"substr(r.run, 64 * {place} + 65)"
        out.append(f"""{source}_{name}{k} AS (SELECT s.* EXCLUDE (f, p), CASE WHEN r.n > 1 THEN sha256({left} || f || {right}) ELSE f END AS f,
  CASE WHEN r.n > 1 THEN p || {left} || {right} ELSE p END AS p FROM {last} s JOIN {name}_r{k} r ON r.t = {t} AND r.i = {i} // {16 ** (k + 1)})""")
        last = f"{source}_{name}{k}"
    return ",\n".join(out), last


def _merkle_sql(levels: int = 6, source_levels: int = 4) -> str:
    """SQL for up to 16^levels leaves a source and 16^source_levels sources."""
    field = lambda x: f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || {x}, '-')"
    leaf = lambda text: f"sha256({' || '.join(map(field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"
    crc = """xor(4294967295, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
      lambda a, b: list_reduce(range(8), lambda v, j: xor(v >> 1, 3988292384 * (v & 1)), xor(a, b)), 4294967295))"""
    own, folded = _merkle_steps("x", "a", "s.t", "s.i", levels)
    top, done = _merkle_steps(folded, "b", "''", "s.j", source_levels)
    return f"""
WITH d AS (SELECT doc_id, coalesce('+' || source, '') AS t, {leaf('text')} AS leaf,
  CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN {leaf(f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')")} ELSE {leaf('text')} END AS told FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY t) AS n FROM d),
a_l0 AS (SELECT t, i, leaf AS d, n FROM o),
{_merkle_levels('a', levels)},
s AS (SELECT t, d AS subroot, row_number() OVER (ORDER BY t) - 1 AS j, count(*) OVER () AS n FROM a_l{levels}),
b_l0 AS (SELECT '' AS t, j AS i, subroot AS d, n FROM s),
{_merkle_levels('b', source_levels)},
x AS (SELECT o.doc_id, o.t, o.i, o.leaf, s.j, s.subroot, o.told AS f, '' AS p FROM o JOIN s ON o.t = s.t),
{own},
{top}
SELECT doc_id, leaf, subroot, b_l{source_levels}.d AS root, sha256(p) AS proof_sha256, f AS folded_root, f = b_l{source_levels}.d AS verified FROM {done}, b_l{source_levels}
"""


@query("op11_merkle_manifest", _merkle_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    leaf = lambda text: merkle.leaf_digest(docs["doc_id"], docs["source"], docs["lang"], docs["n_chars"], text)
    lower = F.translate(docs["text"], string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.when(F.crc32(docs["doc_id"].cast("string").cast("binary")) % 5 == 0, leaf(lower))
    rows = merkle.manifest(docs, docs["source"], docs["doc_id"], leaf(docs["text"]), {"doc_id": docs["doc_id"], "told": tampered})
    folded = rows.withColumn("folded_root", merkle.fold(F.coalesce("told", "leaf"), F.col("proof")))
    return folded.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


OP12_SQL = """
WITH t AS (SELECT page_id, strlen(coalesce(html, '')) AS bytes, sha256(coalesce(html, '')) AS digest FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS least FROM t),
r AS (SELECT *, bytes >= 100 AND least IS NOT NULL AND (page_id IS NULL OR page_id > least) AS again FROM g)
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, digest AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN least END AS refers_to FROM r
"""


@query("op12_warc", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(read(spark, sf_dir, "pages"), folder)
    told = warc.resolve(warc.read_archives(spark, folder))
    page = lambda name: F.try_to_number(F.regexp_extract(name, r"^<urn:page:(-?[0-9]+):", 1), F.lit("S" + "9" * 19)).cast("long")
    return told.select(page("record_id").alias("page_id"), "payload_bytes", F.col("payload_sha256").alias("payload_digest"), F.col("warc_type").alias("record_type"), page("refers_to").alias("refers_to"))


OP13_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, v.vec_id AS other, a.label = v.label AS same, CAST(list_inner_product(a.q, v.q) AS BIGINT) AS score
      FROM v a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


@query("op13_hard_negatives", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    label = F.when(rows["vec_id"] % 7 == 0, (rows["label"] + 1) % 10).otherwise(rows["label"])
    return hard_negatives.mine(rows, rows["vec_id"], rows["embedding"], label, rows["vec_id"] % 100 == 0)

"""Toxicity scores from a fuzzy lexicon with context windows.

Lexicon: words and word beginnings whose share of toxic training documents is far
above their share of the others, learnt in Spark from at most LABELLED labelled
documents (those with the smallest hashes of their ids, a parameter); all terms
whose z statistic and log ratio reach the limits, each with its log ratio.

Matching: the terms stand in a trie.  A word runs through the intersection of that
trie with a Levenshtein automaton: a state is the set of (trie node, edits so far)
a prefix of the word can have reached, and the transitions met are kept, so after
a while a word costs one look-up per letter.  Whole words may have one edit from
five letters and two from nine; word beginnings must be exact.  Words are also
read with look-alike digits and signs as letters.

Context: the words around a hit tell abuse (the second person) from quotation (an
open quotation mark, a reporting verb).  Plain hits, hits addressed to someone and
quoted hits are separate features of a logistic model fitted on the same sample.

Labels of rows that are held out are never read; labels, language, source and id
are no inputs of a score.

Defined cases: NULL and empty texts get the score of a text without hits; repeated
rows score alike; a repeated label row counts once (the larger label); without
labels every score is 0; an empty table gives no rows; extra columns are ignored."""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.llm.common import cut, text_of

LABELLED = 8_000
LEAST_Z = 5.0
LEAST_RATIO = math.log(4)
BEGINNINGS = range(3, 9)
MEMO_WORDS = 500_000
WINDOW = 6
# fixed: words of the second person, reporting verbs, quotation marks, look-alikes
ADDRESS = frozenset("you your you're youre yours yourself u ur du dich dir dein deine ihr euch tu te toi vous votre tes eres usted ustedes vos".split())
REPORTING = frozenset("said says say called calls wrote writes quote quoted quoting quotes term word slur insult dit disait appelle sagte sagt nannte schrieb dijo dice llama".split())
QUOTES = "\"“”«»„‟"
LOOKALIKE = str.maketrans("013457@$!", "oieastasi")


class Trie:
    """Terms with weights; ``whole`` terms end a word, others begin one."""

    def __init__(self, terms: list[tuple[str, bool, float]]):
        self.children: list[dict[str, int]] = [{}]
        self.whole: dict[int, tuple[float, int]] = {}  # node -> weight, edits allowed
        self.start: dict[int, float] = {}
        for term, whole, weight in terms:
            node = 0
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                node = self.children[node][c]
            if whole:
                self.whole[node] = (weight, 0 if len(term) < 5 else 1 if len(term) < 9 else 2)
            else:
                self.start[node] = weight


class Matcher:
    """The trie intersected with Levenshtein automata, determinised on the way."""

    EXACT, FUZZY, BEGIN = 1, 2, 3

    def __init__(self, trie: Trie, edits: int = 2):
        self.trie, self.edits = trie, edits
        self.room = [0] * len(trie.children)  # edits that some term at or below a node allows
        for node in range(len(trie.children) - 1, -1, -1):
            own = trie.whole.get(node, (0, 0))[1]
            self.room[node] = max([own, *(self.room[c] for c in trie.children[node].values())])
        self.ids: dict = {}
        self.moves: list[dict[str, int]] = []
        self.states: list = []
        self.ends: list = []
        self.first = self._state(self._skips({0: 0}), 0.0)
        self.memo: dict[str, tuple[float, int] | None] = {}

    def _skips(self, reached: dict[int, int]) -> dict[int, int]:
        """Close a set under letters that the word leaves out."""
        todo = list(reached.items())
        while todo:
            node, e = todo.pop()
            for child in self.trie.children[node].values():
                if e + 1 <= min(self.edits, self.room[child]) and e + 1 < reached.get(child, 99):
                    reached[child] = e + 1
                    todo.append((child, e + 1))
        return reached

    def _state(self, reached: dict[int, int], begun: float) -> int:
        key = (frozenset(reached.items()), begun)
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append((reached, begun))
            self.moves.append({})
            best = (begun, self.BEGIN) if begun else None
            for node, e in reached.items():
                if node in self.trie.whole:
                    weight, allowed = self.trie.whole[node]
                    if e <= allowed:
                        found = (weight, self.EXACT if e == 0 else self.FUZZY)
                        if best is None or found[1] == self.EXACT or best[1] == self.FUZZY and weight > best[0]:
                            best = found
            self.ends.append(best)
        return self.ids[key]

    def _move(self, state: int, c: str) -> int:
        reached, begun = self.states[state]
        after: dict[int, int] = {}

        def reach(node: int, e: int) -> None:
            if e <= min(self.edits, self.room[node]) and e < after.get(node, 99) or e == 0:
                after[node] = e

        for node, e in reached.items():
            reach(node, e + 1)  # a letter too many
            for letter, child in self.trie.children[node].items():
                reach(child, e if letter == c else e + 1)
        for node, e in after.items():
            if e == 0 and node in self.trie.start:
                begun = self.trie.start[node]  # the longest beginning so far
        to = self._state(self._skips(after), begun)
        self.moves[state][c] = to
        return to

    def _run(self, word: str) -> tuple[float, int] | None:
        state = self.first
        for c in word:
            to = self.moves[state].get(c)
            state = self._move(state, c) if to is None else to
            if not self.states[state][0]:
                break  # nothing can be reached any more
        return self.ends[state] if self.states[state][0] else ((self.states[state][1], self.BEGIN) if self.states[state][1] else None)

    def match(self, word: str) -> tuple[float, int] | None:
        """Weight and kind of the term that a word (any case and marks) meets."""
        known = self.memo.get(word, 0)
        if known != 0:
            return known
        if len(self.memo) > MEMO_WORDS:
            self.memo = {}
        found = None
        for w in {word.strip(STRIP), word.rstrip(STRIP).lstrip(MARKS).translate(LOOKALIKE)}:
            if w and (got := self._run(w)) and (found is None or got > found):
                found = got
        self.memo[word] = found
        return found


STRIP = "".join(chr(c) for c in range(33, 128) if not chr(c).isalnum()) + "“”«»„‟…¿¡"
MARKS = "".join(c for c in STRIP if c not in "@$")
FEATURES = 9


def text_features(text: str, matcher: Matcher) -> list[float]:
    """Features of a text from its hits and their context windows."""
    words = text.lower().split()
    n = len(words)
    hits = [(i, m) for i, m in enumerate(map(matcher.match, words)) if m]
    exact = fuzzy = begin = address = quoted = weight = best = 0.0
    inside, at = 0, 0
    marks = any(q in text for q in QUOTES)
    for i, (w, kind) in hits:
        if marks:
            inside += sum(words[j].count(q) for j in range(at, i) for q in QUOTES)
            at = i
        near = {x.strip(STRIP) for x in words[max(0, i - WINDOW):i + WINDOW + 1]}
        in_quotes = marks and (inside % 2 == 1 or words[i][0] in QUOTES)
        if in_quotes or not REPORTING.isdisjoint(near):
            quoted += w
        elif not ADDRESS.isdisjoint(near):
            address += w
        exact += kind == Matcher.EXACT
        fuzzy += kind == Matcher.FUZZY
        begin += kind == Matcher.BEGIN
        weight += w
        best = max(best, w)
    size = math.sqrt(n + 1.0)
    return [math.log1p(exact), math.log1p(fuzzy), math.log1p(begin), exact / size, begin / size, math.log1p(weight), 100.0 * weight / (n + 20.0), best, math.log1p(address) - math.log1p(quoted)]


def training_sample(docs: DataFrame, labels: DataFrame, held_out, limit: int = LABELLED) -> DataFrame:
    """text and toxic of at most ``limit`` labelled documents not held out; of rows
    that repeat an id, the one with the smallest hash of its text."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out)
    some = known.groupBy(F.col("doc_id").alias("_l")).agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("_l"), "_l").limit(limit)
    rows = docs.select("doc_id", text_of(docs).alias("text"))
    found = rows.join(F.broadcast(some), rows["doc_id"] == some["_l"])
    one = found.groupBy("_l").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "toxic")).alias("row"))
    return one.select("row.text", "row.toxic")


def learn_terms(sample: DataFrame) -> list[tuple[str, bool, float]]:
    """The lexicon: (term, whole word, log ratio) of all terms that reach the limits.
    The sample bounds it: a term needs LEAST_Z, hence several of its documents."""
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy((F.col("toxic") == 1).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = sizes.get(True, 0), sizes.get(False, 0)
    if not bad or not good:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bool, Counter] = {True: Counter(), False: Counter()}
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                words = {w.strip(STRIP) for w in text.lower().split()} - {""}
                seen[toxic == 1].update({w[:k] + "*" for w in words for k in BEGINNINGS if len(w) >= k} | words)
        terms = list(seen[True])  # a term of no toxic document in this task adds nothing to its toxic count
        rest = [t for t in seen[False] if t not in seen[True]]
        for part in (terms, rest):
            for i in range(0, len(part), 100_000):
                p = part[i:i + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(p), pa.array([seen[True][t] for t in p]), pa.array([seen[False][t] for t in p])], names=["term", "bad", "good"])

    counts = sample.mapInArrow(run, "term string, bad long, good long").groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    p, q = F.col("bad") / bad, F.col("good") / good
    pool = (F.col("bad") + F.col("good")) / (bad + good)
    z = (p - q) / F.sqrt(pool * (1 - pool) * (1 / bad + 1 / good) + F.lit(1e-9))
    ratio = F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("good") + 0.5) / (good + 1.0))
    best = counts.withColumns({"z": z, "ratio": ratio}).where((F.col("z") >= LEAST_Z) & (F.col("ratio") >= LEAST_RATIO)).collect()
    return sorted(shortest_beginnings({r["term"]: (r["good"], r["ratio"]) for r in best}))


def shortest_beginnings(found: dict[str, tuple[int, float]]) -> list[tuple[str, bool, float]]:
    """(term, whole word, log ratio) of terms (a beginning ends in ``*``) with their
    false hits: all whole words, and of the beginnings those without a shorter one
    among them that has no more false hits, since that one matches all they match."""
    out = []
    for term, (false, ratio) in found.items():
        bare = term.removesuffix("*")
        if bare != term and any(false >= found[p][0] for k in BEGINNINGS if k < len(bare) and (p := bare[:k] + "*") in found):
            continue
        out.append((bare, bare == term, ratio))
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, scales and weights (intercept last) by damped Newton steps."""
    mean, scale = x.mean(0), x.std(0)
    scale[scale == 0] = 1.0
    z = np.column_stack(((x - mean) / scale, np.ones(len(x))))
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        penalty = np.r_[np.full(len(w) - 1, ridge), 1e-6]
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return mean, scale, w


def _features_of(batch: pa.RecordBatch, matcher: Matcher) -> np.ndarray:
    return np.array([text_features(t, matcher) for t in batch.column("text").to_pylist()], dtype=float).reshape(-1, FEATURES)


def fit(sample: DataFrame):
    """Lexicon and logistic model from a (text, toxic) sample; None without
    examples of both labels."""
    sample = cut(sample)
    terms = learn_terms(sample)
    if not terms:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(Trie(terms))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(list(_features_of(batch, matcher)), pa.list_(pa.float64())), batch.column("toxic").cast(pa.int32())], names=["x", "toxic"])

    told = sample.mapInArrow(run, "x array<double>, toxic int").toPandas()  # at most the sample's rows
    return terms, fit_logistic(np.stack(told["x"].to_list()), (told["toxic"] == 1).to_numpy(float))


def score(docs: DataFrame, model, *keep: str) -> DataFrame:
    """Columns ``keep`` and the score of every row's text (not NULL)."""
    names = [*keep, "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(Trie(model[0])) if model else None
        for batch in batches:
            if model:
                mean, scale, w = model[1]
                x = (_features_of(batch, matcher) - mean) / scale
                s = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
            else:
                s = np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(s, pa.float64())], names=names)

    kinds = dict(docs.dtypes)
    return docs.select(*keep, "text").mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "score double"]))

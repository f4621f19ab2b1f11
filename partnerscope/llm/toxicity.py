"""Toxicity by a learned lexicon, its misspellings, and the words around a hit.

* Lexicon: words that labelled toxic documents have far more often than labelled clean ones,
  learned from a bounded sample of labelled rows.
* Misspellings: the trie of the lexicon is intersected with Levenshtein automata. States are
  sets of (trie node, edits so far), made when first met; a word runs through like through a
  plain automaton and dies after a few letters unless it is near a term.
* Context: a hit inside quotation marks, or next to words that talk about words, counts as
  mention. What the kinds of hit (exact or misspelled, used or mentioned) are worth is learned
  from labelled rows the lexicon hasn't seen, so a kind that clean documents have too is worth
  little.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from partnerscope.llm.common import Work, two_columns, with_package

#: Bound of the fit: labelled rows of each class. It bounds the lexicon too.
SAMPLE_ROWS = 12_000
#: A term occurs in so many sampled toxic documents at least, and so many times more often
#: (with half a document added) in toxic documents than in clean ones.
MIN_SUPPORT = 4
MIN_RATIO = 20.0
#: Edits allowed by length of the term.
EDITS = ((8, 2), (5, 1), (0, 0))
#: Words on either side of a hit that are looked at.
WINDOW = 6
#: Letters of the tokens a task remembers, and states of its automaton: beyond, both start anew.
CACHE_LETTERS, STATES = 3_000_000, 150_000

EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»„“”‚‘’‹›…–—¡¿"
INNER = re.compile(r"[^\W_]+")
OPENING, CLOSING = "\"«„“‘'‹", "\"»“”’'›"
#: Words that announce that a word is being talked about.
CUES = frozenset("word words term terms called quote quoted said says slur insult wort mot palabra".split())


def held_out(column: str = "doc_id") -> F.Column:
    """Rows whose labels are never learned from."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0


def word_forms(token: str) -> list[str]:
    """A token without punctuation at its edges, and its parts if it has several."""
    whole = token.strip(EDGES)
    parts = INNER.findall(whole)
    return [whole] if parts == [whole] or not whole else [whole, *parts]


class NearTerms:
    """Levenshtein automata of all terms at once, on their trie, determinized as words come."""

    def __init__(self, terms: dict[str, float]):
        self.children: list[dict[str, int]] = [{}]
        self.allowed: list[int] = [0]  # most edits of any term below a node
        self.ends: dict[int, tuple[int, float]] = {}
        for term, ratio in sorted(terms.items()):
            edits = next(n for least, n in EDITS if len(term) >= least)
            node = 0
            self.allowed[0] = max(self.allowed[0], edits)
            for letter in term:
                if letter not in self.children[node]:
                    self.children.append({})
                    self.allowed.append(0)
                    self.children[node][letter] = len(self.children) - 1
                node = self.children[node][letter]
                self.allowed[node] = max(self.allowed[node], edits)
            self.ends[node] = edits, ratio
        self._forget()

    def _forget(self) -> None:
        """Back to the two first states; the others are made again when they are met."""
        self.steps: dict[int, int] = {}
        self.states: list[bytes] = []
        self.numbers: dict[bytes, int] = {}
        self.found: list[tuple[int, float] | None] = []
        self.dead = self._number({})
        self.start = self._number({0: 0})

    def _number(self, reached: dict[int, int]) -> int:
        queue = list(reached.items())
        while queue:  # a missing letter: go down the trie without reading
            node, edits = queue.pop()
            if reached[node] < edits:
                continue
            for child in self.children[node].values():
                if edits < self.allowed[child] and reached.get(child, 99) > edits + 1:
                    reached[child] = edits + 1
                    queue.append((child, edits + 1))
        # A pair of node and edits is one number, a state the bytes of its sorted numbers.
        state = array("Q", sorted(node << 2 | edits for node, edits in reached.items())).tobytes()
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            hits = [
                (edits, self.ends[node][1])
                for node, edits in reached.items()
                if node in self.ends and edits <= self.ends[node][0]
            ]
            self.found.append(min(hits, key=lambda hit: (hit[0], -hit[1])) if hits else None)
        return self.numbers[state]

    def _step(self, state: int, letter: str) -> int:
        reached: dict[int, int] = {}
        for pair in array("Q", self.states[state]):
            node, edits = pair >> 2, pair & 3
            if edits < self.allowed[node]:  # an extra letter
                reached[node] = min(reached.get(node, 99), edits + 1)
            for other, child in self.children[node].items():
                cost = edits + (other != letter)
                if cost <= self.allowed[child]:
                    reached[child] = min(reached.get(child, 99), cost)
        return self._number(reached)

    def hit(self, word: str) -> tuple[int, float] | None:
        """Edits to the nearest term and its log ratio; nothing if none is near enough."""
        if len(self.states) > STATES:
            self._forget()
        state, steps = self.start, self.steps
        for letter in word:
            step = state << 21 | ord(letter)
            following = steps.get(step)
            if following is None:
                following = steps[step] = self._step(state, letter)
            if following == self.dead:
                return None
            state = following
        return self.found[state]


@dataclass
class ToxicModel:
    """Terms with their log ratios, and what the evidence of a text's hits is worth."""

    terms: dict[str, float]
    weights: list[float]


class Matcher:
    """What a text holds of the terms and of words near them."""

    def __init__(self, terms: dict[str, float]):
        self.near = NearTerms(terms)
        self.cache: dict[str, tuple[int, float] | None] = {}
        self.cached = 0

    def token_hit(self, token: str) -> tuple[int, float] | None:
        found = [hit for form in word_forms(token) if (hit := self.near.hit(form)) is not None]
        return min(found, key=lambda hit: (hit[0], -hit[1])) if found else None

    def evidence(self, text: str) -> list[float]:
        """Log ratios of the different hits, summed by kind; words; hits for each word; one.

        The kinds: exact and used, misspelled and used, exact and mentioned, misspelled and
        mentioned. A term that is used somewhere counts as used.
        """
        tokens, cache, hits = text.lower().split(), self.cache, {}
        for token in set(tokens):
            try:
                hit = cache[token]
            except KeyError:
                if self.cached > CACHE_LETTERS:
                    cache.clear()
                    self.cached = 0
                hit = cache[token] = self.token_hit(token)
                self.cached += len(token)
            if hit is not None:
                hits[token] = hit
        sums, number = [0.0] * 4, 0
        if hits:
            used: dict[str, bool] = dict.fromkeys(hits, False)
            for at, token in enumerate(tokens):
                if token in hits:
                    number += 1
                    used[token] = used[token] or not mentioned(tokens, at)
            for token, (edits, ratio) in hits.items():
                sums[(edits > 0) + 2 * (not used[token])] += ratio
        return [*sums, math.log1p(len(tokens)), math.log1p(100.0 * number / (len(tokens) + 20.0)), 1.0]


def mentioned(tokens: list[str], at: int) -> bool:
    """Whether the word at this place stands in quotation marks or beside words about words."""
    before, after = tokens[max(0, at - WINDOW) : at], tokens[at + 1 : at + 1 + WINDOW]
    own = tokens[at]
    opened = own[0] in OPENING or any(t[0] in OPENING and t[-1] not in CLOSING for t in before)
    closed = own.rstrip(".,;:!?")[-1:] in tuple(CLOSING) or any(
        t.rstrip(".,;:!?")[-1:] in tuple(CLOSING) and t[0] not in OPENING for t in after
    )
    return (opened and closed) or any(t.strip(EDGES) in CUES for t in (*before[-2:], *after[:2]))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most so many labelled rows of each class, by a hash of the id, none held out."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .where(~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    # Two ordered limits, one of each class: each task hands on no more rows than the limit.
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        chosen = part if chosen is None else chosen.unionAll(part)
    chosen = chosen.withColumnRenamed("doc_id", "labelled_id")
    # Two numbers for each of 2 x rows labels at most: small enough to send, so no text is moved.
    same = F.col("doc_id") == F.col("labelled_id")
    return docs.join(F.broadcast(chosen), same).select("doc_id", "text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> ToxicModel:
    """Terms from two thirds of a bounded sample of labelled rows, weights from the last third."""
    work = Work(docs.sparkSession, "toxicity")
    sample = work.keep(labelled_sample(docs, labels, rows), "sample")
    last = F.pmod(F.xxhash64("doc_id", F.lit("weights")), F.lit(3)) == 0

    def words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, marks = [], []
            for text, toxic in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                forms = {f for token in set(text.as_py().lower().split()) for f in word_forms(token) if f}
                found += ["", *forms]
                marks += [toxic] * (len(forms) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(marks, pa.int32())], names=["word", "toxic"])

    counts = sample.where(~last).mapInArrow(words, "word string, toxic int").groupBy("word")
    counts = counts.agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    counted = work.keep(counts.where((F.col("bad") >= MIN_SUPPORT) | (F.col("word") == "")), "counted")
    totals = counted.where("word = ''").collect()
    bad, good = (totals[0]["bad"], totals[0]["good"]) if totals else (0, 0)
    ratio = ((F.col("bad") + 0.5) / F.lit(bad + 1.0)) / ((F.col("good") + 0.5) / F.lit(good + 1.0))
    terms = (
        counted.where("word <> ''")
        .withColumn("ratio", F.log(ratio))
        .where(F.col("ratio") >= math.log(MIN_RATIO))
    )
    chosen = {r["word"]: r["ratio"] for r in terms.collect()}

    def evidence(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(chosen)
        for batch in batches:
            found = [matcher.evidence(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(2)], names=["evidence", "toxic"])

    known = sample.where(last).mapInArrow(evidence, "evidence array<double>, toxic int").collect()
    work.drop(sample, counted)
    return ToxicModel(chosen, logistic_weights([r["evidence"] for r in known], [r["toxic"] for r in known]))


#: The weights that a fit without labelled rows gives, and that every fit is drawn to.
PRIOR = (1.0, 0.5, -0.2, -0.2, 0.0, 0.0, -2.0)


def logistic_weights(evidence: list[list[float]], marks: list[int], pull: float = 2.0) -> list[float]:
    """Logistic regression by Newton's steps, drawn to the prior by a quadratic term."""
    prior = np.array(PRIOR)
    weights, x, y = prior.copy(), np.array(evidence).reshape(-1, len(PRIOR)), np.array(marks, dtype=float)
    for _ in range(30 if len(y) else 0):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + pull * (weights - prior)
        bend = (x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(prior))
        step = np.linalg.solve(bend, slope)
        weights = weights - step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
    return weights.tolist()


def score(model: ToxicModel, evidence: list[float]) -> float:
    """Probability of the label."""
    total = sum(w * x for w, x in zip(model.weights, evidence, strict=True))
    return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, total))))


def with_toxicity(docs: DataFrame, model: ToxicModel, text_col: str = "text") -> DataFrame:
    """All columns of the documents, and ``toxicity``, the score; an input column of that name is replaced."""
    with_package(docs.sparkSession)
    kept = [n for n in docs.columns if n != "toxicity"]
    text_at = kept.index(text_col)
    rows = docs.select(*[F.col(f"`{n}`") for n in kept])

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model.terms)
        for batch in batches:
            values = [score(model, matcher.evidence(text.as_py() or "")) for text in batch.column(text_at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], names=[*kept, "toxicity"])

    return rows.mapInArrow(scored, StructType([*rows.schema.fields, StructField("toxicity", DoubleType())]))


def toxicity_scores(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score and decision of every text.

    Null and empty texts have no hit and get the score of such documents. Repeated ids keep all
    their rows; no rows give no rows; other columns, whatever their names, are never looked at.
    """
    return with_toxicity(two_columns(docs, id_col, text_col), model).select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def toxic_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns from the labels and scores every document."""
    return toxicity_scores(docs, fit(two_columns(docs, "doc_id", "text"), labels))

"""Benchmark decontamination: an index of the test items, queried by every training passage.

* The items are indexed by their words with BM25 weights. Scores are shares of the score that an
  item gets from its own text, so one threshold serves all items.
* A passage retrieves every item that reaches the threshold. Posting lists are cut into blocks
  with the highest weight in each; lists and blocks that can't reach the threshold are skipped
  (weak-and traversal). Before that, an item's bound for a passage is taken from its heaviest
  words alone, as if the passage had all its others; most passages end there.
* A retrieved item is verified on the passage's words: enough of its shingles, and enough of the
  words of both question and answer.

The index is split into blocks of items of a fixed size; each is broadcast for a pass of its
own, so what a task holds doesn't grow with the benchmark. Documents are never moved.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partnerscope.llm.common import Work, two_columns

K1, B = 1.2, 0.75
#: Share of an item's own score at which it is retrieved.
THRESHOLD = 0.7
#: Share of an item's weight that its heaviest words have, for the first bound.
HEAVY = 0.6
#: Words of a shingle, and the share of an item's shingles, and of the words of its question and
#: of its answer, that make a leak.
SHINGLE = 5
OVERLAP = 0.8
#: Words of items in one broadcast block; an item longer than that has a block of its own.
BLOCK_WORDS = 1_000_000
#: Entries of a posting block.
POSTING_BLOCK = 32

WORDS = re.compile(r"[^\W_]+")
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence is the answer, what is before it the question."""
    parts = [p for p in SENTENCE.split(text.strip()) if WORDS.search(p)]
    if len(parts) < 2:
        return text, ""
    at = text.rindex(parts[-1])
    return text[:at], text[at:]


@dataclass
class Item:
    item_id: int
    question: list[str]
    answer: list[str]

    @property
    def words(self) -> list[str]:
        return self.question + self.answer


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    """Runs of five words; a shorter text is one run."""
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}


class ItemIndex:
    """Postings of some items, weights as shares of each item's own score."""

    def __init__(self, items: list[Item], frequency: dict[str, int], n_items: int, mean_words: float):
        self.items = items
        self.longest = max(len(i.words) for i in items)
        self.runs = [shingles(i.question) | shingles(i.answer) for i in items]
        self.parts = [(set(i.question), set(i.answer)) for i in items]
        postings: dict[str, list[tuple[int, float]]] = {}
        self.heavy: dict[str, list[tuple[int, float]]] = {}
        self.needed: list[float] = []
        for number, item in enumerate(items):
            counts = Counter(item.words)
            weights = {
                w: math.log(1 + (n_items - frequency[w] + 0.5) / (frequency[w] + 0.5))
                * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(item.words) / mean_words))
                for w, tf in counts.items()
            }
            own = sum(weights.values())
            heavy = 0.0
            for word in sorted(weights, key=lambda w: (-weights[w], w)):
                share = weights[word] / own
                postings.setdefault(word, []).append((number, share))
                if heavy < HEAVY:
                    self.heavy.setdefault(word, []).append((number, share))
                    heavy += share
            self.needed.append(THRESHOLD - (1.0 - heavy) - 1e-9)
        self.numbers = {w: [n for n, _ in p] for w, p in postings.items()}
        self.shares = {w: [s for _, s in p] for w, p in postings.items()}
        self.most = {w: max(s) for w, s in self.shares.items()}
        self.block_most = {
            w: [max(s[i : i + POSTING_BLOCK]) for i in range(0, len(s), POSTING_BLOCK)]
            for w, s in self.shares.items()
        }

    def retrieve(self, query: Iterable[str]) -> list[int]:
        """All items whose share of the score reaches the threshold, by block-max weak-and."""
        least = THRESHOLD - 1e-9
        cursors = [[self.numbers[w][0], 0, w] for w in query if w in self.numbers]
        found = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, None
            for number, _, word in cursors:
                bound += self.most[word]
                if bound >= least:
                    pivot = number
                    break
            if pivot is None:
                break
            bound = 0.0
            for cursor in cursors:
                if cursor[0] > pivot:
                    break
                at = bisect_left(self.numbers[cursor[2]], pivot, cursor[1])
                if at < len(self.numbers[cursor[2]]):
                    bound += self.block_most[cursor[2]][at // POSTING_BLOCK]
            total = 0.0
            moved = []
            for cursor in cursors:
                number, at, word = cursor
                if number > pivot:
                    moved.append(cursor)
                    continue
                numbers = self.numbers[word]
                at = bisect_left(numbers, pivot, at)
                if at < len(numbers) and numbers[at] == pivot:
                    if bound >= least:
                        total += self.shares[word][at]
                    at += 1
                if at < len(numbers):
                    moved.append([numbers[at], at, word])
            if total >= least:
                found.append(pivot)
            cursors = moved
        return found

    def passages(self, words: list[str]) -> Iterator[list[str]]:
        """Those that may reach the threshold: each of two steps, a step as long as any item."""
        step, heavy, needed = self.longest, self.heavy, self.needed
        by_step: dict[int, set[str]] = {}
        for at, word in enumerate(words):
            if word in heavy:
                by_step.setdefault(at // step, set()).add(word)
        for start in sorted({s for k in by_step for s in (k - 1, k) if s >= 0}):
            reached: dict[int, float] = {}
            for word in by_step.get(start, set()) | by_step.get(start + 1, set()):
                for number, share in heavy[word]:
                    reached[number] = reached.get(number, 0.0) + share
            if any(share >= needed[number] for number, share in reached.items()):
                yield words[start * step : (start + 2) * step]

    def leaks(self, text: str) -> dict[int, tuple[float, float, float, float]]:
        """Retrieved items: the best share of score, of shingles, of question and of answer."""
        best: dict[int, tuple[float, float, float, float]] = {}
        for passage in self.passages(words_of(text)):
            held = set(passage)
            for number in self.retrieve(held):
                own, parts = self.runs[number], self.parts[number]
                found = {tuple(passage[i : i + n]) for n in {len(r) for r in own} for i in range(len(passage) - n + 1)}
                score = sum(self.shares[w][bisect_left(self.numbers[w], number)] for w in (parts[0] | parts[1]) & held)
                shares = [len(p & held) / len(p) if p else 1.0 for p in parts]
                values = (score, len(own & found) / len(own), *shares)
                best[number] = max(best.get(number, values), values, key=lambda v: (min(v[1:]), v))
        return best


ITEM = "item_no long, item_id long, question array<string>, answer array<string>"


def item_words(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Words of question and answer: of these columns where the table has them, else of the text cut."""
    both = {"question", "answer"} <= set(benchmark.columns)
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (("question", "answer") if both else (text_col,))]
    rows = benchmark.select(F.monotonically_increasing_id(), F.col(id_col).cast("long"), *texts)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = zip(*[c.to_pylist() for c in batch.columns[2:]], strict=True)
            pairs = [p if both else question_and_answer(p[0]) for p in parts]
            words = [pa.array([words_of(p[i]) for p in pairs], pa.list_(pa.string())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *words], names=["item_no", "item_id", "question", "answer"]
            )

    return rows.mapInArrow(cut, ITEM).where("size(question) + size(answer) > 0")


def item_blocks(items: DataFrame) -> Iterator[tuple[list[Item], dict[str, int]]]:
    """The items in blocks of bounded size, with the number of items each of their words is in."""
    distinct = items.select("item_no", F.explode(F.array_distinct(F.concat("question", "answer"))).alias("word"))
    frequency = distinct.groupBy("word").agg(F.count("*").alias("n"))
    maps = (
        distinct.join(frequency, "word")
        .groupBy("item_no")
        .agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("frequency"))
    )
    block: list[Item] = []
    known: dict[str, int] = {}
    size = 0
    for row in items.join(maps, "item_no").orderBy("item_id", "item_no").toLocalIterator():
        item = Item(row["item_id"], row["question"], row["answer"])
        if block and size + len(item.words) > BLOCK_WORDS:
            yield block, known
            block, known, size = [], {}, 0
        block.append(item)
        known.update(row["frequency"])
        size += len(item.words)
    if block:
        yield block, known


MATCH_FIELDS = ("item_id", "score", "overlap", "question_overlap", "answer_overlap")
MATCH_TYPE = pa.list_(pa.struct([(n, pa.float64() if k else pa.int64()) for k, n in enumerate(MATCH_FIELDS)]))
MATCHES = "array<struct<item_id:bigint,score:double,overlap:double,question_overlap:double,answer_overlap:double>>"
ADDED = ("leaked_items", "retrieved_items", "matches")


def _held(row: Column) -> Column:
    return F.least(row["overlap"], row["question_overlap"], row["answer_overlap"]) >= OVERLAP


def _retrieved(docs: DataFrame, index: ItemIndex, text_col: str) -> DataFrame:
    """Adds what one block of items matches to the column ``matches``."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    names = list(docs.columns)
    text_at, matches_at = names.index(text_col), names.index("matches")

    def matched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            rows = batch.column(matches_at).to_pylist()
            for row, cell in zip(rows, batch.column(text_at), strict=True):
                for n, values in own.leaks(cell.as_py() or "").items():
                    row.append(dict(zip(MATCH_FIELDS, (own.items[n].item_id, *values), strict=True)))
            columns = list(batch.columns)
            columns[matches_at] = pa.array(rows, MATCH_TYPE)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(matched, docs.schema)


def with_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of the documents, and what they leak.

    ``matches`` has the retrieved items with their scores and overlaps, ``retrieved_items`` their
    sorted ids, ``leaked_items`` the sorted ids of those that hold. Input columns of these names
    are replaced. Null and empty texts leak nothing; items without words are no items; with no
    items nothing is leaked. Repeated documents keep their rows, repeated items count each. An
    item with a single sentence is all question. Every block of items is one pass; a benchmark of
    several blocks has the passes written between.
    """
    work = Work(docs.sparkSession, "leaks")
    items = work.keep(item_words(benchmark), "items")
    number, mean_words = items.agg(F.count("*"), F.avg(F.size("question") + F.size("answer"))).first()
    kept = [n for n in docs.columns if n not in ADDED]
    found = docs.select(*[F.col(f"`{n}`") for n in kept], F.array().cast(MATCHES).alias("matches"))
    for k, (block, frequency) in enumerate(item_blocks(items)):
        found = work.keep(found, "matches") if k else found
        found = _retrieved(found, ItemIndex(block, frequency, number, mean_words), text_col)

    def ids(rows: Column) -> Column:
        return F.array_sort(F.array_distinct(F.transform(rows, lambda r: r["item_id"])))

    return found.select(
        *[F.col(f"`{n}`") for n in kept],
        ids(F.filter("matches", _held)).alias("leaked_items"),
        ids(F.col("matches")).alias("retrieved_items"),
        "matches",
    )


def contaminated_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every document with the items it leaks."""
    found = with_leaks(two_columns(docs, "doc_id", "text"), benchmark)
    best = F.array_max(F.transform(F.filter("matches", _held), lambda r: r["score"]))
    return found.select(
        "doc_id",
        (F.size("leaked_items") > 0).alias("contaminated"),
        F.size("leaked_items").cast("long").alias("n_items"),
        "leaked_items",
        F.round(best, 6).alias("best_score"),
    )

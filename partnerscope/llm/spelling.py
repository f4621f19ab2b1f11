"""Spelling variants: words that differ by one letter, found in tries of letter-group counts.

* Words are counted over all texts; one with its letters in groups has a vector of counts, one
  small number for each group. One inserted letter adds one somewhere, a deleted one takes one
  away, a replaced one does both or neither.
* The trie arranges words by the counts of one group after the other. A search goes down from the
  root with a budget of one surplus and one deficit, and ends at vectors that are near enough;
  their words are verified letter by letter. A trie is the sorted array of its vectors packed into
  64 bits: a node is a range of it, and few vectors below a node are compared at once.
* The upper levels are spread over the cluster: a word is indexed under the counts of its first
  groups, and is sent as a query to those that the budget allows. Of two near words only the one
  with the smaller prefix asks. Prefixes with many words are split into parts, each a trie of its
  own of bounded size; queries pass by it and are not gathered.
* Forms, counts and roots then are groupings and joins over words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partnerscope.llm.common import Work, text_or_empty, with_package
from partnerscope.llm.word_hash import LOWER

#: Letters of a word, and how often it occurs, at least.
LEAST_LETTERS, LEAST_COUNT = 7, 2
#: A form occurs so many times as often as the word.
FORM_RATIO = 10
#: Out of so many pairs of document and run, one loses a letter.
CHECKSUM = 31
#: Letter groups, in the order of the trie's levels; all other letters make a last one.
GROUPS = ("e", "t", "a", "i", "n", "o", "h", "r", "s", "d", "l", "u", "cq", "gmp", "fwyb")
LEVELS = len(GROUPS) + 1
#: Counts that a level tells apart: four bits.
MOST = 15
#: Words under a prefix that the depth aims at, and words of a trie at most, about.
AIMED, TRIE_WORDS = 8_000, 20_000
#: Below a node with so few vectors they are compared at once.
FEW = 16
#: Letters that are compared in one go; longer words are compared one by one.
WIDTH = 64
#: Counts that a task holds, and pairs that are verified together.
HELD, PAIRS = 500_000, 200_000

_level = np.full(256, LEVELS - 1, np.uint64)
for _k, _letters in enumerate(GROUPS):
    _level[[ord(c) for c in _letters]] = _k
_SHIFT = np.arange(60, -1, -4, dtype=np.uint64)


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``n``, from rows of ``doc_id`` and ``text``, both strings."""
    run = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LETTERS},}}")

    def held(found: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"])

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = Counter(run.findall(text.as_py().encode("utf-8", "surrogatepass").translate(LOWER).decode("utf-8", "surrogatepass")))
                seed = None if doc_id is None else zlib.crc32(f"{doc_id}:".encode())
                for word, n in own.items():
                    if seed is not None and (h := zlib.crc32(word.encode(), seed)) % CHECKSUM == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    total[word] = total.get(word, 0) + n
                if len(total) > HELD:
                    yield held(total)
                    total.clear()
        yield held(total)

    counts = docs.select("doc_id", "text").mapInArrow(made, "word string, n long")
    long_enough = counts.where(F.length("word") >= LEAST_LETTERS)
    return long_enough.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def vectors(words: list[bytes]) -> np.ndarray:
    """The counts of each word's letter groups, packed, the first group highest."""
    lengths = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer(b"".join(words), np.uint8)
    cell = np.repeat(np.arange(len(words)), lengths) * LEVELS + _level[letters].astype(np.int64)
    counts = np.minimum(np.bincount(cell, minlength=len(words) * LEVELS), MOST).astype(np.uint64).reshape(-1, LEVELS)
    return (counts << _SHIFT).sum(axis=1, dtype=np.uint64)


_ones = [1 << int(s) for s in _SHIFT]
#: What packed vectors within the budget differ by. A carry can make others look so; words are verified.
WITHIN = np.unique(np.array([(i - j) % 2**64 for i in [0, *_ones] for j in [0, *_ones]], np.uint64))


def within_budget(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    differ = one - two
    return WITHIN[np.minimum(np.searchsorted(WITHIN, differ), len(WITHIN) - 1)] == differ


def depth_for(words: int) -> int:
    """Levels that make a prefix: each divides words by about three."""
    depth = 1
    while words > AIMED * 3**depth and depth < 8:
        depth += 1
    return depth


def routed(words: DataFrame, depth: int) -> DataFrame:
    """Rows ``prefix, query, packed, word, n``: each word as an index entry, and as a query of all
    prefixes that the budget allows and that aren't smaller than its own."""
    shift = np.uint64(64 - 4 * depth)
    units = [np.uint64(1) << (np.uint64(4 * (depth - 1 - k))) for k in range(depth)]

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word = batch.column(0).to_pylist()
            if not word:
                continue
            packed = vectors([w.encode("latin-1") for w in word])
            own = packed >> shift
            count = [(own // u) & np.uint64(MOST) for u in units]
            ways = [(own, np.ones(len(own), dtype=bool))]
            for i in range(-1, depth):
                for j in range(-1, depth):
                    if i != j:
                        more = own + units[i] if i >= 0 else own
                        fits = (count[i] < MOST) if i >= 0 else np.ones(len(own), dtype=bool)
                        fits = fits & (count[j] > 0) if j >= 0 else fits
                        ways.append((more - units[j] if j >= 0 else more, fits))
            for k, (prefix, fits) in enumerate([(own, np.ones(len(own), dtype=bool)), *ways]):
                at = np.flatnonzero(fits & (prefix >= own))
                columns = [pa.array(prefix[at].view(np.int64)), pa.array(np.full(len(at), k > 0)), pa.array(packed[at].view(np.int64)), *(batch.column(c).take(pa.array(at)) for c in range(2))]
                yield pa.RecordBatch.from_arrays(columns, names=["prefix", "query", "packed", "word", "n"])

    return words.select("word", "n").mapInArrow(made, "prefix long, query boolean, packed long, word string, n long")


class Trie:
    """Words by their vectors, and the search for near ones."""

    def __init__(self, words: list[bytes], n: np.ndarray):
        packed = vectors(words)
        order = np.argsort(packed, kind="stable")
        self.words, self.n = [words[k] for k in order], n[order]
        self.vectors, self.first = np.unique(packed[order], return_index=True)
        self.until = np.append(self.first[1:], len(words))
        self.letters = Letters(self.words)

    def leaves(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of query and vector that differ by one surplus and one deficit at most."""
        at = np.arange(len(queries))
        low, high = np.zeros(len(at), np.int64), np.full(len(at), len(self.vectors))
        prefix = np.zeros(len(at), np.uint64)
        more, less = np.ones(len(at), np.int8), np.ones(len(at), np.int8)
        found = []
        for level in range(LEVELS + 1):
            small = (high - low <= FEW) | (level == LEVELS)
            found.append((at[small], low[small], high[small]))
            at, low, high, prefix, more, less = (x[~small] for x in (at, low, high, prefix, more, less))
            if not len(at):
                break
            shift = np.uint64(60 - 4 * level)
            digit = ((queries[at] >> shift) & np.uint64(MOST)).astype(np.int8)
            children = []
            for step in (0, 1, -1):
                fits = np.flatnonzero((digit < MOST) & (more > 0) if step > 0 else (digit > 0) & (less > 0) if step < 0 else digit >= 0)
                start = prefix[fits] | ((digit[fits] + step).astype(np.uint64) << shift)
                left = np.searchsorted(self.vectors, start)
                right = np.searchsorted(self.vectors, start | ((np.uint64(1) << shift) - np.uint64(1)), side="right")
                held = left < right
                fits = fits[held]
                children.append((at[fits], left[held], right[held], start[held], more[fits] - (step > 0), less[fits] - (step < 0)))
            at, low, high, prefix, more, less = (np.concatenate(x) for x in zip(*children, strict=True))
        at, low, high = (np.concatenate(x) for x in zip(*found, strict=True))
        of, leaf = spread(at, low, high)
        near = within_budget(queries[of], self.vectors[leaf])
        return of[near], leaf[near]

    def near(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a query and a word of the trie that differ by exactly one letter."""
        packed = vectors(words)
        order = np.argsort(packed, kind="stable")
        different, first = np.unique(packed[order], return_index=True)
        of, leaf = self.leaves(different)
        of, at = spread(np.arange(len(of)), first[of], np.append(first[1:], len(words))[of])
        of, leaf = order[at], leaf[of]
        letters, out = Letters(words), []
        width = self.until[leaf] - self.first[leaf]
        cuts = (np.flatnonzero(np.diff(np.cumsum(width) // PAIRS)) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(of)], strict=True):
            one, two = spread(of[a:b], self.first[leaf[a:b]], self.until[leaf[a:b]])
            right = one_apart(letters, self.letters, one, two)
            out.append((one[right], two[right]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def spread(of: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each element with all numbers of its range."""
    width = high - low
    ends = np.cumsum(width)
    return np.repeat(of, width), np.arange(int(width.sum())) - np.repeat(ends - width - low, width)


class Letters:
    """Words as rows of letters, from the front and from the back."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.length = np.array([len(w) for w in words], np.int64)
        self.front = np.array(words, f"S{WIDTH}").view(np.uint8).reshape(-1, WIDTH)
        self.back = np.array([w[::-1] for w in words], f"S{WIDTH}").view(np.uint8).reshape(-1, WIDTH)
        self.first = self.front[:, :4].copy().view("<u4").reshape(-1) & 0xFFFFFF
        self.last = self.back[:, :4].copy().view("<u4").reshape(-1) & 0xFFFFFF


def one_apart(a: Letters, b: Letters, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether pairs of words differ by exactly one letter: what agrees in front and behind is enough.

    Words of six letters or more that do agree in their first or their last three.
    """
    n, m = a.length[one], b.length[two]
    right = (np.abs(n - m) <= 1) & ((a.first[one] == b.first[two]) | (a.last[one] == b.last[two]))
    at = np.flatnonzero(right)
    long = at[np.maximum(n[at], m[at]) >= WIDTH]
    right[long] = [differ_by_one(a.words[i], b.words[j]) for i, j in zip(one[long], two[long], strict=True)]
    at = at[np.maximum(n[at], m[at]) < WIDTH]
    front = agreeing(a.front[one[at]], b.front[two[at]])
    back = agreeing(a.back[one[at]], b.back[two[at]])
    same = n[at] == m[at]
    right[at] = (front + back >= np.minimum(n[at], m[at]) - same) & (front < WIDTH)
    return right


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Letters before the first that differ; the full width if none does."""
    differ = a != b
    return np.where(differ.any(axis=1), differ.argmax(axis=1), WIDTH)


def differ_by_one(a: bytes, b: bytes) -> bool:
    if len(a) > len(b):
        a, b = b, a
    at = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a != b and (a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else len(a) + 1 == len(b) and a[at:] == b[at + 1 :])


def near_words(words: DataFrame, total: int, work: Work) -> DataFrame:
    """Rows ``word, near, near_n`` for both words of each pair that differs by one letter."""
    sent = routed(words, depth_for(total))
    sizes = work.keep(sent.where("NOT query").groupBy("prefix").agg(F.ceil(F.count("*") / TRIE_WORDS).alias("parts")), "prefixes")
    own = F.pmod(F.xxhash64("word"), F.col("parts"))
    part = F.when(F.col("query"), F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).otherwise(F.array(own))
    placed = sent.join(sizes, "prefix").select("prefix", F.explode(part).alias("part"), "query", "packed", "word", "n")
    # In order of the vectors, so that a batch's queries share theirs and each is searched for once.
    dealt = placed.repartition("prefix", "part").sortWithinPartitions("prefix", "part", "query", "packed")

    def matched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, trie = None, None
        words: list[bytes] = []
        counts: list[int] = []
        for batch in batches:
            prefix, part, query = (np.asarray(batch.column(k).to_numpy(zero_copy_only=False)) for k in range(3))
            changes = np.flatnonzero((np.diff(prefix) != 0) | (np.diff(part) != 0) | (np.diff(query.astype(np.int8)) != 0)) + 1
            for low, high in zip([0, *changes.tolist()], [*changes.tolist(), batch.num_rows], strict=True):
                if low == high:
                    continue
                some = [w.encode("latin-1") for w in batch.column(4).slice(low, high - low).to_pylist()]
                n = batch.column(5).slice(low, high - low).to_numpy()
                if (prefix[low], part[low]) != group:
                    group, trie, words, counts = (prefix[low], part[low]), None, [], []
                if not query[low]:
                    words += some
                    counts += n.tolist()
                    continue
                trie = trie or Trie(words, np.array(counts, np.int64))
                one, two = trie.near(some)
                # Within a prefix both words ask, and only the smaller one is heard.
                same = np.flatnonzero([not (p == group[0] and some[i] > trie.words[j]) for p, i, j in zip(own_prefix(some, one), one, two, strict=True)])
                one, two = one[same], two[same]
                left, right = [some[i].decode("latin-1") for i in one], [trie.words[j].decode("latin-1") for j in two]
                near_n = np.concatenate([trie.n[two], n[one]])
                yield pa.RecordBatch.from_arrays([pa.array(left + right, pa.string()), pa.array(right + left, pa.string()), pa.array(near_n)], names=["word", "near", "near_n"])

    depth = depth_for(total)

    def own_prefix(some: list[bytes], at: np.ndarray) -> list[int]:
        return (vectors(some) >> np.uint64(64 - 4 * depth)).astype(np.int64)[at].tolist()

    return dealt.mapInArrow(matched, "word string, near string, near_n long")


def with_roots(forms: DataFrame, work: Work) -> DataFrame:
    """``word`` and ``root`` of words that have a form (column ``form``).

    A form is ten times as frequent as its word, so chains are short; each round doubles what is
    followed.
    """
    roots = work.keep(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        following = roots.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().cast("int").alias("moved"))
        following, moved = work.keep_summed(following, "roots", F.col("moved"))
        work.drop(roots)
        roots = following.select("word", "root")
        if not moved:
            return roots
        roots = work.keep(roots, "roots")
        work.drop(following)


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words, their near words, the form of each and its root.

    Null and empty texts have no words; rows without id keep all letters. Repeated rows count as
    often as they come. Of near words that are equally frequent the smallest is the form. No rows
    give no rows. Other columns, whatever their names, are never looked at.
    """
    work = Work(with_package(docs.sparkSession), "spelling")
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), text_or_empty(text_col).alias("text"))
    words, total = work.keep_summed(word_counts(rows), "words", F.lit(1))
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), "near"))
    near = near_words(words, total, work).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    often = -F.col("best.rank") >= FORM_RATIO * F.col("n")
    found = work.keep(
        joined.select(
            "word",
            "n",
            F.when(often, F.col("best.near")).alias("form"),
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(often, -F.col("best.rank")).alias("form_n"),
        ),
        "found",
    )
    roots = with_roots(found.where("form IS NOT NULL"), work)
    result = found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return work.finish(result.select("word", "n", "n_near", "form", "form_n", "root"))

"""Quality rules: counts of a text, and its lines labelled by a linear-chain random field.

* Counts: words, letters in words, symbols, repeated lines, and words in windows that recur in
  the text. Texts that are too short or repeat themselves fail on these alone.
* Labels: a conditional random field over the lines of a text marks each as content or
  boilerplate by its shape (symbols, capitals, digits, repeated words, length, ends) and by its
  neighbours; the most probable sequence is decoded. Texts keep their place if enough of their
  words stand in lines of content.

The field is trained on a bounded sample of labelled documents, as many good as bad ones, of which
it sees every line. Labels of lines are not known: see ``train_lines``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partnerscope.llm.common import BLANKS, two_columns

SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Share of a text's words that stand in lines of content.
CONTENT_SHARE = 0.5
#: Bound of the training sample: documents of each label; their whole texts are used.
SAMPLE_ROWS = 1_500
#: Lines of a chain in training, and how many lines a document weighs at most.
CHAIN_LINES = 64
#: Steps of the two fits.
FIRST_STEPS, SECOND_STEPS = 120, 40
#: Characters that are worked on together, and code points with a class of their own.
BATCH_CHARS = 1 << 20
_KNOWN = 0x250

_BLANK, _SYMBOL, _UPPER, _LOWER, _DIGIT, _MARK = (1 << k for k in range(6))


def _classes() -> np.ndarray:
    table = np.zeros(_KNOWN + 1, dtype=np.uint8)
    for code in range(_KNOWN):
        letter = chr(code)
        if letter in BLANKS:
            table[code] = _BLANK
        elif letter.isalpha():
            table[code] = _UPPER if letter.isupper() else _LOWER
        elif letter.isdigit():
            table[code] = _DIGIT
        else:
            table[code] = _MARK | (_SYMBOL if letter in SYMBOLS else 0)
    table[_KNOWN] = _LOWER  # letters of other scripts
    return table


CLASSES = _classes()
FEATURES = (
    "one", "length", "short", "symbols", "capitals", "digits", "marks", "bars", "repeats", "duplicate", "ended", "long words",
    "first", "last", "alone",
)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


class Batch:
    """Counts and line features of some texts."""

    def __init__(self, texts: list[str]):
        joined = "".join([t + "\n" for t in texts])  # so every line, also the last, has an end
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        classes = CLASSES[np.minimum(codes, _KNOWN)]
        docs = len(texts)
        ends = np.flatnonzero(codes == 10)
        starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
        doc_ends = np.cumsum([len(t) + 1 for t in texts])
        self.line_doc = np.searchsorted(doc_ends - 1, ends, side="left") if docs else ends
        lines = len(ends)

        def per_line(mask: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
            return sums[ends + 1] - sums[starts] if lines else np.zeros(0, np.int64)

        def per_doc(values: np.ndarray) -> np.ndarray:
            return np.bincount(self.line_doc, weights=values, minlength=docs).astype(np.int64)

        blank = classes & _BLANK > 0
        first = ~blank
        first[1:] &= blank[:-1]
        chars, words = per_line(~blank), per_line(first)
        symbols = per_line(classes & _SYMBOL > 0)
        self.line_words = words
        self.n_words, self.word_chars, self.n_symbols = per_doc(words), per_doc(chars), per_doc(symbols)

        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, joined.encode("utf-8", "surrogatepass").split()), dtype=np.uint64)
        hashes = _mixed(hashes)
        word_line = np.repeat(np.arange(lines), words)
        word_doc = self.line_doc[word_line]
        self.n_repeat_words = self._repeats(hashes, word_doc, docs)

        line_hash = np.fromiter(
            map(xxhash.xxh3_64_intdigest, (joined.encode("utf-8", "surrogatepass")[:-1] or b"").split(b"\n") if docs else ()),
            dtype=np.uint64,
        )
        keyed = _mixed(line_hash + _mixed(self.line_doc.astype(np.uint64) + np.uint64(1)))
        _, seen = np.unique(keyed, return_index=True)
        again = np.ones(lines, dtype=bool)
        again[seen] = False
        again &= words > 0
        self.n_dup_lines = per_doc(again)

        in_line = _mixed(hashes + _mixed(word_line.astype(np.uint64) + np.uint64(1)))
        _, seen = np.unique(in_line, return_index=True)
        distinct = np.bincount(word_line[seen], minlength=lines)
        upper, lower = per_line(classes & _UPPER > 0), per_line(classes & _LOWER > 0)
        # The last character that is no blank, by line: where it ends a sentence.
        place = np.where(blank, -1, np.arange(len(codes)))
        last = np.maximum.reduceat(place, starts) if lines else np.zeros(0, np.int64)
        final = np.where(last >= 0, codes[np.maximum(last, 0)], 0) if lines else np.zeros(0, np.uint32)
        opens = np.ones(lines, dtype=bool)
        opens[1:] = self.line_doc[1:] != self.line_doc[:-1]
        closes = np.append(opens[1:], True)[:lines]
        self.features = np.stack(
            [
                np.ones(lines),
                np.log1p(words) / 5.0,
                (words < 6).astype(float),
                _share(symbols, chars),
                _share(upper, upper + lower),
                _share(per_line(classes & _DIGIT > 0), chars),
                _share(per_line(classes & _MARK > 0), chars),
                _share(per_line(codes == ord("|")), words),
                1.0 - _share(distinct, words),
                again.astype(float),
                np.isin(final, [ord(c) for c in ".!?…"]).astype(float),
                np.minimum(_share(chars, words), 30.0) / 10.0,
                opens.astype(float),
                closes.astype(float),
                (opens & closes).astype(float),
            ],
            axis=1,
        ) if lines else np.zeros((0, len(FEATURES)))

    @staticmethod
    def _repeats(hashes: np.ndarray, word_doc: np.ndarray, docs: int) -> np.ndarray:
        """Words of each text that lie in a window which the text has twice or more."""
        n = len(hashes) - REPEAT_WINDOW + 1
        if n <= 0:
            return np.zeros(docs, np.int64)
        run = _mixed(word_doc[:n].astype(np.uint64) + np.uint64(1))
        for k in range(REPEAT_WINDOW):
            run = (run ^ (run >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
        at = np.flatnonzero(word_doc[:n] == word_doc[REPEAT_WINDOW - 1 :])
        _, group, counts = np.unique(run[at], return_inverse=True, return_counts=True)
        again = at[counts[group] > 1]
        cover = np.zeros(len(hashes) + 1, dtype=np.int64)
        np.add.at(cover, again, 1)
        np.add.at(cover, again + REPEAT_WINDOW, -1)
        return np.bincount(word_doc[np.cumsum(cover)[:-1] > 0], minlength=docs)


@dataclass
class LineField:
    """Weights of content against boilerplate for a line's features, and of two neighbours' labels."""

    weights: np.ndarray
    pairs: np.ndarray  # [label of a line, label of the next]; 0 boilerplate, 1 content

    def decode(self, features: np.ndarray, line_doc: np.ndarray, docs: int) -> np.ndarray:
        """The most probable labels of all lines, for all texts together (Viterbi)."""
        return viterbi(features @ self.weights, self.pairs, line_doc, docs)


def viterbi(content: np.ndarray, pairs: np.ndarray, line_doc: np.ndarray, docs: int) -> np.ndarray:
    """Labels by best sequence; ``content`` has the score of content against boilerplate.

    Texts go side by side, the longest first, so step t works on those that have a line t. Of
    equal sequences the one with content wins.
    """
    sizes = np.bincount(line_doc, minlength=docs)
    first = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    sizes, first = sizes[order], first[order]
    labels = np.zeros(len(content), dtype=np.int8)
    back = np.zeros((len(content), 2), dtype=np.int8)
    best = np.zeros((docs, 2))
    for t in range(int(sizes[0]) if docs else 0):
        n = int(np.searchsorted(-sizes, -t, side="left"))
        at = first[:n] + t
        if t:
            reached = best[:n, :, None] + pairs[None]
            back[at] = (reached[:, 1] >= reached[:, 0]).astype(np.int8)
            best[:n] = reached.max(axis=1)
        best[:n, 1] += content[at]
    has = np.flatnonzero(sizes)
    label = (best[has, 1] >= best[has, 0]).astype(np.int8)
    for t in range(int(sizes[0]) - 1 if docs else -1, -1, -1):
        n = int(np.searchsorted(-sizes, -t, side="left"))
        at = first[:n] + t
        labels[at] = label[:n]
        label[:n] = back[at, label[:n]]
    return labels


def train(texts: list[str], quality: list[int]) -> LineField:
    """The field learned from whole texts and their documents' quality."""
    batch = Batch(texts)
    return train_lines(batch.features, batch.line_words > 0, batch.line_doc, np.array(quality))


def train_lines(features: np.ndarray, worded: np.ndarray, line_doc: np.ndarray, quality: np.ndarray) -> LineField:
    """Labels of lines are hidden, only their document's is known: learned in two rounds of hard EM.

    First every line has its document's label, and features are fitted without regard to
    neighbours, which never differ yet. Each line's likelier label under that is then taken for
    its own, and the whole field is fitted to these labels. So a menu in a good document becomes
    boilerplate, and prose in a bad one content. Further rounds would only sharpen what neighbours
    say, until the lines of a document never differ.
    """
    width, docs = len(FEATURES), len(quality)
    if not len(line_doc):
        return LineField(np.zeros(width), np.zeros((2, 2)))
    chains = Chains(features, line_doc, docs)
    alone = chains.fitted((quality == 1)[line_doc] & worded, np.zeros(width + 4), FIRST_STEPS, neighbours=False)
    likelier = (features @ alone.weights >= 0) & worded
    return chains.fitted(likelier, np.concatenate([alone.weights, np.zeros(4)]), SECOND_STEPS, neighbours=True)


class Chains:
    """Lines of whole documents as chains of at most CHAIN_LINES, side by side.

    A longer document is several chains; no line is left out, and the features are those of the
    whole text. It weighs as much as CHAIN_LINES lines, so that a few long ones don't decide.
    """

    def __init__(self, features: np.ndarray, line_doc: np.ndarray, docs: int):
        size = np.bincount(line_doc, minlength=docs)
        place = np.arange(len(line_doc)) - (np.cumsum(size) - size)[line_doc]
        chains = -(-size // CHAIN_LINES)
        self.chain = (np.cumsum(chains) - chains)[line_doc] + place // CHAIN_LINES
        self.place = place % CHAIN_LINES
        shape = (int(chains.sum()), min(int(size.max()), CHAIN_LINES))
        self.x = np.zeros((*shape, features.shape[1]))
        self.x[self.chain, self.place] = features
        self.held = np.zeros(shape, dtype=bool)
        self.held[self.chain, self.place] = True
        self.weight = np.minimum(1.0, CHAIN_LINES / np.maximum(np.repeat(size, chains), 1))

    def fitted(self, target: np.ndarray, theta: np.ndarray, steps: int, neighbours: bool) -> LineField:
        """Maximum likelihood with a quadratic penalty, by forward-backward and Adam's steps.

        Without neighbours their weights stay as they are, 0, and each line stands alone.
        """
        width = self.x.shape[2]
        y = np.zeros(self.held.shape, dtype=np.int64)
        y[self.chain, self.place] = target
        both = (self.held[:, 1:] & self.held[:, :-1]) * self.weight[:, None]
        seen = np.array([[(both * (y[:, :-1] == a) * (y[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)])
        lines = (self.held * self.weight[:, None]).sum()
        flat = self.x.reshape(-1, width)
        seen_features = (y * self.held * self.weight[:, None]).ravel() @ flat
        theta = theta.copy()
        speed, square = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, steps + 1):
            content = (flat @ theta[:width]).reshape(self.held.shape)
            if neighbours:
                expected, expected_pairs = _expected(content, theta[width:].reshape(2, 2), self.held, self.weight)
            else:
                expected, expected_pairs = self.held * self.weight[:, None] / (1.0 + np.exp(-content)), seen
            slope = np.concatenate([expected.ravel() @ flat - seen_features, (expected_pairs - seen).ravel()]) / lines
            slope += 1e-4 * theta
            speed = 0.9 * speed + 0.1 * slope
            square = 0.99 * square + 0.01 * slope**2
            theta -= 0.15 * (speed / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
        return LineField(theta[:width], theta[width:].reshape(2, 2))


def _expected(content: np.ndarray, pairs: np.ndarray, held: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of content for each line, and the expected number of each pair of labels, weighted by chain."""
    docs, longest = content.shape
    own = np.stack([np.zeros_like(content), content], axis=2)
    ahead = np.zeros((docs, longest, 2))
    behind = np.zeros((docs, longest, 2))
    ahead[:, 0] = own[:, 0]
    for t in range(1, longest):
        before = ahead[:, t - 1]
        moved = np.logaddexp(before[:, :1] + pairs[0], before[:, 1:] + pairs[1]) + own[:, t]
        ahead[:, t] = np.where(held[:, t, None], moved, ahead[:, t - 1])
    for t in range(longest - 2, -1, -1):
        after = own[:, t + 1] + behind[:, t + 1]
        moved = np.logaddexp(after[:, :1] + pairs[:, 0], after[:, 1:] + pairs[:, 1])
        behind[:, t] = np.where(held[:, t + 1, None], moved, 0.0)
    total = np.logaddexp.reduce(ahead[:, -1], axis=1)
    content_share = np.where(held, np.exp(ahead[:, :, 1] + behind[:, :, 1] - total[:, None]), 0.0)
    joint = np.exp(
        ahead[:, :-1, :, None] + pairs + (own[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
    )
    both = (held[:, 1:] & held[:, :-1]) * weight[:, None]
    return content_share * weight[:, None], (joint * both[:, :, None, None]).sum(axis=(0, 1))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> LineField:
    """The field learned from at most so many labelled documents of each quality."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("labelled_id"), F.col("quality").cast("int").alias("quality"))
        .where("labelled_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("labelled_id")
        .agg(F.min("quality").alias("quality"))
    )
    part = [
        known.where(F.col("quality") == q).orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(rows) for q in (0, 1)
    ]
    # Two numbers for each of 2 x rows labels at most: small enough to send, so no text is moved.
    chosen = F.broadcast(part[0].unionAll(part[1]))
    sample = docs.join(chosen, F.col("doc_id") == F.col("labelled_id")).select("doc_id", "quality", "text")
    # Features are made in tasks over whole texts; no text comes to the driver.
    found = sample.mapInArrow(_line_features, "doc_id long, quality int, features binary, worded binary").collect()
    found = sorted(found, key=lambda r: (r["doc_id"], bytes(r["features"])))
    if not found:
        return train([], [])
    worded = [np.frombuffer(r["worded"], np.uint8) > 0 for r in found]
    features = np.concatenate([np.frombuffer(r["features"], np.float32) for r in found]).reshape(-1, len(FEATURES))
    line_doc = np.repeat(np.arange(len(found)), [len(w) for w in worded])
    return train_lines(features.astype(float), np.concatenate(worded), line_doc, np.array([r["quality"] for r in found]))


def _line_features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of all lines of each text, four bytes a number, and which lines have words."""
    for batch in batches:
        texts = (Batch([text.as_py()]) for text in batch.column(2))
        pairs = [(b.features.astype(np.float32).tobytes(), (b.line_words > 0).astype(np.uint8).tobytes()) for b in texts]
        arrays = [pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=["doc_id", "quality", "features", "worded"])


QUALITY = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, content_share double"
)


def _batches(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for at, text in enumerate(texts):
        if size and size + len(text) > BATCH_CHARS:
            yield start, at
            start, size = at, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def judge(texts: list[str], field: LineField) -> dict[str, np.ndarray]:
    """Counts and verdicts of some texts."""
    batch = Batch(texts)
    failed = (batch.n_words < MIN_WORDS) | (100 * batch.n_repeat_words > MAX_REPEAT_PERCENT * batch.n_words)
    labels = field.decode(batch.features, batch.line_doc, len(texts))
    content = np.bincount(batch.line_doc, weights=batch.line_words * labels, minlength=len(texts))
    share = _share(content, batch.n_words)
    return {
        "n_words": batch.n_words, "word_chars": batch.word_chars, "n_symbols": batch.n_symbols,
        "n_dup_lines": batch.n_dup_lines, "n_repeat_words": batch.n_repeat_words,
        "base_failed": failed, "kept": ~failed & (share >= CONTENT_SHARE), "content_share": share,
    }


def quality_rules(docs: DataFrame, field: LineField, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, base verdict, content share and final verdict of every text.

    Null, empty and blank texts have no words: all counts are 0 and they fail. Repeated ids keep
    all their rows; no rows give no rows; other columns are left out.
    """

    def judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, end in _batches(texts):
                found = judge(texts[start:end], field)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), *map(pa.array, found.values())],
                    names=["doc_id", *found],
                )

    return two_columns(docs, id_col, text_col).mapInArrow(judged, QUALITY)


def rated_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns the field from the labels and judges every document."""
    return quality_rules(docs, fit(two_columns(docs, "doc_id", "text"), labels))

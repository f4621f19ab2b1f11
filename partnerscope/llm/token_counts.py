"""Token counts of whole texts, without moving a single pre-token.

Two tiers on the map side: a table of the pre-tokens that are frequent in a sample of the
documents, with their token counts, is broadcast (its size is fixed by parameters); a pre-token
it lacks is encoded once and kept in a cache of the worker. Both only save work: counts never
depend on what they hold, as each entry is the library's own count of that pre-token.

Texts with characters whose class the two regular expression engines might see differently are
counted by the library as a whole.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partnerscope.llm.common import two_columns

LIMIT = 2048
#: The broadcast table: entries, and the longest pre-token it takes. At most 65,536 x 32 letters.
FREQUENT = 65_536
LONGEST = 32
#: Share of the documents that the frequent pre-tokens are looked for in, by a hash of the id,
#: and how many candidates a task of that search returns.
SAMPLE_OF = 64
CANDIDATES = 16_384
#: Entries of a worker's cache; beyond that it starts anew.
CACHE = 400_000
COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

#: Latin, Greek and Cyrillic letters, common punctuation and currency signs: long-settled
#: characters, the same in every version of the character tables.
SETTLED = "\t-\r -~ -ɏͰ-ͳΆ-ώЀ-џḀ-ẕ‐-‧‰-⁞€"


def _pre_token_pattern() -> re.Pattern:
    """The file's pattern for the standard library: letters, one number, or neither."""
    other = "".join(
        re.escape(chr(c))
        for c in range(0x2500)
        if unicodedata.category(chr(c)) in ("Nl", "No")
    )
    letter, number = rf"[^\W\d_{other}]", rf"[\d{other}]"
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|{letter}+|{number}|(?:[^\w\s]|_)+")


class WordCounter:
    """Counts of the lower-casing word vocabulary, pre-token by pre-token."""

    def __init__(self, path: str, frequent: dict[str, int]):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        specials = [re.escape(x["content"]) for x in spec["added_tokens"]]
        self.special = re.compile("|".join(specials)) if specials else None
        self.words = _pre_token_pattern()
        self.odd = re.compile(f"[^{SETTLED}]")
        self.frequent = frequent
        self.cache: dict[str, int] = {}

    def whole(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def pre_tokens(self, text: str) -> list[str] | None:
        """Normalized pre-tokens; nothing if the library has to look at the text itself."""
        if self.odd.search(text):
            return None
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # the library lowers letter by letter, without a final sigma
                text = text.replace("Σ", "σ")
        return self.words.findall(text.lower())

    def missed(self, words: list[str]) -> int:
        """Counts of words the table lacks; new ones are encoded together, a blank between."""
        if len(self.cache) > CACHE:
            self.cache.clear()
        new = list({w for w in words if w not in self.cache})
        if new:
            owners = Counter(self.library.encode(" ".join(new), add_special_tokens=False).word_ids)
            if len(owners) == len(new):
                self.cache.update((word, owners[i]) for i, word in enumerate(new))
            else:
                self.cache.update((word, self.whole(word)) for word in new)
        return sum(map(self.cache.__getitem__, words))

    def count(self, text: str) -> int:
        if self.special is not None and "<" in text and (parts := self.special.split(text))[1:]:
            return len(parts) - 1 + sum(map(self.count, parts))
        words = self.pre_tokens(text)
        if words is None:
            return self.whole(text)
        lengths = list(map(self.frequent.get, words))
        if None not in lengths:
            return sum(lengths)
        known = sum(filter(None, lengths))
        return known + self.missed([w for w, n in zip(words, lengths, strict=True) if n is None])


def frequent_pre_tokens(docs: DataFrame, path: str) -> dict[str, int]:
    """The most frequent pre-tokens of the sample with their token counts."""

    def heads(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, seen = WordCounter(path, {}), Counter()
        for batch in batches:
            for text in batch.column(1):
                seen.update(w for w in counter.pre_tokens(text.as_py()) or () if len(w) <= LONGEST)
            if len(seen) > 16 * CANDIDATES:
                seen = Counter(dict(seen.most_common(4 * CANDIDATES)))
        top = [(w, n) for w, n in seen.most_common(CANDIDATES) if n > 1]
        words = [w for w, _ in top]
        lengths = [len(x.ids) for x in counter.library.encode_batch(words, add_special_tokens=False)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array([n for _, n in top], pa.int64()), pa.array(lengths, pa.int32())],
            names=["word", "n", "length"],
        )

    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_OF)) == 0)
    best = (
        sample.mapInArrow(heads, "word string, n long, length int")
        .groupBy("word", "length")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(FREQUENT)
    )
    return {sys.intern(r["word"]): r["length"] for r in best.collect()}


@lru_cache(maxsize=2)
def _worker_counter(path: str, packed: bytes) -> WordCounter:
    words, lengths = json.loads(packed)
    return WordCounter(path, dict(zip(words, lengths, strict=True)))


def token_counts(
    docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Bytes and tokens of every text, and whether it has more than ``limit`` tokens.

    Null and empty texts have none of either. Repeated ids keep all their rows; no rows give
    no rows; other columns are left out, whatever their names.
    """
    rows = two_columns(docs, id_col, text_col)
    frequent = frequent_pre_tokens(rows, tokenizer_path)
    packed = json.dumps([list(frequent), list(frequent.values())]).encode()
    table = docs.sparkSession.sparkContext.broadcast(packed)

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _worker_counter(tokenizer_path, table.value)
        for batch in batches:
            sizes, tokens = [], []
            for cell in batch.column(1):
                text = cell.as_py()
                sizes.append(len(text.encode("utf-8")))
                tokens.append(counter.count(text))
            n = pa.array(tokens, pa.int64())
            over = pa.array([x > limit for x in tokens], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), n, over],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return rows.mapInArrow(counted, COUNTS)

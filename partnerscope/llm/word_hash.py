"""Words of many texts at once, as 64-bit hashes, without a Python object for each."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of texts that are taken together; a longer text is taken alone.
CHUNK_BYTES = 1 << 20
#: Places of a word that have numbers of their own; later ones use them again, multiplied.
PLACES = 64

_numbers = np.random.default_rng(20240613).integers(0, 2**64, size=(PLACES, 256), dtype=np.uint64)
_numbers[:, ord("A") : ord("Z") + 1] = _numbers[:, ord("a") : ord("z") + 1]
_AGAIN = np.uint64(0x9E3779B97F4A7C15)
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def byte_class(members: bytes) -> np.ndarray:
    found = np.zeros(256, dtype=bool)
    found[list(members)] = True
    return found


@dataclass
class Words:
    """How many words each text has, where in the joined bytes they stand, and their hashes."""

    joined: np.ndarray
    lengths: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def word(self, k: int) -> str:
        """A word with A-Z lowered."""
        raw = self.joined[self.start[k] : self.end[k]].tobytes()
        return raw.translate(LOWER).decode("utf-8", "surrogatepass")

    def apart(self, marks: np.ndarray) -> np.ndarray:
        """Whether a byte of a class, or the end of a text, stands between a word and the one before."""
        seen = np.cumsum(marks[self.joined], dtype=np.int64)[self.start] if len(self.start) else np.zeros(0, np.int64)
        return np.diff(seen, prepend=-1) > 0


class Splitter:
    """Words as runs of bytes that are not in a class, which must hold the line feed.

    The hash adds a random number for each byte and place (tabulation), A-Z taken as a-z, so two
    different words have equal hashes with a probability of 2**-64.
    """

    def __init__(self, between: bytes):
        self.between = byte_class(between)
        self.table = np.where(self.between, np.uint64(0), _numbers).reshape(-1)

    def words(self, texts: list[bytes]) -> Words:
        joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        inside = np.concatenate([[False], ~self.between[joined], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[::2], edges[1::2]
        begun = np.zeros(len(joined), np.int32 if len(joined) < 1 << 30 else np.int64)
        begun[start] = start
        place = np.arange(len(joined), dtype=begun.dtype) - np.maximum.accumulate(begun)
        value = self.table[((place & (PLACES - 1)) << 8) | joined]
        if len(start) and (end - start).max() > PLACES:
            late = np.flatnonzero(place >= PLACES)
            value[late] *= _AGAIN * (2 * (place[late] // PLACES).astype(np.uint64) + np.uint64(1))
        hashes = np.add.reduceat(value, start) if len(start) else np.zeros(0, np.uint64)
        until = np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts]))
        return Words(joined, np.diff(until, prepend=0), start, end, hashes)


def text_chunks(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[tuple[pa.Table, list[bytes]]]:
    """Rows of a bounded number of bytes of texts, and their texts; nulls are empty."""
    rows: list[pa.RecordBatch] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        first = 0
        for k, text in enumerate(batch.column(column).cast(pa.binary()).to_pylist()):
            texts.append(text or b"")
            size += len(texts[-1])
            if size >= CHUNK_BYTES:
                yield pa.Table.from_batches([*rows, batch.slice(first, k + 1 - first)]), texts
                rows, texts, size, first = [], [], 0, k + 1
        if first < batch.num_rows:
            rows.append(batch.slice(first))
    if texts:
        yield pa.Table.from_batches(rows), texts

"""Packing of tokenized documents into sequences of fixed size.

A document becomes pieces of at most ``capacity`` tokens. How many pieces there are of each
length (at most ``capacity`` numbers, whatever the input) decides the whole plan:

* Exact complements: lengths that fill a sequence alone, in pairs or in threes are looked up
  by the sum that is missing and used up as often as both counts allow.
* Best fit: what is left goes, longest first, where the smallest gap is large enough; equal
  gaps are handled together, so the plan has some thousand lines for any input.

The plan says for the k-th piece of a length in which sequence it lies and where. Pieces are
numbered within their length part by part, so a length that most pieces have is split.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partnerscope.llm.common import Work, buckets, two_columns

CAPACITY = 1024
END_ID = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class ByteEncoder:
    """Ids of the byte-level vocabulary file, by the faster of its two public encoders.

    Both encoders share vocabulary, merges and pattern. A text that the faster one refuses
    goes to the library that defines the ids.
    """

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        # The file writes bytes as letters: printable ones as themselves, the rest from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        as_byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {
            bytes(as_byte[c] for c in token): number
            for token, number in spec["model"]["vocab"].items()
            if token not in specials
        }
        self.fast = tiktoken.Encoding(
            "byte_bpe",
            pat_str=r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
            mergeable_ranks=ranks,
            special_tokens=specials,
        )

    def ids(self, text: str) -> np.ndarray:
        try:
            return np.asarray(self.fast.encode_to_numpy(text, allowed_special="all"), dtype="<u4")
        except BaseException as problem:  # the fast encoder's panics are no Exceptions
            if isinstance(problem, (KeyboardInterrupt, SystemExit)):
                raise
            return np.asarray(self.exact.encode(text, add_special_tokens=False).ids, dtype="<u4")


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


def piece_bounds(total: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Starts and lengths; only the first piece of a long document is shorter than full."""
    first = total % capacity or min(total, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, total, capacity)]


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: its document, place and length, and a checksum of its ids."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(tokenizer_path)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.concatenate([encoder.ids(text.as_py()), end])
                for number, (start, length) in enumerate(piece_bounds(len(ids), capacity)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    for column, value in zip(out, (doc, number, start, length, crc), strict=True):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ("doc_id", "piece", "start", "length", "ids_crc32")
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types, strict=True)], names=list(names)
            )

    return two_columns(docs, id_col, text_col).mapInArrow(cut, PIECES)


Group = tuple[tuple[tuple[int, int], ...], int]  # lengths with their number per sequence; sequences


def exact_complements(counts: dict[int, int], capacity: int) -> tuple[list[Group], dict[int, int]]:
    """Sequences filled to the last token by one, two or three pieces, and the counts left."""
    left = dict(counts)
    groups: list[Group] = []

    def use(*lengths: int) -> None:
        need = {x: lengths.count(x) for x in lengths}
        times = min(left.get(x, 0) // n for x, n in need.items())
        if times > 0:
            for x, n in need.items():
                left[x] -= n * times
            groups.append((tuple(need.items()), times))

    use(capacity)
    for a in sorted((x for x in counts if 2 * x >= capacity), reverse=True):
        if capacity - a in left:
            use(a, capacity - a)
    descending = sorted((x for x, n in left.items() if n > 0), reverse=True)
    for a in descending:
        for b in descending:
            if b > a or a + 2 * b < capacity:
                continue
            if not left[a]:
                break
            c = capacity - a - b
            if c > 0 and left[b] and left.get(c, 0):
                use(a, b, c)
    return groups, {x: n for x, n in left.items() if n > 0}


def best_fit(counts: dict[int, int], capacity: int) -> list[Group]:
    """Best fit of the longest first, equal sequences handled together."""
    gaps: list[int] = []
    by_gap: dict[int, list[Group]] = {}

    def put(group: Group, gap: int) -> None:
        if gap not in by_gap:
            by_gap[gap] = []
            insort(gaps, gap)
        by_gap[gap].append(group)

    for length in sorted(counts, reverse=True):
        todo = counts[length]
        while todo:
            at = bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                content, number = by_gap[gap].pop()
                if not by_gap[gap]:
                    del by_gap[gap], gaps[at]
            else:
                gap, content, number = capacity, (), todo
            each = min(gap // length, todo)
            used = min(number, todo // each)
            todo -= each * used
            put((content + ((length, each),), used), gap - each * length)
            if used < number and gap < capacity:
                put((content, number - used), gap)
    return [group for at in gaps for group in by_gap[at]]


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """Exact complements, then best fit; best fit alone where that needs fewer sequences."""
    exact, left = exact_complements(counts, capacity)
    both = exact + best_fit(left, capacity)
    alone = best_fit(counts, capacity)
    return min(both, alone, key=lambda plan: sum(n for _, n in plan))


def slots(plan: list[Group]) -> dict[str, np.ndarray]:
    """For each length the ranks of its pieces, with sequence and offset of the first."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for content, number in plan:
        offset = 0
        for length, each in content:
            rank = used.get(length, 0)
            rows.append((length, rank, each, sequence, offset))
            used[length] = rank + each * number
            offset += each * length
        sequence += number
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "each", "sequence", "offset"), columns, strict=True))


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every piece with its sequence and its place there.

    Null and empty texts are one piece holding the end id. Repeated document ids keep all
    their rows. No documents give no rows. Equal lengths take their places in the order of a
    hash of the document, so the result doesn't depend on how the input is split.
    """
    spark = docs.sparkSession
    work = Work(spark, "pack")
    cut = work.keep(pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pieces")
    parts = buckets(spark)
    spread = cut.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int"))
    sizes = work.keep(spread.groupBy("length", "part").agg(F.count("*").alias("n")), "sizes")
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = slots(packing_plan(counts, capacity))
    before = sizes.select(
        F.col("length").alias("of_length"),
        F.col("part").alias("of_part"),
        (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"),
    )
    in_part = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        spread.withColumn("within", F.row_number().over(in_part) - 1)
        .join(before, (F.col("length") == F.col("of_length")) & (F.col("part") == F.col("of_part")))
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("within")).alias("rank"))
    )
    placed = ranked.mapInPandas(
        lambda frames: (_placed(frame, plan) for frame in frames),
        PIECES + ", sequence_id long, offset long",
    )
    return work.finish(placed)


def _placed(frame, plan: dict[str, np.ndarray]):
    length, rank = frame.pop("length").to_numpy(), frame.pop("rank").to_numpy()
    far = np.int64(1) << 48
    at = np.searchsorted(plan["length"] * far + plan["rank"], length * far + rank, side="right") - 1
    beyond, each = rank - plan["rank"][at], plan["each"][at]
    frame["length"] = length
    frame["sequence_id"] = plan["sequence"][at] + beyond // each
    frame["offset"] = plan["offset"][at] + (beyond % each) * length
    return frame[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

"""Removal of word windows that an earlier document has too, by relative Lempel-Ziv parsing.

Every document is parsed against blocks of all documents with smaller ids.

* Blocks. Each window of ``window`` words picks the run of ``gram`` words in it whose hash is
  least (its anchor). Consecutive windows with the same anchor make up a block: the words that
  those windows cover. Equal windows pick equal anchors, wherever they stand.
* Index of blocks. For each anchor: whether all its blocks are equal, and the smallest document
  that has one. The parse copies such blocks whole (a long copied passage is a row of them).
* Factor boundaries. Where a copied passage begins or ends, an anchor has blocks that differ.
  Their windows, and no others, are looked up one by one: the smallest document of each window.
* All windows found in an earlier document are duplicate spans; the words they cover go.

No word is missed: an equal pair of windows has an equal anchor, so its block is either equal as
a whole or looked up window by window. The index never leaves the shuffles. Documents are kept in
chunks; a chunk sends each anchor and each window at most once, so that a passage in a third of
all documents is a row for each chunk, not for each document. The answers come back to the chunk,
whose documents lie in a table bucketed by chunk: texts are shuffled in none of the three steps.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partnerscope.llm.common import WORD, Work, buckets

WINDOW = 13
#: Documents of a chunk.
CHUNK_ROWS = 256
#: A text longer than this has a chunk of its own, so a chunk stays within some 30 MB.
LONG_TEXT = 1 << 17
FACTOR = 0x9E3779B97F4A7C15
FACTOR_BACK = pow(FACTOR, -1, 1 << 64)
#: Bits of an anchor's hash. Anchors that share them are only looked at more closely.
ANCHOR_BITS = np.uint64(40)
LAST_ID = np.int64((1 << 63) - 1)

PARCEL = "bucket int, chunk long, n int, data binary"
REPLY = "chunk long, kind int, bucket int, n int, data binary"


def planes(*columns: np.ndarray) -> bytes:
    """64-bit columns byte by byte, most significant first, so that equal high bytes compress."""
    return b"".join(c.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns)


def unplanes(data: bytes, n: int) -> list[np.ndarray]:
    rows = np.frombuffer(data, np.uint8).reshape(-1, 8, n)
    return [np.ascontiguousarray(r.T).view(">u8").ravel().astype(np.uint64) for r in rows]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def powers(factor: int, n: int) -> np.ndarray:
    steps = np.full(n, factor, dtype=np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def least_per_group(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the group of each row, and the smallest id of each group."""
    distinct, group = np.unique(keys, return_inverse=True)
    least = np.full(len(distinct), LAST_ID)
    np.minimum.at(least, group, ids)
    return distinct, group, least


class Parse:
    """Blocks and windows of the documents of one chunk."""

    def __init__(self, texts: list[str | None], ids: np.ndarray, window: int, parts: int):
        self.window, self.parts, self.ids = window, parts, ids
        words = [(text or "").encode("utf-8", "surrogatepass").split() for text in texts]
        self.words = words
        self.sizes = np.array([len(w) for w in words], dtype=np.int64)
        total = int(self.sizes.sum())
        h = np.fromiter(
            (x for w in words for x in map(xxhash.xxh3_64_intdigest, w)), dtype=np.uint64, count=total
        )
        h = mixed(h)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * powers(FACTOR, total), dtype=np.uint64)])
        self.back = powers(FACTOR_BACK, total + 1)
        owner = np.repeat(np.arange(len(words)), self.sizes)
        at = np.arange(max(0, total - window + 1))
        at = at[owner[at] == owner[at + window - 1]] if len(at) else at
        gram = max(1, (window - 1) // 2)
        grams = self.run_hash(np.arange(max(0, total - gram + 1)), gram)
        low = np.uint64(0xFFFFFFFF)
        least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        width, reach = window - gram + 1, 1
        while reach < width:  # least of each window by least of its halves
            step = min(reach, width - reach)
            least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
            reach += step
        anchor = (least[at] & low).astype(np.int64)
        new = np.ones(len(at), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(new)
        self.start = at[first]
        self.count = np.diff(np.append(first, len(at)))
        self.document = owner[self.start] if total else np.zeros(0, np.int64)
        self.block_ids = ids[self.document]
        keys = grams[anchor[first]] >> (np.uint64(64) - ANCHOR_BITS)
        content = (self.run_hash(self.start, self.count + window - 1) >> np.uint64(16)) | np.uint64(1)
        self.anchors, self.anchor_of, self.anchor_least = least_per_group(self.in_parts(keys), self.block_ids)
        few, many = np.full(len(self.anchors), ~np.uint64(0)), np.zeros(len(self.anchors), np.uint64)
        np.minimum.at(few, self.anchor_of, content)
        np.maximum.at(many, self.anchor_of, content)
        #: One content of all blocks of the anchor, or 0 where they differ.
        self.content = np.where(few == many, few, np.uint64(0))

    def run_hash(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return mixed((self.sums[start + length] - self.sums[start]) * self.back[start] + np.asarray(length, np.uint64))

    def in_parts(self, keys: np.ndarray) -> np.ndarray:
        """The keys in an order that has those of a part together: part, then the rest of the key."""
        return ((keys % np.uint64(self.parts)) << np.uint64(48)) | (keys // np.uint64(self.parts))

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the windows of the chosen blocks, and the block of each."""
        block = np.repeat(np.flatnonzero(chosen), self.count[chosen])
        first = np.repeat(np.cumsum(self.count[chosen]) - self.count[chosen], self.count[chosen])
        return self.start[block] + np.arange(len(block)) - first, block

    def parcels(self, chunk: int, part: np.ndarray, *columns: np.ndarray) -> pa.Table:
        """One row per part, from columns ordered by part."""
        ends = np.searchsorted(part, np.arange(self.parts + 1))
        full = [(p, a, b) for p, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if a < b]
        return pa.table(
            {
                "bucket": pa.array([p for p, _, _ in full], pa.int32()),
                "chunk": pa.array([chunk] * len(full), pa.int64()),
                "n": pa.array([int(b - a) for _, a, b in full], pa.int32()),
                "data": pa.array([planes(*[c[a:b] for c in columns]) for _, a, b in full], pa.binary()),
            }
        )

    def anchor_part(self) -> np.ndarray:
        return (self.anchors >> np.uint64(48)).astype(np.int64)

    def window_keys(self, unsure: np.ndarray) -> tuple:
        """Windows of blocks whose anchor is unsure: place and block; distinct hashes, in which
        order of parts they go out, the distinct hash of each window, and its smallest id here."""
        place, block = self.windows(unsure[self.anchor_of])
        keys, group, least = least_per_group(self.run_hash(place, self.window), self.block_ids[block])
        part = (keys % np.uint64(self.parts)).astype(np.int64)
        return place, block, keys, group, least, part, np.argsort(part, kind="stable")

    def removed(self, anchor_replies: list, window_replies: list) -> np.ndarray:
        """For each word whether a window of an earlier document covers it."""
        least, unsure = self.anchor_least.copy(), self.content == 0
        self._answer(anchor_replies, self.anchor_part(), np.arange(len(least)), least, unsure)
        whole = ~unsure[self.anchor_of] & (least[self.anchor_of] < self.block_ids)
        covered = np.zeros(int(self.sizes.sum()) + 1, dtype=np.int64)
        np.add.at(covered, self.start[whole], 1)
        np.add.at(covered, (self.start + self.count + self.window - 1)[whole], -1)
        place, block, _, group, first, part, order = self.window_keys(unsure)
        self._answer(window_replies, part[order], order, first, None)
        early = place[first[group] < self.block_ids[block]]
        np.add.at(covered, early, 1)
        np.add.at(covered, early + self.window, -1)
        return np.cumsum(covered)[:-1] > 0

    def unsure(self, anchor_replies: list) -> np.ndarray:
        found = self.content == 0
        self._answer(anchor_replies, self.anchor_part(), np.arange(len(found)), self.anchor_least.copy(), found)
        return found

    def _answer(self, replies: list, part: np.ndarray, order: np.ndarray, least: np.ndarray, unsure) -> None:
        """Enters the replies: a place in the parcel of a part, a mark, and an id."""
        ends = np.searchsorted(part, np.arange(self.parts + 1))
        for bucket, n, data in replies:
            place, value = unplanes(data, n)
            mark = (place & np.uint64(1)).astype(bool)
            rows = order[ends[bucket] + (place >> np.uint64(1)).astype(np.int64)]
            if unsure is not None:
                unsure[rows[mark]] = True
            least[rows[~mark]] = np.minimum(least[rows[~mark]], value[~mark].view(np.int64))


def _joined(table: pa.Table) -> Iterator[tuple[np.ndarray, list[np.ndarray], list[tuple[int, int, int]]]]:
    """Parcels of a bucket put together: row of each entry, the columns, and rows' (chunk, from, to)."""
    parts, spans, at = [], [], 0
    for chunk, n, data in zip(
        table.column("chunk").to_pylist(), table.column("n").to_pylist(), table.column("data"), strict=True
    ):
        parts.append(unplanes(data.as_buffer(), n))
        spans.append((chunk, at, at + n))
        at += n
    return [np.concatenate(c) for c in zip(*parts, strict=True)], spans


def _replies(bucket: int, kind: int, spans: list, mark: np.ndarray, value: np.ndarray, send: np.ndarray) -> pa.Table:
    rows: list[tuple] = []
    for chunk, a, b in spans:
        own = np.flatnonzero(send[a:b])
        if len(own):
            place = (own.astype(np.uint64) << np.uint64(1)) | mark[a:b][own].astype(np.uint64)
            rows.append((chunk, kind, bucket, len(own), planes(place, value[a:b][own].view(np.uint64))))
    types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
    columns = list(zip(*rows, strict=True)) or [()] * 5
    return pa.table(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["chunk", "kind", "bucket", "n", "data"]
    )


def settle_anchors(key: tuple, table: pa.Table) -> pa.Table:
    """For each anchor of a bucket: differing blocks, or the smallest document that has its block."""
    (keys, content, ids), spans = _joined(table)
    _, group, least = least_per_group(keys, ids.view(np.int64))
    few, many = np.full(len(least), ~np.uint64(0)), np.zeros(len(least), np.uint64)
    np.minimum.at(few, group, content)
    np.maximum.at(many, group, content)
    differ = ((few != many) | (few == 0))[group]
    value = least[group]
    send = (differ & (content != 0)) | (~differ & (value < ids.view(np.int64)))
    return _replies(key[0].as_py(), 0, spans, differ, value, send)


def settle_windows(key: tuple, table: pa.Table) -> pa.Table:
    """For each window of a bucket the smallest document that has it."""
    (keys, ids), spans = _joined(table)
    _, group, least = least_per_group(keys, ids.view(np.int64))
    value = least[group]
    return _replies(key[0].as_py(), 1, spans, np.zeros(len(keys), bool), value, value < ids.view(np.int64))


def _answers(replies: pa.Table, kind: int) -> list[tuple[int, int, memoryview]]:
    return [
        (b, n, d.as_buffer())
        for k, b, n, d in zip(
            replies.column("kind").to_pylist(), replies.column("bucket").to_pylist(), replies.column("n").to_pylist(),
            replies.column("data"), strict=True,
        )
        if k == kind
    ]


Finish = Callable[[pa.Table, list[list[bytes]], list[np.ndarray]], pa.Table]


def parse(docs: DataFrame, id_col: str, text_col: str, window: int, finish: Finish, schema: T.StructType) -> DataFrame:
    """Runs ``finish`` on each chunk with the words of its documents and which of them go."""
    spark = docs.sparkSession
    work, parts = Work(spark, "substring"), buckets(spark)
    chunk_col = next(n for n in ("chunk", *(f"chunk_{i}" for i in range(len(docs.columns) + 1))) if n not in docs.columns)
    name = f"llm_chunks_{uuid.uuid4().hex}"
    joint = F.shiftright(F.col(chunk_col), CHUNK_ROWS.bit_length() - 1)
    (
        docs.withColumn(chunk_col, F.monotonically_increasing_id())
        .withColumn(chunk_col, F.when(F.length(text_col) > LONG_TEXT, -1 - F.col(chunk_col)).otherwise(joint))
        .write.bucketBy(parts, chunk_col)
        .option("path", f"{work.folder}/chunks")
        .option("compression", "zstd")
        .saveAsTable(name)
    )
    chunks = spark.table(name)

    def parsed(table: pa.Table) -> Parse:
        ids = table.column(id_col).cast(pa.int64()).fill_null(int(LAST_ID)).to_numpy()
        return Parse(table.column(text_col).cast(pa.string()).to_pylist(), ids, window, parts)

    def anchors(key: tuple, table: pa.Table) -> pa.Table:
        own = parsed(table)
        rest = own.anchors & np.uint64((1 << 48) - 1)
        return own.parcels(key[0].as_py(), own.anchor_part(), rest, own.content, own.anchor_least)

    def windows(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("n", pa.int32()), ("data", pa.binary())]).empty_table()
        own = parsed(table)
        _, _, keys, _, least, part, order = own.window_keys(own.unsure(_answers(replies, 0)))
        return own.parcels(key[0].as_py(), part[order], keys[order], least[order])

    def last(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        own = parsed(table)
        goes = own.removed(_answers(replies, 0), _answers(replies, 1))
        masks = np.split(goes, np.cumsum(own.sizes)[:-1])
        return finish(table.drop_columns([chunk_col]), own.words, masks)

    by_chunk = chunks.groupBy(chunk_col)
    sent = by_chunk.applyInArrow(anchors, PARCEL)
    blocks = work.keep(sent.groupBy("bucket").applyInArrow(settle_anchors, REPLY), "blocks")
    sent = by_chunk.cogroup(blocks.groupBy("chunk")).applyInArrow(windows, PARCEL)
    edges = work.keep(sent.groupBy("bucket").applyInArrow(settle_windows, REPLY), "edges")
    result = work.finish(by_chunk.cogroup(blocks.unionAll(edges).groupBy("chunk")).applyInArrow(last, schema))
    spark.sql(f"DROP TABLE {name}")
    work.remove(f"{work.folder}/chunks")
    return result


def kept_text(text: str, goes: np.ndarray) -> str:
    """The text without the words that go; the blanks after a removed run go with it."""
    if not goes.any():
        return text
    spans = [m.span() for m in WORD.finditer(text)]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], goes, [False]])))
    out, at = [], 0
    for first, end in zip(edges[::2], edges[1::2], strict=True):
        out.append(text[at : spans[first][0]])
        at = spans[end][0] if end < len(spans) else spans[end - 1][1]
    out.append(text[at:])
    return "".join(out)


def without_repeats(docs: DataFrame, window: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, with their texts freed of windows that an earlier one has.

    Null texts stay null and empty ones empty; texts shorter than the window stay. Rows of equal
    id are one document: none of them is earlier than the other. Rows without id are later than
    all others and equal among themselves. No rows give no rows.
    """
    text_at = docs.columns.index(text_col)

    def finish(table: pa.Table, words: list, masks: list[np.ndarray]) -> pa.Table:
        texts = table.column(text_at).to_pylist()
        kept = [t if t is None else kept_text(t, m) for t, m in zip(texts, masks, strict=True)]
        return table.set_column(text_at, text_col, pa.array(kept, pa.string()))

    return parse(docs, id_col, text_col, window, finish, docs.schema)


DIGEST = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
    ]
)


def repeat_digest(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words, removed words, and a checksum of the words kept, of every document."""

    def finish(table: pa.Table, words: list[list[bytes]], masks: list[np.ndarray]) -> pa.Table:
        sums = []
        for own, goes in zip(words, masks, strict=True):
            kept = [w for w, gone in zip(own, goes.tolist(), strict=True) if not gone] if goes.any() else own
            sums.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        return pa.table(
            {
                "doc_id": table.column(0).cast(pa.int64()),
                "n_words": pa.array([len(w) for w in words], pa.int64()),
                "n_removed": pa.array([int(m.sum()) for m in masks], pa.int64()),
                "kept_sha256": pa.array(sums, pa.string()),
            }
        )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return parse(rows, "doc_id", "text", window, finish, DIGEST)


def oracle_sql(window: int = WINDOW) -> str:
    """``repeat_digest`` of the table documents in DuckDB's SQL."""
    return f"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\x0C\r]+') AS ws FROM documents),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + {window - 1}], ' ') AS words FROM (SELECT *, unnest(range(1, len(ws) - {window - 2})) AS i FROM docs)),
firsts AS (SELECT words, min(doc_id) AS first_id FROM windows GROUP BY words),
repeated AS (SELECT doc_id, i FROM windows JOIN firsts USING (words) WHERE first_id < doc_id),
covered AS (SELECT DISTINCT doc_id, i + j AS p FROM repeated, range({window}) AS steps(j)),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM docs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM words ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

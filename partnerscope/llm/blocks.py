"""Counted keys as sorted runs, and tables in blocks that tasks load from the shared folder.

A key is a 64-bit number. Tasks count keys in bounded memory and hand on sorted runs, cut by the
key's block; the runs of a block are merged in one group, whose size the number of blocks bounds.
The merged blocks are files in the shared folder. A task that looks keys up sorts them by block
and loads one block after the other; a worker keeps the first ones, up to a number of bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from partnerscope.llm.common import Work

#: Keys that a task holds before it hands on runs.
HELD_KEYS = 2_000_000
#: Keys that the runs of one block hold at most, before equal ones of different runs are merged.
BLOCK_KEYS = 2_000_000
#: Bytes of loaded blocks that a worker keeps; others are loaded again for each lookup.
KEPT_BYTES = 112 << 20

RUNS = "block int, run binary"
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Keys that agree in all higher bits share a block, so that neighbours are packed well.
NEAR_BITS = np.uint64(12)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def block_of(keys: np.ndarray, blocks: int) -> np.ndarray:
    high = mixed((keys >> NEAR_BITS) + np.uint64(1)) >> np.uint64(32)
    return ((high * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)


def by_block(keys: np.ndarray, blocks: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each block that keys belong to, and their places."""
    block = block_of(keys, blocks)
    order = np.argsort(block, kind="stable")
    present, first = np.unique(block[order], return_index=True)
    yield from zip(present.tolist(), np.split(order, first[1:]), strict=False)


def blocks_for(keys: int) -> int:
    """Blocks for so many keys, counted as often as they occur."""
    return max(1, -(-keys // BLOCK_KEYS))


def _planes(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)


def packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys as differences, and counts, byte by byte, compressed."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return zstandard.compress(np.concatenate([_planes(steps), _planes(counts)], axis=1).tobytes(), 1)


def unpacked(run: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(run), np.uint8).reshape(8, -1)
    both = np.ascontiguousarray(planes.T).view("<u8").reshape(-1)
    n = len(both) // 2
    return np.cumsum(both[:n], dtype=np.uint64), both[n:].astype(np.int64)


def counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct keys with the sums of their counts."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    if counts is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def cut(keys: np.ndarray, counts: np.ndarray, blocks: int) -> Iterator[tuple[int, bytes]]:
    """The runs of each block, from ascending keys."""
    for b, own in by_block(keys, blocks):
        yield b, packed(keys[own], counts[own])


def run_batch(runs: Iterable[tuple[int, bytes]]) -> pa.RecordBatch:
    rows = list(runs)
    return pa.RecordBatch.from_arrays(
        [pa.array([b for b, _ in rows], pa.int32()), pa.array([r for _, r in rows], pa.binary())], names=["block", "run"]
    )


def sorted_runs(keys: Iterable[np.ndarray], blocks: int) -> Iterator[pa.RecordBatch]:
    """Runs of all the keys; the task holds a bounded number."""
    held: list[np.ndarray] = []
    number = 0
    for some in keys:
        held.append(some)
        number += len(some)
        if number >= HELD_KEYS:
            yield run_batch(cut(*counted(np.concatenate(held)), blocks))
            held, number = [], 0
    if number:
        yield run_batch(cut(*counted(np.concatenate(held)), blocks))


def merged(runs: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = [unpacked(r) for r in runs]
    return counted(np.concatenate([k for k, _ in both]), np.concatenate([c for _, c in both]))


def counts_by_block(runs: DataFrame, least: int = 1) -> DataFrame:
    """A row for each block: its ascending keys that have the least count, and their counts."""

    def of_block(table: pa.Table) -> pa.Table:
        keys, counts = merged(table.column("run").to_pylist())
        kept = counts >= least
        return block_row(table.column("block")[0].as_py(), keys[kept], counts[kept])

    return runs.groupBy("block").applyInArrow(of_block, COUNTS)


COUNTS = "block int, size long, total long, keys array<bigint>, counts array<bigint>"


def block_row(block: int, keys: np.ndarray, counts: np.ndarray) -> pa.Table:
    longs = pa.list_(pa.int64())
    columns = [pa.array([block], pa.int32()), pa.array([len(keys)]), pa.array([int(counts.sum())])]
    columns += [pa.array([keys.view(np.int64)], longs), pa.array([counts.astype(np.int64)], longs)]
    return pa.table(columns, names=["block", "size", "total", "keys", "counts"])


#: The blocks of one run's tables that this worker keeps, by file.
_kept: dict[str, dict[str, np.ndarray]] = {}
_run: list[str] = [""]


def _loaded(uri: str) -> dict[str, np.ndarray]:
    """The columns of a block's file, each a flat array.

    Kept while there is room, and then never replaced: lookups take blocks in turn, so the
    oldest would be the next one needed.
    """
    import pyarrow.parquet as pq
    from pyarrow import fs

    if uri in _kept:
        return _kept[uri]
    run = uri.rsplit("/", 3)[0]
    if run != _run[0]:
        _run[0] = run
        _kept.clear()
    store, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    with store.open_input_file(path) as file:
        table = pq.ParquetFile(file).read()
    columns = {}
    for name in table.column_names:
        column = table.column(name).combine_chunks()
        if pa.types.is_list(column.type):
            column = column.flatten()
        if pa.types.is_binary(column.type):
            columns[name] = np.frombuffer(column.buffers()[2], np.uint8)
        else:
            columns[name] = np.array(column)
    if sum(c.nbytes for kept in [columns, *_kept.values()] for c in kept.values()) <= KEPT_BYTES:
        _kept[uri] = columns
    return columns


@dataclass
class Blocks:
    """A written table of blocks, one file each; blocks without keys have none."""

    number: int
    files: dict[int, str]

    def parts(self, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray, dict[str, np.ndarray]]]:
        """Block by block: its number, the places of the keys that belong there, and its columns."""
        for b, own in by_block(keys, self.number):
            if b in self.files:
                yield b, own, _loaded(self.files[b])

    def places(self, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, dict[str, np.ndarray]]]:
        """Block by block: which of the keys it has, and where among its own keys they stand."""
        for b, own, columns in self.parts(keys):
            held = columns["keys"].view(np.uint64)
            if len(held):
                at = np.minimum(np.searchsorted(held, keys[own]), len(held) - 1)
                same = held[at] == keys[own]
                yield b, own[same], at[same], columns

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """The count of each key, 0 for those that no block has."""
        found = np.zeros(len(keys), np.int64)
        for _, own, at, columns in self.places(keys):
            found[own] = columns["counts"][at]
        return found


def written(df: DataFrame, number: int, work: Work, name: str) -> tuple[Blocks, DataFrame]:
    """Writes a frame that has one row for each block, and reads it back as blocks and as a frame."""
    from urllib.parse import unquote

    place = f"{work.folder}/{name}"
    df.write.option("compression", "zstd").partitionBy("block").parquet(place)
    frame = df.sparkSession.read.schema(df.schema).parquet(place)
    work.kept.append((frame, place))
    files = {int(f.rpartition("/block=")[2].partition("/")[0]): unquote(f) for f in frame.inputFiles()}
    return Blocks(number, files), frame

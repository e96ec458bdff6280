"""Blocks of documents that ask hash buckets about their keys and get answers in the order they asked.

A block is some megabytes of documents of one input partition. It sends every bucket the sorted distinct
keys it has there, packed in one row; the bucket answers each block with one packed row. Compared with a row
per key this moves a third of the bytes. What is packed, and the texts of a block, are compressed as one. Blocks are numbered by partition and place, which is the same
whenever the same scan runs again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import BLOCK_BYTES, blocks

ASKED = "bucket int, block long, kind int, keys binary, low binary, high binary"
ANSWER = "block long, kind int, bucket int, data binary"
BUCKET_BYTES = 32_000_000
LEVEL = 6


def bucket_number(docs: DataFrame, text: str) -> int:
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(8, -(-total // BUCKET_BYTES))


def numbered(batches: Iterator[pa.RecordBatch], block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, list[int | None], list[bytes]]]:
    """(block, ids, texts) of batches (doc_id, text)."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for begin in range(0, len(ids), 4096):
            for start, run in blocks(batch.column(1).slice(begin, 4096).to_pylist(), block_bytes):
                yield number, ids[begin + start:begin + start + len(run)], run
                number += 1


def packed(keys: np.ndarray) -> bytes:
    """Ascending keys (uint64) as differences, all lowest bytes first: the highest are zero and compress away."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    return gaps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    gaps = np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T.copy().view(np.uint64)
    return np.cumsum(gaps.ravel(), dtype=np.uint64)


def squeezed(data: bytes) -> bytes:
    """``data`` compressed, its size before it."""
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", LEVEL).compress(data, asbytes=True) if data else b""


def opened(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True) if data else b""


def squeezed_keys(data: bytes) -> bytes:
    """Packed keys: their high bytes say little and are compressed apart from the low ones."""
    low = squeezed(data[: len(data) // 8 * 5])
    return len(low).to_bytes(8, "little") + low + squeezed(data[len(data) // 8 * 5:])


def opened_keys(data: bytes) -> bytes:
    end = 8 + int.from_bytes(data[:8], "little")
    return opened(data[8:end]) + opened(data[end:])


def asked_ranges(block: int, kind: int, keys: np.ndarray, low: np.ndarray, buckets: int) -> list[tuple]:
    """The packed rows for ascending, evenly spread ``keys`` (uint64); answers come in their order.

    A bucket has a range of the keys, so that the differences between them stay small however many buckets there are.
    """
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    ends = np.searchsorted(bucket, np.arange(buckets + 1))
    found = np.flatnonzero(ends[1:] > ends[:-1]).tolist()
    return [(b, block, kind, packed(keys[ends[b]:ends[b + 1]]), low[ends[b]:ends[b + 1]].tobytes(), b"") for b in found]


def asked(block: int, kind: int, keys: np.ndarray, low: np.ndarray, high: np.ndarray, buckets: int) -> tuple[list[tuple], np.ndarray]:
    """The packed rows for distinct ``keys`` (uint64), and the order in which the answers come."""
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((keys, bucket))
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = []
    for b in np.flatnonzero(ends[1:] > ends[:-1]).tolist():
        own = order[ends[b]:ends[b + 1]]
        rows.append((b, block, kind, packed(keys[own]), low[own].tobytes() if len(low) else b"", high[own].tobytes() if len(high) else b""))
    return rows, order


def asked_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [*zip(*[(*row[:3], squeezed_keys(row[3]), *map(squeezed, row[4:])) for row in rows])] if rows else [[]] * 6
    types = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], ["bucket", "block", "kind", "keys", "low", "high"])


def answers(rows: DataFrame, resolve: Callable[[int, list[np.ndarray], list[bytes], list[bytes]], list[bytes]]) -> DataFrame:
    """What ``resolve(kind, keys, low, high)`` answers to the blocks of a bucket, a row for each of them."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        keys = [unpacked(opened_keys(x)) for x in table.column("keys").to_pylist()]
        low, high = (list(map(opened, table.column(c).to_pylist())) for c in ("low", "high"))
        data = resolve(table.column("kind")[0].as_py(), keys, low, high)
        return pa.table([table.column("block"), table.column("kind"), table.column("bucket"), pa.array(list(map(squeezed, data)), pa.binary())], ["block", "kind", "bucket", "data"])

    return rows.groupBy("bucket", "kind").applyInArrow(run, ANSWER)


def with_answers(docs: DataFrame, got: DataFrame, use: Callable[[int, list, list[bytes], dict[int, bytes]], list[pa.RecordBatch]], schema: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``use(block, ids, texts, {kind: answers in order})`` for every block of ``docs`` (doc_id, text), numbered as it asked."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, texts in numbered(batches, block_bytes):
            columns = [pa.array([block]), pa.array([ids], pa.list_(pa.int64())), pa.array([list(map(len, texts))], pa.list_(pa.int64())), pa.array([squeezed(b"".join(texts))], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "ids", "sizes", "texts"])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            raise ValueError("an answer to a block that doesn't exist: the input changed between two scans")
        right = right.sort_by([("kind", "ascending"), ("bucket", "ascending")])
        data: dict[int, bytes] = {}
        for kind, part in zip(right.column("kind").to_pylist(), right.column("data").to_pylist()):
            data.setdefault(kind, []).append(opened(part))
        block, ids, sizes, joined = (left.column(c)[0].as_py() for c in ("block", "ids", "sizes", "texts"))
        joined, ends = opened(joined), np.cumsum(sizes).tolist()
        texts = [joined[end - size:end] for size, end in zip(sizes, ends)]
        return pa.Table.from_batches(use(block, ids, texts, {k: b"".join(v) for k, v in data.items()}))

    packed = docs.mapInArrow(pack, "block long, ids array<long>, sizes array<long>, texts binary")
    return packed.groupBy("block").cogroup(got.groupBy("block")).applyInArrow(run, schema)


class IndexFamily:
    """Sorted arrays (keys, low, high) in levels of geometric size; equal keys merge by least low, greatest high."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """A new batch; while the last level is no larger than what comes, both become one."""
        new = _sorted(keys, low, high)
        while self.levels and len(self.levels[-1][0]) <= len(new[0]):
            old = self.levels.pop()
            new = _sorted(*[np.concatenate(pair) for pair in zip(old, new)])
        self.levels.append(new)

    def scan(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least low, greatest high) of each key over all levels; the keys must be there."""
        low = np.full(len(keys), np.iinfo(np.int64).max)
        high = np.full(len(keys), np.iinfo(np.int64).min)
        for k, lo, hi in self.levels:
            at = np.minimum(np.searchsorted(k, keys), len(k) - 1)
            hit = k[at] == keys
            low[hit] = np.minimum(low[hit], lo[at[hit]])
            high[hit] = np.maximum(high[hit], hi[at[hit]])
        return low, high


def _sorted(keys: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, low, high = keys[order], low[order], high[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    if not len(starts):
        return keys, low, high
    return keys[starts], np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)

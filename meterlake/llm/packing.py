"""Best-fit packing: bounded-space online best-fit with the open sequences in a bitset keyed by free space."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import documents, stored

LENGTH = 1024
OPEN_BINS = 1024
BUFFER = 1024
STREAM_PIECES = 16_384
END = 2
PACKED = ["doc_id", "piece", "start", "length", "ids_crc32"]
#: Bytes of an id in ``ids``: little-endian, for vocabularies of up to 65,536 ids and beyond.
NARROW, WIDE = "<u2", "<u4"
SEQUENCES = "sequence_id long, ids binary, pieces array<struct<offset: long, length: long, doc_id: long, piece: int, start: long>>"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, mark long"


class Encoder:
    """Token ids of a vocabulary file, loaded once in each Python worker."""

    _made: dict[str, "Encoder"] = {}

    def __init__(self, path: str):
        if path.endswith(".tiktoken"):
            import base64

            import public_tokenizers
            import tiktoken

            with open(path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            special = {"<|endoftext|>": len(ranks)}
            made = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
            self.ids = lambda text: made.encode(text, allowed_special="all")
            largest = made.n_vocab
        else:
            from tokenizers import Tokenizer

            made = Tokenizer.from_file(path)
            self.ids = lambda text: made.encode(text, add_special_tokens=False).ids
            largest = made.get_vocab_size()
        self.kind = NARROW if largest <= 1 << 16 else WIDE

    @classmethod
    def of(cls, path: str) -> "Encoder":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]


def token_pieces(docs: DataFrame, path: str, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """The pieces of every document: its ids and ``END``, cut only if longer than ``length``.

    All pieces but the first of a cut document are full. Null texts are empty, that is ``END`` alone.
    ``mark`` tells equal rows apart by their place in a batch. ``with_ids`` adds the ids themselves, packed
    in two or four bytes each, whichever the vocabulary needs.
    """

    schema = PIECES + (", ids binary" if with_ids else "")
    names = [part.split()[0] for part in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for begin in range(0, len(doc_ids), 1024):
                rows: list[list] = [[] for _ in names]
                for at, value in enumerate(texts.slice(begin, 1024).to_pylist(), begin):
                    ids = np.array([*encoder.ids(value or ""), END], dtype="<u4")
                    first = len(ids) % length or length
                    bounds = [0, *range(first, len(ids) + 1, length)]
                    for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
                        own = (doc_ids[at], piece, a, b - a, zlib.crc32(ids[a:b].tobytes()), at)
                        for column, cell in zip(rows, (*own, ids[a:b].astype(encoder.kind).tobytes()) if with_ids else own):
                            column.append(cell)
                types = [pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, schema)


def best_fit(lengths: list[int], capacity: int = LENGTH, open_bins: int = OPEN_BINS) -> tuple[list[int], list[int]]:
    """(bin, offset) of each item, in the order given.

    An item goes to the open bin with the least free space that holds it. If none does, a new bin is
    opened; with ``open_bins`` open already the fullest is closed first. Bit f of the bitset is set while
    a bin with f free is open; of equal ones the one opened first is used.
    """
    bits, by_free, n_open, made = 0, [[] for _ in range(capacity + 1)], 0, 0
    bins, offsets = [], []
    for size in lengths:
        fitting = bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            own = by_free[free].pop(0)
            if not by_free[free]:
                bits &= ~(1 << free)
        else:
            if n_open == open_bins:
                fullest = (bits & -bits).bit_length() - 1
                by_free[fullest].pop(0)
                if not by_free[fullest]:
                    bits &= ~(1 << fullest)
                n_open -= 1
            own, free = made, capacity
            made += 1
            n_open += 1
        bins.append(own)
        offsets.append(capacity - free)
        free -= size
        if free:
            by_free[free].append(own)
            bits |= 1 << free
        else:
            n_open -= 1
    return bins, offsets


def _streams(pieces: DataFrame, stream_pieces: int) -> DataFrame:
    """Stored ``pieces`` dealt by hash to streams of about ``stream_pieces``, whatever their number."""
    thin = stored(pieces, "pieces")
    streams = max(1, -(-thin.count() // stream_pieces))
    return thin.withColumn("h", F.xxhash64("doc_id", "piece", "start", "ids_crc32", "mark")).withColumn("stream", F.pmod("h", F.lit(streams)))


def _packed(key: tuple, table: pa.Table, length: int, open_bins: int, buffer: int) -> pa.Table:
    """A stream in the order of its hashes, from each ``buffer`` the longest first, with sequence_id and offset."""
    table = table.sort_by([(c, "ascending") for c in ("h", "doc_id", "piece", "mark")])
    sizes = table.column("length").to_numpy()
    order = np.concatenate([i + np.argsort(-sizes[i:i + buffer], kind="stable") for i in range(0, len(sizes), buffer)])
    bins, offsets = best_fit(sizes[order].tolist(), length, open_bins)
    table = table.take(pa.array(order))
    table = table.append_column("sequence_id", pa.array((key[0].as_py() << 32) + np.array(bins, dtype=np.int64)))
    return table.append_column("offset", pa.array(offsets, pa.int64()))


def pack(pieces: DataFrame, length: int = LENGTH, open_bins: int = OPEN_BINS, stream_pieces: int = STREAM_PIECES, buffer: int = BUFFER) -> DataFrame:
    """``pieces`` with sequence_id and offset, without ids.

    Pieces are dealt by hash to streams of about ``stream_pieces``, whatever their number, so each task
    has a bounded stream. A stream arrives in the order of its hashes through a buffer of ``buffer``
    pieces, from which the longest goes first. No pieces: no rows. Equal pieces are packed each for itself.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        return _packed(key, table, length, open_bins, buffer).select([*PACKED, "sequence_id", "offset"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return _streams(pieces.drop("ids"), stream_pieces).groupBy("stream").applyInArrow(run, schema)


def sequences(pieces: DataFrame, length: int = LENGTH, open_bins: int = OPEN_BINS, stream_pieces: int = STREAM_PIECES, buffer: int = BUFFER) -> DataFrame:
    """The packed training rows of pieces with ids: (sequence_id, ids, pieces with their places), put together where they are packed.

    Packed as by :func:`pack`; a task holds a stream's ids, 34 MB at most with two bytes each.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = _packed(key, table, length, open_bins, buffer).sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        number = table.column("sequence_id").to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))
        ids = table.column("ids").to_pylist()
        ends = [*starts[1:].tolist(), len(ids)]
        whole = pa.array([b"".join(ids[a:b]) for a, b in zip(starts.tolist(), ends)], pa.binary())
        own = table.select(["offset", "length", "doc_id", "piece", "start"]).combine_chunks().to_struct_array()
        own = own.combine_chunks() if isinstance(own, pa.ChunkedArray) else own
        lists = pa.ListArray.from_arrays(pa.array([*starts.tolist(), len(ids)], pa.int32()), own)
        return pa.Table.from_arrays([pa.array(number[starts]), whole, lists], ["sequence_id", "ids", "pieces"])

    return _streams(pieces, stream_pieces).groupBy("stream").applyInArrow(run, SEQUENCES)


def packed_rows(docs: DataFrame, path: str) -> DataFrame:
    """The packed sequences, written to the shared folder: a row for each, its ids packed as in :func:`token_pieces`.

    Null texts are empty. An empty table gives no sequences.
    """
    return stored(sequences(token_pieces(docs, path, with_ids=True)), "sequences")


def places(rows: DataFrame) -> DataFrame:
    """The pieces of :func:`packed_rows`; length and ids_crc32 are those of the ids that lie at their places.

    No sequences: no rows.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), 256):
                out: list[tuple] = []
                part = batch.slice(begin, 256)
                for sequence, ids, pieces in zip(*(part.column(k).to_pylist() for k in range(3))):
                    width = len(ids) // sum(x["length"] for x in pieces)
                    own = np.frombuffer(ids, NARROW if width == 2 else WIDE).astype("<u4")
                    for x in pieces:
                        found = own[x["offset"]:x["offset"] + x["length"]]
                        out.append((x["doc_id"], x["piece"], x["start"], len(found), zlib.crc32(found.tobytes()), sequence, x["offset"]))
                types = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], [x.split()[0] for x in schema.split(", ")])

    return rows.mapInArrow(read, schema)


def default_vocabulary() -> str:
    """The ranks of the byte-level vocabulary of 50,257 ids: the same ids as its JSON file, read four times faster."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places(packed_rows(documents(spark, sf_dir), default_vocabulary()))

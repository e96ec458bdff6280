"""Repeated byte strings across documents, by sparse suffix arrays in a logarithmic index family.

Of the byte positions only those are indexed that hold the least hash of a 20-byte string in some 50-byte
window; every 50-byte string has one at the same place wherever it occurs. Windows in a row that share
such a position are a run. Buckets of the hash space keep sorted arrays of runs: each block of documents
is a batch with its own array, arrays of equal size merge, and blocks are scanned against the family.

First all runs are compared as wholes, which settles copies and the inside of passages. Only runs whose
20 bytes also occur in another run, and that are the first of their kind, compare their single windows.
"""

from __future__ import annotations

import hashlib
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import _ODD, documents, mix, powers, stored
from meterlake.llm.exchange import ASKED, IndexFamily, answers, asked, asked_batch, bucket_number, numbered, packed, with_answers

LENGTH = 50
GRAM = 20
LAST = np.iinfo(np.int64).max
RUNS, WINDOWS = 1, 2
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first, first + 1, ..., ``n`` numbers for each."""
    return np.repeat(first - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)


def _first_place(grams: np.ndarray, value: np.ndarray, windows: np.ndarray, reach: int) -> np.ndarray:
    """Where the least hash ``value`` of each of the windows is first found among its ``reach`` grams."""
    out, inner = np.empty(len(windows), dtype=np.int64), np.arange(reach)
    for begin in range(0, len(windows), 65536):
        w = windows[begin:begin + 65536]
        out[begin:begin + 65536] = w + np.argmax(grams[w[:, None] + inner] == value[w][:, None], axis=1)
    return out


class Block:
    """The runs of a block's texts: first and last window start, document, and what identifies them."""

    def __init__(self, ids: list[int | None], texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
        self.length, self.texts = length, texts
        self.ids = np.array([LAST if i is None else i for i in ids], dtype=np.int64)
        self.ends = np.cumsum([len(t) for t in texts]).astype(np.int64)
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        n = len(data)
        self.first = self.last = self.doc = np.zeros(0, np.int64)
        self.gram = self.span = np.zeros(0, np.uint64)
        if n < length:
            return
        self.down = powers(n + 1, pow(_ODD, -1, 1 << 64))
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(n + 1)[:n], out=self.sums[1:])
        grams = mix((self.sums[gram:] - self.sums[:-gram]) * self.down[:n - gram + 1] + np.uint64(gram))
        value, width, reach = grams, 1, length - gram + 1
        while width < reach:  # least hash of ``width`` grams
            step = min(width, reach - width)
            value = np.minimum(value[step:], value[:-step])
            width += step
        # Windows of a text with one least hash are a run, up to the first place of that hash.
        new = np.concatenate(([True], value[1:] != value[:-1]))
        begins = self.ends - [len(t) for t in texts]
        new[begins[begins < len(value)]] = True
        over = np.minimum(np.maximum(self.ends - length + 1, begins), len(value))
        inside = np.zeros(len(value) + 1, dtype=np.int32)
        np.add.at(inside, np.minimum(begins, len(value)), 1)
        np.add.at(inside, over, -1)
        new[over[over < len(value)]] = True
        starts = np.flatnonzero(new)
        stops = np.concatenate((starts[1:], [len(value)]))
        held = np.cumsum(inside[:-1])[starts] > 0
        starts, stops = starts[held], stops[held]
        if not len(starts):
            return
        p = _first_place(grams, value, starts, reach)
        tail = np.flatnonzero(stops > p + 1)  # the hash occurs again behind its first place
        rest = _ranges(p[tail] + 1, stops[tail] - p[tail] - 1)
        place = _first_place(grams, value, rest, reach)
        turns = np.flatnonzero(np.diff(place, prepend=-1))
        first = np.concatenate((starts, rest[turns]))
        last = np.concatenate((np.minimum(stops - 1, p), rest[np.append(turns[1:], len(rest)) - 1] if len(rest) else rest))
        by_place = np.argsort(first, kind="stable")
        self.first, self.last, p = first[by_place], last[by_place], np.concatenate((p, place[turns]))[by_place]
        self.doc, self.gram = np.searchsorted(self.ends, self.first, side="right"), grams[p]
        wide = self.last - self.first
        whole_hash = (self.sums[self.last + length] - self.sums[self.first]) * self.down[self.first]
        self.span = mix(whole_hash + mix(self.gram + (wide * 4096 + (p - self.first)).astype(np.uint64)))

    def hashes(self, at: np.ndarray, width: int) -> np.ndarray:
        """Hash of the ``width`` bytes at each position."""
        return mix((self.sums[at + width] - self.sums[at]) * self.down[at] + np.uint64(width))

    @cached_property
    def classes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(gram, span, least id, class of each run) of the different runs, by span."""
        span, first, own = np.unique(self.span, return_index=True, return_inverse=True)
        least = np.full(len(span), LAST)
        np.minimum.at(least, own, self.ids[self.doc])
        return self.gram[first], span, least, own

    def asked_order(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """(order of the classes by the bucket of their gram, gram and span; bucket of each)."""
        gram, span, _, _ = self.classes
        bucket = (gram % np.uint64(buckets)).astype(np.int64)
        return np.lexsort((gram, bucket)), bucket

    def run_rows(self, block: int, buckets: int) -> list[tuple]:
        """To the bucket of the gram; there the span tells the class."""
        gram, span, least, _ = self.classes
        order, bucket = self.asked_order(buckets)
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = []
        for b in np.flatnonzero(ends[1:] > ends[:-1]).tolist():
            o = order[ends[b]:ends[b + 1]]
            rows.append((b, block, RUNS, packed(gram[o]), (span[o] >> np.uint64(32)).astype(np.uint32).tobytes(), least[o].tobytes()))
        return rows

    def settled(self, flags: bytes, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """(run is repeated from a smaller id, run must compare its windows)."""
        _, _, least, own = self.classes
        got = np.empty(len(least), dtype=np.uint8)
        got[self.asked_order(buckets)[0]] = np.frombuffer(flags, dtype=np.uint8)
        repeated = (got[own] & 1).astype(bool) | (self.ids[self.doc] > least[own])
        return repeated, ~repeated & (got[own] & 2).astype(bool)

    def window_starts(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, document) of the windows of the chosen runs."""
        first, n = self.first[runs], self.last[runs] - self.first[runs] + 1
        return _ranges(first, n), np.repeat(self.doc[runs], n)

    def windows(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, least id) of the different windows of the chosen runs; start and number of each window."""
        start, doc = self.window_starts(runs)
        keys, own = np.unique(self.hashes(start, self.length), return_inverse=True)
        least = np.full(len(keys), LAST)
        np.minimum.at(least, own, self.ids[doc])
        return keys, least, start, own


def _resolve(kind: int, keys: list[np.ndarray], low: list[bytes], high: list[bytes]) -> list[bytes]:
    family, grams = IndexFamily(), IndexFamily()
    batches = []
    for k, lo, hi in zip(keys, low, high):
        ids = np.frombuffer(hi, dtype=np.int64)
        if kind == RUNS:
            span = np.frombuffer(lo, dtype=np.uint32).astype(np.int64)
            own = mix(k + mix(span.astype(np.uint64)))
            grams.add(k, span, span)
        else:
            own = k
        order = np.argsort(own) if kind == RUNS else slice(None)
        own, ids = own[order], ids[order]
        family.add(own, ids, ids)
        batches.append((order, own, ids))
    out = []
    for k, (order, own, ids) in zip(keys, batches):
        flags = np.empty(len(k), dtype=np.uint8)
        flags[order] = family.scan(own)[0] < ids  # ascending keys are found fast
        if kind == RUNS:
            least, most = grams.scan(k)
            flags |= ((least < most) * 2).astype(np.uint8)
        out.append(flags.tobytes())
    return out


def _ask(block: int, kind: int, keys: np.ndarray, least: np.ndarray, buckets: int) -> tuple[list[tuple], np.ndarray]:
    return asked(block, kind, keys, np.zeros(0, np.uint8), least, buckets)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, keep_bytes: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row.

    A byte is removed if a string of ``length`` bytes that covers it also starts in a document with a
    smaller id, judged on the texts as they came. Rows of one id don't remove from each other; a null id is
    larger than all others. Null texts are empty. ``kept`` is null unless ``keep_bytes``. Strings are
    compared by 64-bit hashes, those of runs by 32 bits more than their gram's 64.
    """
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    buckets = bucket_number(plain, "text")

    def ask_runs(batches):
        for block, ids, texts in numbered(batches):
            yield asked_batch(Block(ids, texts, length).run_rows(block, buckets))

    def ask_windows(block, ids, texts, got):
        own = Block(ids, texts, length)
        runs = np.flatnonzero(own.settled(got.get(RUNS, b""), buckets)[1])
        keys, least, _, _ = own.windows(runs)
        return [asked_batch(_ask(block, WINDOWS, keys, least, buckets)[0])]

    def finish(block, ids, texts, got):
        own = Block(ids, texts, length)
        repeated, open_ = own.settled(got.get(RUNS, b""), buckets)
        start, _ = own.window_starts(np.flatnonzero(repeated))
        keys, least, starts, number = own.windows(np.flatnonzero(open_))
        flags = np.empty(len(keys), dtype=np.uint8)
        flags[_ask(block, WINDOWS, keys, least, buckets)[1]] = np.frombuffer(got.get(WINDOWS, b""), dtype=np.uint8)
        doc = np.searchsorted(own.ends, starts, side="right")
        hit = (flags[number] > 0) | (own.ids[doc] > least[number])
        n = int(own.ends[-1]) if len(own.ends) else 0
        edge = np.zeros(n + 1, dtype=np.int32)
        for s in (start, starts[hit]):
            np.add.at(edge, s, 1)
            np.add.at(edge, s + length, -1)
        gone = np.cumsum(edge[:n]) > 0
        rows = []
        for i, value in enumerate(texts):
            a, b = int(own.ends[i]) - len(value), int(own.ends[i])
            part = gone[a:b]
            kept = np.frombuffer(value, dtype=np.uint8)[~part].tobytes() if part.any() else value
            spans = int((part[1:] & ~part[:-1]).sum() + part[0]) if len(part) else 0
            rows.append((ids[i], len(value), int(part.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        return [pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)]

    runs = stored(answers(plain.mapInArrow(ask_runs, ASKED), _resolve), "runs")
    windows = answers(with_answers(plain, runs, ask_windows, ASKED), _resolve)
    return with_answers(plain, runs.unionByName(windows), finish, RESULT)


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir), keep_bytes=False).drop("kept")


"""Periodic runs of words: stretches that repeat themselves at a short distance, found and collapsed.

Descending-LCP Kruskal. The texts of a block that repeat any window of words get a suffix array by prefix
doubling. Neighbouring suffixes are united by decreasing common prefix; every class keeps its positions in
order. Two positions that become adjacent when their classes unite have exactly that common prefix, and if
they are near enough, they seed a run: the distance is its period. No period is tried, and a multiple of
the smallest period is never adjacent, so no run is found twice.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import documents

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
BLOCK = 400_000
RUNS = "array<struct<start: long, length: long, period: long>>"


def repeating(ids: list[np.ndarray], window: int) -> list[int]:
    """Numbers of the texts in which some window of words occurs twice (by hash: perhaps one too many)."""
    sizes = np.array([len(i) for i in ids])
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    if len(flat) < window:
        return []
    doc = np.repeat(np.arange(len(ids)), sizes)
    count = len(flat) - window + 1
    h = doc[:count].astype(np.uint64)
    for k in range(window):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + flat[k:count + k].astype(np.uint64)
    whole = np.flatnonzero(doc[:count] == doc[window - 1:])
    order = whole[np.argsort(h[whole])]
    same = np.flatnonzero(h[order[1:]] == h[order[:-1]])
    return np.unique(doc[order[same]]).tolist()


def suffix_edges(first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, position, common prefix) of neighbours in the suffix array with a prefix of ``least`` at least, longest first.

    ``first`` ranks the single words; it ends with a rank that occurs nowhere else.
    """
    ranks, width = [first.astype(np.int32)], 1
    n = len(first)
    while True:
        rank = ranks[-1].astype(np.int64)
        key = rank * (n + 1)
        key[: n - width] += rank[width:] + 1
        _, new = np.unique(key, return_inverse=True)
        ranks.append(new.astype(np.int32))
        width *= 2
        if int(new.max()) == n - 1 or width >= n:
            break
    order = np.argsort(ranks[-1])
    i, j = order[:-1], order[1:]
    common = np.zeros(n - 1, dtype=np.int64)
    for level in range(len(ranks) - 2, -1, -1):
        common += (ranks[level][i + common] == ranks[level][j + common]).astype(np.int64) << level
    long = np.flatnonzero(common >= least)
    long = long[np.argsort(-common[long], kind="stable")]
    return i[long], j[long], common[long]


def united(first: np.ndarray, least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs in the ranked words ``first``, by start, then period.

    ``least_exponent`` is 3 at least: then no period has to be checked for a smaller one.
    """
    least = max(least_length * (least_exponent - 1) // least_exponent, least_exponent - 1)
    words = first.tolist()
    label: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    found = []

    def seed(x: int, y: int, common: int) -> None:
        period = y - x
        if (least_exponent - 1) * period <= common and period + common >= least_length and words[x - 1] != words[y - 1]:
            found.append((x, period + common, period))

    for i, j, common in zip(*(e.tolist() for e in suffix_edges(first, least))):
        a, b = label.get(i, i), label.get(j, j)
        large, small = members.get(a) or [a], members.get(b) or [b]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        for t, x in enumerate(small):
            k = bisect_left(large, x)
            before = large[k - 1] if k else -1
            # Adjacent only if no later one of the small class comes between; an earlier one already stands there.
            if k and (not t or before != small[t - 1]):
                seed(before, x, common)
            if k < len(large) and (t + 1 == len(small) or small[t + 1] > large[k]):
                seed(x, large[k], common)
            large.insert(k, x)
            label[x] = a
        label[a] = a
        members[a] = large
        members.pop(b, None)
    return sorted(found, key=lambda run: (run[0], run[2]))


def block_runs(texts: list[list[bytes]], least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, given as words."""
    number: dict[bytes, int] = {}
    ids = [np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64) for words in texts]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    window = max(least_length * (least_exponent - 1) // least_exponent, least_exponent - 1)
    chosen = repeating(ids, window)
    if not chosen:
        return out
    # Words of different texts differ, and each text ends with a word of its own: suffixes never meet across texts.
    span = len(number) + 1
    parts = [np.append(ids[t], span - 1) + k * span for k, t in enumerate(chosen)]
    starts = np.cumsum([0, *[len(p) for p in parts]])
    _, first = np.unique(np.concatenate(parts), return_inverse=True)
    for start, length, period in united(first, least_length, least_exponent):
        k = int(np.searchsorted(starts, start, side="right")) - 1
        out[chosen[k]].append((start - int(starts[k]), length, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run repeats."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def periodic_runs(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_length: int = LEAST_LENGTH,
    least_exponent: int = LEAST_EXPONENT,
    edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: all runs by start and period, and the words they leave joined by one space.

    A run is a stretch of words of smallest period q and at least max(least_length, least_exponent * q)
    words that can't be extended. Null, empty and blank texts have none and collapse to "". ``edit`` changes the words
    of a text beforehand. Repeated rows and ids are treated each by itself; a row per row comes out. Other
    columns are not read. Memory follows the longest text: four bytes per word and doubling of its longest
    repetition.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
            runs = block_runs(texts, least_length, least_exponent)
            rows = [[{"start": s, "length": n, "period": q} for s, n, q in own] for own in runs]
            left = [b" ".join(collapsed(words, own)) for words, own in zip(texts, runs)]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            columns = [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(rows, kind), pa.array(left, pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

        for batch in batches:
            ids, texts, size = [], [], 0
            for i, value in zip(batch.column(0), batch.column(1)):
                own, data = i.as_py(), value.as_py() or b""
                if texts and size + len(data) > BLOCK:
                    yield done(ids, texts)
                    ids, texts, size = [], [], 0
                words = data.split()
                ids.append(own)
                texts.append(edit(own, words) if edit else words)
                size += len(data)
            if texts:
                yield done(ids, texts)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("t"))
    return rows.mapInArrow(find, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def looped(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth text, by CRC-32 of its decimal id, goes round in a loop from some word on; a null id counts as no digits."""
    h, n = zlib.crc32(str("" if doc_id is None else doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    loop = words[a:a + p]
    return words[:a] + (loop * ((n - a) // p + 1))[: n - a]


def digest(found: DataFrame) -> DataFrame:
    """Counts, the run of greatest exponent (first start, then smallest period), and hashes of ``periodic_runs``."""
    top = F.reduce(
        "runs",
        F.lit(None).cast("struct<start: long, length: long, period: long>"),
        lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best),
    )
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    rows = found.select("doc_id", "runs", "collapsed", top.alias("top"))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(periodic_runs(documents(spark, sf_dir), edit=looped))

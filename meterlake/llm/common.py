"""What the operators share: the tables, word rules, stored intermediates, text blocks for Python tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.session import shared_dir

WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
BLOCK_BYTES = 4_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read from there: cuts the lineage, survives executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc(column: Column) -> Column:
    """Unsigned CRC-32 of the text's UTF-8 bytes; that of no bytes for null."""
    return F.crc32(F.coalesce(column, F.lit("")).cast("binary"))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``; null ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def blocks(texts: Iterable[str | None], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(position of the first, UTF-8 texts) in runs of about ``limit`` bytes; a longer text is a run of its own."""
    start, run, size = 0, [], 0
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        if run and size + len(data) > limit:
            yield start, run
            start, run, size = i, [], 0
        run.append(data)
        size += len(data)
    if run:
        yield start, run


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit hashes over all bits."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_ODD = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: int = _ODD) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word of all texts in order, words per text)."""
    if not texts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    joined = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    space = _SPACE[joined]
    inner = ~space
    starts = np.flatnonzero(inner & np.concatenate(([True], space[:-1])))
    ends = np.flatnonzero(space & np.concatenate(([False], inner[:-1])))
    lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    limits = np.cumsum(lengths)
    counts = np.diff(np.concatenate(([0], np.searchsorted(starts, limits))))
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    # A word is the polynomial of its bytes: sums over the text at descending powers, brought to a common scale.
    up, down = powers(len(joined) + 1), powers(len(joined) + 1, pow(_ODD, -1, 1 << 64))
    sums = np.zeros(len(joined) + 1, dtype=np.uint64)
    np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * up[: len(joined)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), counts


def shingles(texts: list[bytes], n: int = 5) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's ``n``-word windows.

    A text of fewer words has one shingle, all its words; one without words has none.
    """
    words, counts = word_hashes(texts)
    out, start = [], 0
    for count in counts.tolist():
        own = words[start:start + count]
        start += count
        width = min(n, count)
        if not width:
            out.append(np.zeros(0, np.uint64))
            continue
        h = np.zeros(count - width + 1, dtype=np.uint64)
        for k in range(width):
            h = h * np.uint64(_ODD) + own[k:count - width + 1 + k]
        out.append(np.unique(mix(h + np.uint64(width))))
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the string pairs (a, b): root is the smallest node of its connected component.

    Alternating large-star and small-star steps, each written to the shared folder; rows with a = b or a
    null are ignored, repeated and reversed pairs are one.
    """
    spark = edges.sparkSession
    schema = "a string, b string"

    def star(both: DataFrame, large: bool) -> DataFrame:
        """For each node u with neighbours v: (v, least of them and u) for the larger, or not larger, v."""
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = stored(least, "star")
        joined = both.join(least, "u")
        if large:
            return joined.where("v > u").selectExpr("v as a", "m as b").distinct()
        pairs = joined.selectExpr("v as a", "m as b").unionByName(least.selectExpr("u as a", "m as b"))
        return pairs.where("a > b").distinct()

    def digest(df: DataFrame) -> tuple:
        row = df.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        return row[0], row[1]

    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    last = digest(now)
    while last[0]:
        both = now.selectExpr("a as u", "b as v").unionByName(now.selectExpr("b as u", "a as v"))
        now = stored(star(both, True), "large")
        now = stored(star(now.selectExpr("a as u", "b as v"), False), "small")
        new = digest(now)
        if new == last:
            break
        last = new
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.selectExpr("a as node", "b as root").unionByName(roots) if last[0] else spark.createDataFrame([], "node string, root string")

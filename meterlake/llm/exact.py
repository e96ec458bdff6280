"""Exact duplicates through content-defined chunk recipes.

Normalised texts are cut where a rolling hash says so. Distinct chunks are compared by their bytes, which
gives each a verified identifier; equal texts are then those with the same ordered identifiers. A chunk's
bytes are moved once per input partition that has it; from there on only identifiers move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.llm.common import WHITE, documents, stored

LEAST, MASK_BITS, MOST = 512, 11, 16_384
_WHITE = b" \t\n\r\x0b\x0c"
_GEAR = np.random.default_rng(20240607).integers(0, 1 << 32, 256, dtype=np.uint32)
_WINDOW = 32


def cuts(data: bytes, least: int = LEAST, mask_bits: int = MASK_BITS, most: int = MOST) -> list[int]:
    """Ends of the chunks of ``data``: at the first boundary of the rolling hash after ``least`` bytes, at ``most`` at the latest."""
    n = len(data)
    if n <= least:
        return [n] if n else []
    h = _GEAR[np.frombuffer(data, dtype=np.uint8)]
    width = 1
    while width < _WINDOW:  # h[i] becomes the hash of the 32 bytes that end at i
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    marks = np.flatnonzero(h >> np.uint32(32 - mask_bits) == 0) + 1
    ends, start, at = [], 0, 0
    while start < n:
        at = int(np.searchsorted(marks, start + least))
        end = int(marks[at]) if at < len(marks) else n
        start = min(end, start + most, n)
        ends.append(start)
    return ends


def _chunks(text: str | None) -> tuple[bytes, list[bytes]]:
    data = (text or "").encode("utf-8", "surrogatepass").translate(None, _WHITE)
    ends = cuts(data)
    return data, [data[a:b] for a, b in zip([0, *ends], ends)]


def _hash(chunk: bytes) -> int:
    return xxhash.xxh3_64_intdigest(chunk) - (1 << 63)


def chunk_table(docs: DataFrame, text: str = "text") -> DataFrame:
    """The distinct chunks of all texts: (h, bytes)."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), 256):
                own = list({c for t in batch.column(0).slice(begin, 256).to_pylist() for c in _chunks(t)[1]})
                yield pa.RecordBatch.from_arrays([pa.array([_hash(c) for c in own], pa.int64()), pa.array(own, pa.binary())], ["h", "bytes"])

    return docs.select(F.col(text).alias("t")).mapInArrow(split, "h long, bytes binary").distinct()


def clashes(chunks: DataFrame) -> DataFrame:
    """Of hashes that different chunks share: (h, bytes, extra), extra from 0.

    Normally empty: even among 10**10 different chunks about three pairs share a 64-bit hash, so the
    driver may hold the result.
    """
    thin = chunks.select("h").groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    return chunks.join(thin, "h").select("h", "bytes", (F.row_number().over(Window.partitionBy("h").orderBy("bytes")) - 1).alias("extra"))


def recipes(docs: DataFrame, clashing: dict[bytes, int] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, chars, recipe, text_sha256) of every row: the recipe is the text's ordered chunk identifiers.

    An identifier is the chunk's hash, followed by its number where the hash alone is not unique.
    """
    clashing = clashing or {}

    def cook(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), 1024):
                chars, lists, shas = [], [], []
                for value in batch.column(1).slice(begin, 1024).to_pylist():
                    data, parts = _chunks(value)
                    chars.append(len(value or ""))
                    lists.append([i for c in parts for i in ([_hash(c), clashing[c]] if c in clashing else [_hash(c)])])
                    shas.append(hashlib.sha256(data).hexdigest())
                columns = [batch.column(0).slice(begin, 1024), pa.array(chars, pa.int64()), pa.array(lists, pa.list_(pa.int64())), pa.array(shas)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "chars", "recipe", "text_sha256"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t")).mapInArrow(cook, "doc_id long, chars long, recipe array<long>, text_sha256 string")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row.

    Texts are equal when they are after deleting white space; null is empty. The row with the most code
    points stays, of these the one with the smallest id (null last). Rows that repeat both text and id all
    say kept, since they name the same document. Empty table: no rows. Other columns are not read.
    """
    extra = {bytes(r["bytes"]): r["extra"] for r in clashes(chunk_table(docs, text)).toLocalIterator()}
    rows = stored(recipes(docs, extra, doc_id, text), "recipes")
    order = F.struct("chars", F.col("doc_id").isNotNull().alias("known"), (-F.col("doc_id")).alias("back"))
    groups = rows.groupBy("recipe").agg(F.max(order).alias("top"), F.count("*").alias("group_size"))
    groups = stored(groups.select("recipe", F.col("top.chars").alias("top_chars"), (-F.col("top.back")).alias("keep_id"), "group_size"), "groups")
    return rows.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("top_chars"))).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; one of rows that repeat both text and id."""
    keys = ["__sha", "__id", "__no_id"]
    known = F.coalesce(F.col("__raw"), F.lit(0)).alias("__id"), F.col("__raw").isNull().alias("__no_id")
    kept = exact_groups(docs, doc_id, text).where("kept").withColumnRenamed("doc_id", "__raw").select(F.col("text_sha256").alias("__sha"), *known).distinct()
    plain = F.coalesce(F.col(text), F.lit(""))
    rows = docs.withColumn("__sha", F.sha2(F.regexp_replace(plain, WHITE, ""), 256)).withColumn("__raw", F.col(doc_id).cast("long"))
    rows = rows.select("*", *known).join(kept, keys, "left_semi")
    # Of rows with one id that differ in white space only, the longest stays.
    first = Window.partitionBy(*keys).orderBy(F.length(plain).desc(), F.xxhash64(*[F.col(c) for c in docs.columns]))
    return rows.withColumn("__n", F.row_number().over(first)).where("__n = 1").select(*docs.columns)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


OP6_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), g AS (
  SELECT norm, arg_min(doc_id, (-chars, doc_id)) AS keep_id, max(chars) AS top, count(*) AS group_size FROM t GROUP BY norm
)
SELECT doc_id, keep_id, group_size, (doc_id = keep_id AND chars = top) AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""

"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

A text becomes a sparse vector of hashed one- and two-word terms, once of the words as they are and once of
their shapes (case, digits and marks; repeats of the word before), with logarithmic counts and unit
length. Scores are sparse dot products with the weights, which every task holds: 2**BITS floats.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import blocks, documents, labels, mix, remainder, word_hashes

BITS = 18
ROWS = 20_000
SHARDS = 4
EPOCHS = 8
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.00001, 0.00001
#: Texts go through array work in blocks of about so many bytes; a block takes some sixty times that.
ARRAY_BYTES = 400_000

_SHAPE = bytearray(range(256))
for _c in range(256):
    _SHAPE[_c] = ord("A") if 65 <= _c <= 90 else ord("a") if 97 <= _c <= 122 or _c >= 128 else ord("0") if 48 <= _c <= 57 else _c
_SHAPE = bytes(_SHAPE)
_RUNS = re.compile(rb"([A0])\1+|a+")


def _shape(text: bytes) -> bytes:
    return _RUNS.sub(lambda m: m.group()[:1], text.translate(_SHAPE))


def vectors(texts: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, term, value) of the texts' sparse vectors, by text; each of unit length.

    Every text has the term 0, the intercept, so a text without words has just that.
    """
    words, counts = word_hashes(texts)
    shapes, _ = word_hashes([_shape(t) for t in texts])
    row = np.repeat(np.arange(len(texts)), counts)
    pair = np.flatnonzero(row[1:] == row[:-1]) if len(row) else np.zeros(0, np.int64)
    repeat = np.zeros(len(words), np.uint64)
    repeat[pair + 1] = words[pair + 1] == words[pair]
    shapes = shapes ^ mix(repeat + np.uint64(77))
    rows, terms = [row, row[pair], row, row[pair]], [words]
    for kind, h in ((1, words), (3, shapes)):
        if kind == 3:
            terms.append(mix(h + np.uint64(3)))
        terms.append(mix(h[pair] * np.uint64(0x9E3779B97F4A7C15) + h[pair + 1] + np.uint64(kind)))
    row, term = np.concatenate(rows), np.concatenate(terms)
    term = (term >> np.uint64(64 - bits)).astype(np.int64)
    term[term == 0] = 1
    key, n = np.unique((row.astype(np.int64) << bits) | term, return_counts=True)
    row, term, value = key >> bits, key & ((1 << bits) - 1), np.log1p(n)
    norm = np.sqrt(np.bincount(row, value * value, len(texts)))
    value = value / np.maximum(norm, 1e-9)[row]
    order = np.argsort(np.concatenate([row, np.arange(len(texts))]), kind="stable")
    row = np.concatenate([row, np.arange(len(texts))])[order]
    return row, np.concatenate([term, np.zeros(len(texts), np.int64)])[order], np.concatenate([value, np.ones(len(texts))])[order]


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> np.ndarray:
    """Weights after ``epochs`` passes of FTRL-proximal updates over (terms, values, label 0 or 1)."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    for _ in range(epochs):
        for terms, values, label in examples:
            zi, ni = z[terms], n[terms]
            w = weights(zi, ni)
            g = (1.0 / (1.0 + np.exp(-np.clip(w @ values, -35, 35))) - label) * values
            z[terms] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * w
            n[terms] = ni + g * g
    return weights(z, n).astype(np.float32)


def train(examples: DataFrame, bits: int = BITS, rows: int = ROWS, shards: int = SHARDS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights from rows (doc_id, text, label); the mean of ``shards`` models, each of its share of the rows.

    At most about ``rows`` examples are used, by hash of their id. Labels that are null are left out; without
    any example all weights are 0. A label that is more frequent weighs no less: this is a plain likelihood.
    """
    schema = "doc_id long, text string, label int, h long, shard int"
    total = examples.where("label IS NOT NULL").count()
    chosen = F.col("h") < F.lit(int(min(1.0, rows / max(1, total)) * (1 << 62)))
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 62))
    used = examples.where("label IS NOT NULL").withColumn("h", h).where(chosen)
    used = used.withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "doc_id"), F.lit(shards)).cast("int"))

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["h", "doc_id", "label"], kind="stable")
        own = []
        label = frame["label"].tolist()
        for start, texts in blocks(frame["text"], ARRAY_BYTES):
            row, term, value = vectors(texts, bits)
            ends = np.searchsorted(row, np.arange(len(texts) + 1))
            own += [(term[a:b], value[a:b], label[start + i]) for i, (a, b) in enumerate(zip(ends, ends[1:]))]
        return pd.DataFrame({"rows": [len(own)], "weights": [ftrl(own, bits, epochs).tobytes()]})

    names = schema.replace(", ", " ").split()[::2]
    models = used.select(*names).groupBy("shard").applyInPandas(fit, "rows long, weights binary").collect()
    out, n = np.zeros(1 << bits), 0
    for model in models:
        out += model["rows"] * np.frombuffer(model["weights"], dtype=np.float32)
        n += model["rows"]
    return (out / max(1, n)).astype(np.float32)


def score(text: Column, weights: np.ndarray, spark: SparkSession, bits: int = BITS) -> Column:
    """Probability of label 1 for each whole text; null counts as empty."""
    shared = spark.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        w = shared.value.astype(np.float64)
        for texts in batches:
            out = np.full(len(texts), 0.0)
            # As slices of the batch, so that its texts are not all there a second time.
            for begin in range(0, len(texts), 128):
                for start, run in blocks(texts.slice(begin, 128).to_pylist(), ARRAY_BYTES):
                    row, term, value = vectors(run, bits)
                    out[begin + start:begin + start + len(run)] = np.bincount(row, w[term] * value, len(run))
            yield pa.array(1.0 / (1.0 + np.exp(-np.clip(out, -500, 500))))

    return scored(text)


def labelled(docs: DataFrame, marks: DataFrame, label: str, modulus: int, held_out: int, rows: int = ROWS) -> DataFrame:
    """(doc_id, text, label) of documents whose label may be learnt from, of about ``rows`` if there are more.

    The labels used are so few that they may be broadcast; documents are then read without a shuffle.
    """
    marks = marks.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (remainder(F.col("doc_id"), modulus) != held_out))
    marks = marks.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    share = min(1.0, rows / max(1, marks.count()))
    some = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 62)) < F.lit(int(share * (1 << 62))))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(F.broadcast(some), "doc_id")


def quality_weights(docs: DataFrame, marks: DataFrame) -> np.ndarray:
    return train(labelled(docs, marks, "quality", 3, 1))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    weights = quality_weights(docs, labels(spark, sf_dir))
    scored = docs.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), score(F.col("text"), weights, spark).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

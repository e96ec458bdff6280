"""Stupid-backoff scores of all documents under the n-gram counts of the other documents.

N-gram counts are partitioned by hash. Each block of documents asks the buckets of its n-grams for their
counts over the whole corpus; a document's own occurrences are taken off, so no text vouches for itself.
A word scores count(n-gram) / count(its history), or alpha times the score with a word less of history.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import _ODD, documents, mix, word_hashes
from meterlake.llm.exchange import ASKED, answers, asked_batch, asked_ranges, bucket_number, numbered, with_answers

ORDER = 3
ALPHA = 0.4
# Larger blocks repeat more n-grams within, which are asked once; words are hashed in smaller runs.
BLOCK_BYTES = 7_000_000
HASH_BYTES = 1_000_000
RESULT = "doc_id long, n_words long, n_backed_off long, log_score double"


def ngrams(texts: list[bytes], order: int = ORDER) -> tuple[list[np.ndarray], np.ndarray]:
    """(for k = 1..order the hash of the k words that end at each word, 0 if the text has fewer), text of each word."""
    run = np.cumsum(list(map(len, texts)), dtype=np.int64) // HASH_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(texts)]
    words, counts = (np.concatenate(x) for x in zip(*(word_hashes(texts[a:b]) for a, b in zip(cuts, cuts[1:]))))
    doc = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
    out = [mix(words | np.uint64(1))]
    for k in range(2, order + 1):
        h = np.zeros(len(words), dtype=np.uint64)
        if len(words) >= k:
            h[k - 1:] = mix(out[-1][k - 2:-1] * np.uint64(_ODD) + words[k - 1:] + np.uint64(k))
        h[place < k - 1] = 0
        out.append(h)
    return out, doc


def _counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, n = np.unique(grams[grams != 0], return_counts=True)
    return keys, n.astype(np.uint32)


def _resolve(kind: int, keys: list[np.ndarray], low: list[bytes], high: list[bytes]) -> list[bytes]:
    """What the other blocks have of each key: mostly nothing, which compresses away."""
    all_ = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    order = np.argsort(all_, kind="stable")
    found = all_[order]
    n = np.concatenate([np.frombuffer(x, dtype=np.uint32) for x in low]).astype(np.int64)
    own = np.split(n, np.cumsum([len(k) for k in keys])[:-1])
    n = n[order]
    starts = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
    distinct, total = found[starts], np.add.reduceat(n, starts)
    return [(total[np.searchsorted(distinct, k)] - o).tobytes() for k, o in zip(keys, own)]


def scores(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_backed_off, log_score) of every row; log_score is the sum of the words' natural logs.

    n_backed_off counts the words scored with less than the longest history they have. A word that no other
    document has scores alpha**k / (words of the others + 1), k its histories. Texts without words (null
    too) score 0. Rows are documents, even if ids or texts repeat.
    """
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    buckets = bucket_number(plain, "text")

    def ask(batches):
        for block, _, texts in numbered(batches, BLOCK_BYTES):
            rows = []
            for k, grams in enumerate(ngrams(texts, order)[0], 1):
                keys, n = _counted(grams)
                rows += asked_ranges(block, k, keys, n, buckets)
            rows += asked_ranges(block, 0, np.array([1], dtype=np.uint64), np.array([len(grams)], dtype=np.uint32), buckets)
            yield asked_batch(rows)

    def finish(block, ids, texts, got):
        grams, doc = ngrams(texts, order)
        n_words = np.bincount(doc, minlength=len(texts))
        left = []
        for k, h in enumerate(grams, 1):
            keys, n = _counted(h)
            total = np.frombuffer(got.get(k, b""), dtype=np.int64) + n
            others = np.zeros(len(h), dtype=np.int64)
            whole = np.flatnonzero(h)
            at = np.searchsorted(keys, h[whole])
            pair, own, count = np.unique(doc[whole] * len(keys) + at, return_inverse=True, return_counts=True)
            others[whole] = total[at] - count[own]
            left.append(others)
        words = np.frombuffer(got[0], dtype=np.int64)[0] + len(doc) - n_words[doc] if 0 in got else np.zeros(len(doc), np.int64)
        score = np.full(len(doc), np.nan)
        longest = np.zeros(len(doc), np.int64)
        used = np.zeros(len(doc), np.int64)
        for k in range(order, 0, -1):
            has = grams[k - 1] != 0
            longest[has & (longest == 0)] = k
            own = has & np.isnan(score) & (left[k - 1] > 0)
            if k > 1:
                history = np.concatenate(([0], left[k - 2][:-1]))
                own &= history > 0
            base = history if k > 1 else words
            score[own] = np.log(left[k - 1][own] / base[own]) + np.log(alpha) * (longest[own] - k)
            used[own] = k
        none = np.isnan(score)
        score[none] = np.log(alpha) * longest[none] - np.log(words[none] + 1.0)
        sums, off = np.bincount(doc, score, len(texts)), np.bincount(doc, used < longest, len(texts))
        columns = [pa.array(ids, pa.int64()), pa.array(n_words, pa.int64()), pa.array(off.astype(np.int64)), pa.array(sums.astype(np.float64))]
        return [pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_backed_off", "log_score"])]

    return with_answers(plain, answers(plain.mapInArrow(ask, ASKED), _resolve), finish, RESULT, BLOCK_BYTES)


def op1_lm_scores(spark: SparkSession, sf_dir: str, order: int = 2) -> DataFrame:
    return scores(documents(spark, sf_dir), order)


def op1_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: order ``ORDER``."""
    return op1_lm_scores(spark, sf_dir, ORDER)

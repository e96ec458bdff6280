"""Spelling variants: words one edit apart, each led to its most frequent neighbour.

Letters are hashed to a few symbols. Every different reduced word generates its one-edit neighbourhood as
64-bit keys, the keys are joined to the reduced vocabulary, and the words of classes that meet are verified
on the original strings inside the join. Of the two reduced words of a pair one generates the other: the
longer one by a deletion, of two equally long ones that with the higher symbol by a replacement. So a
neighbourhood is sent in halves and no pair is lost.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import _ODD, blocks, documents, mix, powers, stored

SYMBOLS = 6
LEAST_LETTERS, LEAST_COUNT = 5, 3
MODULUS = 97
HELD = 300_000
#: Letters are a-z and U+00C0 to U+00FF; A-Z count as a-z.
_LETTERS = "".join(map(chr, [*range(0x61, 0x7B), *range(0xC0, 0x100)]))
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256))


def text_words(doc_id: int | None, text: str | None, modulus: int = MODULUS) -> Counter:
    """Latin-1 words of one text and their counts; in one of ``modulus`` a code point is taken out."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for word, n in Counter((text or "").encode("latin-1", "replace").translate(_LOWER).split()).items():
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
        if h % modulus == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
        out[word] += n
    return out


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", letters: int = LEAST_LETTERS, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words with enough letters and occurrences; counted in the task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            batch = pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for i, value in zip(batch.column(0), batch.column(1)):
                for word, n in text_words(i.as_py(), value.as_py()).items():
                    if len(word) >= letters:
                        held[word] += n
                if len(held) > HELD:
                    yield flushed()
        yield flushed()

    rows = docs.select(F.col(doc_id).cast("long").alias("i"), F.col(text).alias("t")).mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def reduced(word, symbols: int = SYMBOLS):
    """The column's letters as symbols 0, 1, ..."""
    return F.translate(word, _LETTERS, "".join(str((ord(c) * 2654435761 >> 13) % symbols) for c in _LETTERS))


def _prefixes(words: list[bytes]) -> tuple[np.ndarray, ...]:
    """Symbols from 1 of all words in a row, prefix sums at ascending powers, inverse powers, start and end of each word."""
    data = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.uint64) - np.uint64(47)
    ends = np.cumsum([len(w) for w in words]).astype(np.int64)
    starts = ends - np.array([len(w) for w in words], dtype=np.int64)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(data * powers(len(data) + 1)[: len(data)], out=sums[1:])
    return data, sums, powers(len(data) + 1, pow(_ODD, -1, 1 << 64)), starts, ends


def keys(words: list[bytes]) -> np.ndarray:
    """Key of each reduced word."""
    _, sums, down, starts, ends = _prefixes(words)
    return mix((sums[ends] - sums[starts]) * down[starts]).view(np.int64)


def neighbours(words: list[bytes], symbols: int = SYMBOLS) -> tuple[np.ndarray, np.ndarray]:
    """(number of the word, key) of each reduced word itself, its deletions and its replacements by lower symbols."""
    data, sums, down, starts, ends = _prefixes(words)
    number = np.repeat(np.arange(len(words)), ends - starts)
    at, s = np.arange(len(data)), starts[number]
    whole = (sums[ends] - sums[starts]) * down[starts]
    out = [(np.arange(len(words)), whole)]
    # A deletion in a stretch of equal symbols gives the same word everywhere in it: taken once.
    once = np.flatnonzero((at == s) | (data != np.concatenate(([0], data[:-1]))))
    head, tail = sums[at[once]] - sums[s[once]], sums[ends[number[once]]] - sums[at[once] + 1]
    out.append((number[once], (head + tail * down[1]) * down[s[once]]))
    place = powers(len(data) + 1)[at - s]
    for symbol in range(1, symbols):
        higher = np.flatnonzero(data > symbol)
        out.append((number[higher], whole[number[higher]] - (data[higher] - np.uint64(symbol)) * place[higher]))
    return np.concatenate([o[0] for o in out]), mix(np.concatenate([o[1] for o in out])).view(np.int64)


def near_words(vocab: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, other, other_n): each pair of words of ``vocab`` (word, n) that are exactly one edit apart, once.

    The words must be different and consist of the letters of this module. Empty vocabulary: no rows.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, run in blocks(batch.column(2).to_pylist(), 100_000):
                own = batch.slice(begin, len(run))
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), own.column(2), pa.array(keys(run))], ["word", "n", "reduced", "key"])

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own_keys = batch.column(1).to_numpy(zero_copy_only=False)
            for begin, run in blocks(batch.column(0).to_pylist(), 20_000):
                number, key = neighbours(run, symbols)
                yield pa.RecordBatch.from_arrays([pa.array(own_keys[begin + number]), pa.array(key)], ["key", "near"])

    words = stored(vocab.select("word", "n", reduced(F.col("word"), symbols).alias("reduced")).mapInArrow(keyed, "word string, n long, reduced string, key long"), "words")
    classes = words.select("reduced", "key").distinct()
    met = classes.mapInArrow(generate, "key long, near long").join(words.select(F.col("key").alias("near")).distinct(), "near")
    left = met.join(words.select("key", "word", "n"), "key").drop("key")
    right = words.select(F.col("key").alias("near"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    one_edit = F.levenshtein("word", "other", 1) == 1
    pairs = left.join(right, (left["near"] == right["near"]) & one_edit).select("word", "n", "other", "other_n")
    # A pair of one class is met from both sides.
    swap = F.col("word") > F.col("other")
    return pairs.select(
        F.least("word", "other").alias("word"), F.when(swap, F.col("other_n")).otherwise(F.col("n")).alias("n"),
        F.greatest("word", "other").alias("other"), F.when(swap, F.col("n")).otherwise(F.col("other_n")).alias("other_n"),
    ).distinct()


def last_of_chains(steps: DataFrame) -> DataFrame:
    """(word, root) for the (word, form) rows of ``steps``: where following forms ends. There must be no cycle.

    Every round doubles the steps that are known; each is written, so lineage doesn't grow.
    """
    now = stored(steps.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("at"), F.col("root").alias("further"))
        joined = now.join(further, F.col("root") == F.col("at"), "left")
        nxt = stored(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if nxt.where("moved").isEmpty():
            return now
        now = nxt.drop("moved")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", symbols: int = SYMBOLS, letters: int = LEAST_LETTERS, least: int = LEAST_COUNT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary.

    Null texts have no words; a null id counts as empty text where it is hashed. Repeated rows count
    repeatedly. Of near words equally frequent the first in code-point order is the form. Very long runs of
    letters are words like others. Empty table: no rows. Other columns are not read.
    """
    vocab = stored(vocabulary(docs, doc_id, text, letters, least), "vocabulary")
    pairs = stored(near_words(vocab, symbols), "near")
    both = pairs.unionByName(pairs.selectExpr("other as word", "other_n as n", "word as other", "n as other_n"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("back"), "other")).alias("top"))
    lead = vocab.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("top.back") >= 2 * F.col("n"), F.struct(F.col("top.other").alias("form"), (-F.col("top.back")).alias("form_n"))).alias("f"),
    )
    lead = stored(lead.select("word", "f.form", "n", "n_near", "f.form_n"), "forms")
    roots = last_of_chains(lead.where("form is not null").select("word", "form"))
    return lead.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(documents(spark, sf_dir))


#: CRC-32 by its table of 256 remainders, near words by common deletions, roots by recursion.
OP11_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS c
    FROM range(256) r(i)
  )
), runs AS (
  SELECT doc_id, w, count(*) AS n FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
    FROM documents
  ) GROUP BY ALL
), hashed AS (
  SELECT w, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || w, ''), lambda ch:
      CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [192 + unicode(ch)::BIGINT // 64, 128 + unicode(ch)::BIGINT % 64] END))),
    lambda a, b: xor(t[xor(a % 256, b) + 1], a // 256)), 4294967295) AS h
  FROM runs, crc_table
), vocab AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0 THEN substring(w, 1, h % length(w)) || substring(w, h % length(w) + 2, length(w)) ELSE w END AS word FROM hashed
  ) GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3
), cuts AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS p, length(word) AS l FROM vocab
), cut AS (
  SELECT DISTINCT word, n, p, substring(word, 1, p - 1) || substring(word, p + 1, l) AS rest FROM cuts
), near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN vocab b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN vocab b ON a.rest = b.word
), best AS (
  SELECT word, count(*)::BIGINT AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY word
), lead AS (
  SELECT v.word, CASE WHEN other_n >= 2 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
  FROM vocab v LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root FROM lead
  UNION ALL SELECT c.word, l.form FROM chain c JOIN lead l ON c.root = l.word WHERE l.form IS NOT NULL
)
SELECT word, form, c.root, n, n_near, form_n
FROM lead JOIN (SELECT c.word, c.root FROM chain c JOIN lead l ON c.root = l.word WHERE l.form IS NULL) c USING (word)
"""

"""Toxicity from the nearest labelled examples by exact TF-IDF cosine over all words of the text.

Document frequencies count all documents. Every example is indexed, with frequent words as rows of a matrix
and the others as lists of the examples that have them; each text is compared with all of them. Words that
no example has count in a text's length only, which a join with their frequencies gives. The neighbours vote by
similarity. Terms that labelled examples associate with toxicity, found by exact binomial tests with a bounded
false discovery rate, are evidence beside the vote. Both are calibrated on examples that leave themselves out.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.classifier import labelled
from meterlake.llm.common import documents, labels, remainder, stored

ROWS = 20_000
NEIGHBOURS = 15
BATCH = 128
COMMON = 0.07
RATE = 0.01
BOUND = 1e-4
PRIOR = 1.0
WORDS, WORD_CHARS = 200_000, 64
PART_WORDS = 500_000
STEMS = (3, 4, 5, 6)
WORD = re.compile(r"\w+")
SEARCHED = (
    "row long, doc_id long, neighbours array<long>, toxic double, weight double, inner double, evidence array<string>, strength double, "
    "label int, own_toxic double, own_weight double, others array<string>, others_n array<int>"
)


def features(word: str) -> list[str]:
    """The word and its beginnings, which end in a star."""
    return [word, *[word[:n] + "*" for n in STEMS if len(word) >= n]]


def terms(text: str | None) -> list[str]:
    return [f for word in WORD.findall((text or "").lower()) for f in features(word)]


def words_of(text: str | None) -> Counter:
    return Counter(WORD.findall((text or "").lower()))


class Vocabulary:
    """Words and their numbers, and the telling terms of a word; those of up to ``WORDS`` words, none over ``WORD_CHARS`` long, are kept."""

    def __init__(self, words: list[str], telling: dict[str, float]):
        self.number = {w: i for i, w in enumerate(words)}
        self.telling = telling
        self.heads = {term[:STEMS[0]] for term in telling}
        self.known: dict[str, tuple[str, ...]] = {}

    def evidence(self, word: str) -> tuple[str, ...]:
        own = tuple(f for f in features(word) if f in self.telling)
        if len(word) <= WORD_CHARS:
            if len(self.known) >= WORDS:
                self.known.clear()
            self.known[word] = own
        return own

    def split(self, text: str | None) -> tuple[dict[int, int], dict[str, int], list[str]]:
        """(count of each word number, count of each other word, telling terms) of the whole text."""
        own: dict[int, int] = {}
        others: dict[str, int] = {}
        found: set[str] = set()
        for word, n in words_of(text).items():
            t = self.number.get(word)
            if t is None:
                others[word] = n
            else:
                own[t] = n
            if word[:STEMS[0]] in self.heads:  # else no beginning of the word is telling
                found.update(self.known[word] if word in self.known else self.evidence(word))
        return own, others, sorted(found)


def tail(k: int, n: int, p: float) -> float:
    """P(X >= k) for X binomial (n, p)."""
    total = 0.0
    log = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    for i in range(k, n + 1):
        term = math.exp(log)
        total += term
        if term < total * 1e-12:
            break
        if i < n:
            log += math.log((n - i) / (i + 1)) + math.log(p / (1 - p))
    return min(1.0, total)


def telling_terms(examples: DataFrame, rate: float = RATE) -> dict[str, float]:
    """Terms whose examples are toxic more often than examples are, at false discovery rate ``rate``, and by how much in log odds.

    Of terms that contain each other only the one with the larger share of toxic examples counts.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list[int]] = defaultdict(lambda: [0, 0])
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for term in set(terms(text)):
                    found[term][0] += 1
                    found[term][1] += label
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([v[0] for v in found.values()], pa.int64()), pa.array([v[1] for v in found.values()], pa.int64())], ["term", "n", "k"])

    total = examples.agg(F.count("*").alias("n"), F.sum("label").alias("k")).first()
    n, k = total["n"], total["k"] or 0
    if not 0 < k < n:
        return {}
    base = k / n
    counts = examples.select("text", "label").mapInArrow(split, "term string, n long, k long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    # The test statistic's bound (Chernoff) is a column, so the driver sees near-significant terms only.
    share = F.col("k") / F.col("n")
    gain = F.col("n") * (share * F.log(share / base) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0))
    counts = counts.withColumn("near", (share > base) & (gain > -math.log(BOUND)))
    row = counts.agg(F.count("*").alias("m"), F.collect_list(F.when(F.col("near"), F.struct("term", "n", "k"))).alias("near")).first()
    ranked = sorted((tail(r["k"], r["n"], base), (r["k"] + base) / (r["n"] + 1), r["term"]) for r in row["near"])
    passed = max((i for i, (p, _, _) in enumerate(ranked, 1) if p <= rate * i / row["m"]), default=0)
    chosen: dict[str, float] = {}
    longer: set[str] = set()
    for _, share, term in sorted(ranked[:passed], key=lambda x: (-x[1], len(x[2]), x[2])):
        word = term.rstrip("*")
        own = {word[:n] + "*" for n in STEMS if len(word) >= n} | {term}
        if not own & chosen.keys() and term not in longer:
            chosen[term] = math.log(share / (1 - share)) - math.log(base / (1 - base))
            longer |= own
    return chosen


def document_frequencies(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): the rows that have each word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for value in batch.column(0).to_pylist():
                found.update(words_of(value).keys())
                if len(found) >= PART_WORDS:
                    yield out()
                    found.clear()
        yield out()

    return docs.select(F.col(text).alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def top(sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(similarity, row) of the ``k`` largest above 0; of equal ones those first in the index."""
    least = np.partition(sims, len(sims) - k)[-k] - 2e-6 if len(sims) > k else 0.0
    rows = np.flatnonzero(sims > max(least, 1e-9))
    found = np.round(sims[rows].astype(np.float64), 6)
    order = np.lexsort((rows, -found))[:k]
    return found[order], rows[order]


class Index:
    """Unit TF-IDF vectors of all labelled examples, by word."""

    def __init__(self, vocabulary: list[str], idf: np.ndarray, examples: list[tuple[int, dict[int, int], int]], telling: dict[str, float] | None = None, rare: float = 1.0):
        """``examples``: (id, count of each word number, label); ``rare``: the idf of a word that no document has."""
        own = sorted(examples, key=lambda x: x[0])
        self.lay_out(
            vocabulary, idf, np.array([x[0] for x in own], np.int64), np.array([x[2] for x in own], np.int64), np.array([len(x[1]) for x in own], np.int64),
            np.array([t for x in own for t in x[1]], np.int32), np.array([c for x in own for c in x[1].values()], np.int32), telling or {}, rare,
        )

    @classmethod
    def of(cls, *cells) -> "Index":
        index = cls.__new__(cls)
        index.lay_out(*cells)
        return index

    def lay_out(self, vocabulary: list[str], idf: np.ndarray, ids: np.ndarray, labels: np.ndarray, sizes: np.ndarray, t: np.ndarray, c: np.ndarray, telling: dict[str, float], rare: float) -> None:
        """``sizes``: words of each example; ``t``, ``c``: their numbers and counts, example by example."""
        idf = np.asarray(idf, np.float64)
        row = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
        value = (1 + np.log(c)) * idf[t] if len(t) else np.zeros(0)
        norm = np.sqrt(np.bincount(row, value * value, len(ids)))
        value = (value / np.maximum(norm, 1e-12)[row]).astype(np.float32)
        order = np.argsort(t, kind="stable")
        ends = np.concatenate(([0], np.cumsum(np.bincount(t, minlength=len(vocabulary))))).astype(np.int64)
        self.take(vocabulary, idf, ids, labels, row[order], value[order], ends, telling, rare)
        self.weights = np.array([1.0, 0.0, 0.0])

    def take(self, vocabulary: list[str], idf: np.ndarray, ids: np.ndarray, labels: np.ndarray, row: np.ndarray, value: np.ndarray, ends: np.ndarray, telling: dict[str, float], rare: float) -> None:
        """``row``, ``value``: example and its value for each word, word by word up to ``ends``."""
        self.cells = vocabulary, idf, ids, labels, row, value, ends, telling, rare
        self.words = Vocabulary(vocabulary, telling)
        self.vocabulary, self.idf, self.ids, self.labels, self.rare = vocabulary, idf, ids, labels, rare
        self.row, self.value, self.ends = row, value, ends
        self.prior = (labels.sum() + 0.5) / (len(ids) + 2)
        self.rows_of: dict[int, list[int]] = defaultdict(list)
        for i, key in enumerate(ids.tolist()):
            self.rows_of[key].append(i)
        often = np.flatnonzero(np.diff(self.ends) > COMMON * len(ids))
        self.place = np.full(len(vocabulary), -1, np.int32)
        self.place[often] = np.arange(len(often))
        self.matrix = np.zeros((len(often), len(ids)), np.float32)
        for k, w in enumerate(often.tolist()):
            a, b = self.ends[w], self.ends[w + 1]
            self.matrix[k, self.row[a:b]] = self.value[a:b]

    def __getstate__(self) -> tuple:
        """Without the matrix and the numbers of words, which a worker makes anew; the lists come sorted."""
        return self.cells, self.weights

    def __setstate__(self, state: tuple) -> None:
        self.take(*state[0])
        self.weights = state[1]

    @property
    def lists(self) -> np.ndarray:
        """All values, words by examples."""
        out = np.zeros((len(self.vocabulary), len(self.ids)), np.float32)
        out[np.repeat(np.arange(len(self.vocabulary)), np.diff(self.ends)), self.row] = self.value
        return out

    def unit(self, counts: dict[int, int]) -> dict[int, float]:
        value = {t: (1 + math.log(c)) * self.idf[t] for t, c in counts.items()}
        norm = math.sqrt(sum(v * v for v in value.values()))
        return {t: v / norm for t, v in value.items()} if norm else {}

    def similarities(self, texts: list[dict[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """(cosine of each text with each example over the words of the vocabulary, squared lengths of the texts over them)."""
        common = np.zeros((len(texts), len(self.matrix)), np.float32)
        rest, inner = [], np.zeros(len(texts))
        for i, counts in enumerate(texts):
            t = np.fromiter(counts, np.int64, len(counts))
            q = (1 + np.log(np.fromiter(counts.values(), np.float64, len(counts)))) * self.idf[t]
            inner[i] = (q * q).sum()
            q /= math.sqrt(inner[i]) or 1.0
            place = self.place[t]
            common[i, place[place >= 0]] = q[place >= 0]
            rest.append((t[place < 0], q[place < 0]))
        sims = common @ self.matrix
        for i, (t, q) in enumerate(rest):
            a, n = self.ends[t], self.ends[t + 1] - self.ends[t]
            at = np.arange(n.sum()) + np.repeat(a - np.cumsum(n) + n, n)
            if len(at):
                sims[i] += np.bincount(self.row[at], self.value[at] * np.repeat(q, n), len(self.ids))
        return sims, inner

    def nearest(self, counts: dict[int, int], k: int = NEIGHBOURS) -> list[tuple[float, int]]:
        """(cosine, row) of the ``k`` nearest examples that share a word; of equal ones those first in the index."""
        found, rows = top(self.similarities([counts])[0][0], k)
        return list(zip(found.tolist(), rows.tolist()))

    def search(self, ids: list[int | None], texts: list[str | None]) -> Iterator[tuple]:
        """For each text (doc_id, neighbours, toxic weight, weight, inner, evidence, strength, label, own toxic weight, own weight, others, their counts).

        Weights are sums of cosines over the words of the vocabulary, whose squared length is ``inner``. The text of an
        example has a label and the weights of its neighbours without itself.
        """
        for begin in range(0, len(texts), BATCH):
            parts = [self.words.split(text) for text in texts[begin:begin + BATCH]]
            sims, inner = self.similarities([p[0] for p in parts])
            for i, (key, (_, others, evidence)) in enumerate(zip(ids[begin:begin + BATCH], parts)):
                found, rows = top(sims[i], NEIGHBOURS)
                own = self.rows_of.get(key) if key is not None else None
                label = toxic = weight = None
                if own:
                    sims[i, own] = 0
                    f, r = top(sims[i], NEIGHBOURS)
                    label, toxic, weight = int(self.labels[own[0]]), float(f @ self.labels[r]), float(f.sum())
                strength = max((self.words.telling[t] for t in evidence), default=0.0)
                yield key, self.ids[rows].tolist(), float(found @ self.labels[rows]), float(found.sum()), float(inner[i]), evidence, strength, label, toxic, weight, list(others), list(others.values())

    def odds(self, toxic, weight):
        """Log odds of the votes of neighbours with these sums of cosines."""
        v = (PRIOR * self.prior + toxic) / (PRIOR + weight)
        return np.log(v / (1 - v))

    def calibrate(self, odds: np.ndarray, strength: np.ndarray, label: np.ndarray, steps: int = 200) -> None:
        """Fit the weights of the votes' log odds and of the evidence, and a shift, to the labels."""
        if len(set(label.tolist())) < 2:
            return
        x, y, w = np.column_stack([odds, strength, np.ones(len(odds))]), label.astype(float), np.array([1.0, 0.0, 0.0])
        aim = w.copy()
        for _ in range(steps):  # Newton's method, with a little shrinkage towards no change
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x.T * (p * (1 - p))) @ x + 0.1 * np.eye(3), x.T @ (p - y) + 0.1 * (w - aim))
            w = w - step
            if abs(step).max() < 1e-9:
                break
        self.weights = np.array([max(w[0], 0.05), max(w[1], 0.0), w[2]])

    def score(self, text: str | None) -> tuple[float, list[int], list[str]]:
        """(calibrated score, ids of the neighbours, evidence) of a text; words that no example has count as in no document."""
        _, near, toxic, weight, inner, evidence, strength, *_, others = next(self.search([None], [text]))
        share = math.sqrt(inner / (inner + sum(((1 + math.log(c)) * self.rare) ** 2 for c in others))) if inner else 0.0
        z = float(self.weights @ [self.odds(toxic * share, weight * share), strength, 1.0])
        return 1 / (1 + math.exp(-z)), near, evidence


def fit(docs: DataFrame, marks: DataFrame, rows: int = ROWS) -> tuple[Index, DataFrame, int]:
    """The index of about ``rows`` labelled examples at most, not yet calibrated, the document frequencies of all words, and the number of ``docs``."""
    spark = docs.sparkSession
    examples = stored(labelled(docs, marks, "toxic", 5, 0, rows), "examples")
    telling = telling_terms(examples)
    frequencies = stored(document_frequencies(docs), "frequencies")
    total = docs.count()
    used = document_frequencies(examples).select("word").join(frequencies, "word").toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    vocabulary = used.column("word").to_pylist()
    idf = np.log((1 + total) / (1 + used.column("n").to_numpy())) + 1
    shared = spark.sparkContext.broadcast(vocabulary)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(shared.value, {})
        for batch in batches:
            own = [sorted(words.split(text)[0].items()) for text in batch.column(1).to_pylist()]
            t, c = ([np.array([x[k] for x in o], np.int32).tobytes() for o in own] for k in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(t, pa.binary()), pa.array(c, pa.binary())], ["doc_id", "label", "t", "c"])

    own = examples.select("doc_id", "text", "label").mapInArrow(vectors, "doc_id long, label int, t binary, c binary").toArrow().sort_by([("doc_id", "ascending"), ("t", "ascending")])
    t, c = (own.column(k).to_pylist() for k in ("t", "c"))
    sizes = np.array([len(x) // 4 for x in t], np.int64)
    joined = [np.frombuffer(b"".join(x), np.int32) for x in (t, c)]
    index = Index.of(vocabulary, idf, own.column("doc_id").to_numpy(), own.column("label").to_numpy().astype(np.int64), sizes, *joined, telling, math.log(1 + total) + 1)
    return index, frequencies, total


def searched(docs: DataFrame, index: Index, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """:meth:`Index.search` of every row, with a number."""
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(index))
    names = [part.split()[0] for part in SEARCHED.split(", ")]
    texts, longs, ints = pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int32())
    types = [pa.int64(), pa.int64(), longs, *[pa.float64()] * 3, texts, pa.float64(), pa.int32(), pa.float64(), pa.float64(), texts, ints]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = cloudpickle.loads(shared.value)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for begin in range(0, len(batch), 1024):
                part = batch.slice(begin, 1024)
                found = own.search(part.column(0).to_pylist(), part.column(1).to_pylist())
                rows = [(row + i, *x) for i, x in enumerate(found)]
                row += len(rows)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SEARCHED)


def judged(docs: DataFrame, index: Index, frequencies: DataFrame, total: int) -> DataFrame:
    """(doc_id, score, neighbours, evidence) of every row of ``docs``; calibrates ``index`` on the examples among them."""
    found = stored(searched(docs, index), "searched")
    others = found.select("row", F.explode(F.arrays_zip("others", "others_n")).alias("o")).select("row", F.col("o.others").alias("word"), F.col("o.others_n").alias("c"))
    value = (1 + F.log("c")) * (F.log((1 + F.lit(total)) / (1 + F.col("n"))) + 1)
    outer = others.join(frequencies, "word").groupBy("row").agg(F.sum(value * value).alias("outer"))
    share = F.when(F.col("inner") > 0, F.sqrt(F.col("inner") / (F.col("inner") + F.coalesce("outer", F.lit(0.0))))).otherwise(0.0)
    whole = stored(found.drop("others", "others_n").join(outer, "row", "left").withColumn("share", share).drop("row", "inner", "outer"), "lengths")
    own = whole.where("label IS NOT NULL").selectExpr("own_toxic * share AS toxic", "own_weight * share AS weight", "strength", "label").toArrow()
    toxic, weight, strength, label = (own.column(k).to_numpy() for k in ("toxic", "weight", "strength", "label"))
    index.calibrate(index.odds(toxic, weight), strength, label)
    v = (F.lit(float(PRIOR * index.prior)) + F.col("toxic") * F.col("share")) / (F.lit(PRIOR) + F.col("weight") * F.col("share"))
    a, b, c = (F.lit(float(w)) for w in index.weights)
    return whole.select("doc_id", (1 / (1 + F.exp(-(a * F.log(v / (1 - v)) + b * F.col("strength") + c)))).alias("score"), "neighbours", "evidence")


def scored(text: Column, index: Index, spark: SparkSession) -> Column:
    """Struct of score, neighbours and evidence of each whole text by :meth:`Index.score`; null counts as empty."""
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(index))

    @F.pandas_udf("score double, neighbours array<long>, evidence array<string>")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = cloudpickle.loads(shared.value)
        for texts in batches:
            yield pd.DataFrame([own.score(x) for x in texts], columns=["score", "neighbours", "evidence"])

    return nearest(text)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = judged(docs, *fit(docs, labels(spark, sf_dir)))
    return out.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "neighbours", "evidence")

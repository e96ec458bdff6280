"""N-gram Jaccard join with Bayesian candidate pruning.

Different texts that share a band of MinHash values are candidates. Their values are compared step by step;
a pair is dropped as soon as the posterior probability that it reaches the threshold is below a tolerance.
The groups that survive are verified exactly, set against set. Pairs exist in tasks only, as tiles of a
bounded number of texts by another; what leaves a task is a row per text. Copies of a text are one text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import blocks, components, documents, shingles, stored

N = 5
THRESHOLD = 0.8
VALUES, BAND, STEP = 128, 4, 16
TOLERANCE = 1e-6
TILE = 1024
TILE_SHINGLES = 2_000_000
COLUMNS = 4096


def minhash(sets: list[np.ndarray], values: int = VALUES) -> np.ndarray:
    """A row of 16-bit MinHash values for every non-empty set of 64-bit hashes."""
    rng = np.random.default_rng(20240611)
    a = rng.integers(0, 1 << 32, values, dtype=np.uint32) | np.uint32(1)
    b = rng.integers(0, 1 << 32, values, dtype=np.uint32)
    out = np.empty((len(sets), values), dtype=np.uint16)
    if sets:
        h = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
        starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
        for k in range(values):
            out[:, k] = np.minimum.reduceat(h * a[k] + b[k], starts).astype(np.uint16)
    return out


@lru_cache
def least_matches(values: int = VALUES, step: int = STEP, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[int, ...]:
    """After 1, 2, .. steps: the fewest equal values with P(similarity >= threshold) >= tolerance, even prior."""
    s = (np.arange(20_000) + 0.5) / 20_000
    out = []
    for n in range(step, values + 1, step):
        m = np.arange(n + 1)[:, None]
        log = m * np.log(s) + (n - m) * np.log1p(-s)
        weight = np.exp(log - log.max(axis=1, keepdims=True))
        tail = weight[:, s >= threshold].sum(axis=1) / weight.sum(axis=1)
        out.append(int(np.argmax(tail >= tolerance)))
    return tuple(out)


def surviving(sig: np.ndarray, i: np.ndarray, j: np.ndarray, least: tuple[int, ...], step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i, j) of rows of ``sig`` that no step drops."""
    matches = np.zeros(len(i), dtype=np.int32)
    for k, fewest in enumerate(least):
        part = sig[:, k * step:(k + 1) * step]
        matches += (part[i] == part[j]).sum(axis=1, dtype=np.int32)
        stay = matches >= fewest
        i, j, matches = i[stay], j[stay], matches[stay]
    return i, j


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row that each of ``n`` rows is connected with."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def in_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal integer ``keys`` in sorted batches, each as one table."""
    kept: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if kept is not None:
            table = pa.concat_tables([kept, table])
        if not len(table):
            continue
        columns = [table.column(k).to_numpy() for k in keys]
        change = np.zeros(len(table), dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist()]
        for a, b in zip(starts, starts[1:]):
            yield table.slice(a, b - a)
        kept = table.slice(starts[-1])
    if kept is not None and len(kept):
        yield kept


def tiled(members: DataFrame, group: str, chunks: str, key: str) -> DataFrame:
    """Every member once for each tile (group, lo, hi) of its chunk: lo <= hi, side 0 is chunk lo, 1 is hi.

    A group of n chunks has n * (n + 1) / 2 tiles, so a large group spreads over many tasks.
    """
    rows = members.withColumn("chunk", F.pmod(F.xxhash64(F.lit("chunk"), key), F.col(chunks)))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col(chunks) - 1)))
    rows = rows.withColumn("lo", F.least("chunk", "with")).withColumn("hi", F.greatest("chunk", "with"))
    rows = rows.withColumn("side", (F.col("chunk") == F.col("hi")).cast("int")).drop("chunk", "with", chunks)
    return rows.repartition(group, "lo", "hi").sortWithinPartitions(group, "lo", "hi")


def _pairs(table: pa.Table, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``same`` holds between the sides of a tile, or above the diagonal if it has only one."""
    if table.column("lo")[0].as_py() == table.column("hi")[0].as_py():
        return np.nonzero(np.triu(same, 1))
    side = table.column("side").to_numpy()
    return np.nonzero(same & (side[:, None] < side[None, :]))


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, key, n, sig) of every row: key is the text's MD5, sig null where the text has no word."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, texts = batch.column(0), batch.column(1).to_pylist(), batch.column(2)
            for begin in range(0, len(keys), 2048):
                own = keys[begin:begin + 2048]
                first = {k: i for i, k in reversed(list(enumerate(own)))}
                found = {}
                few = texts.slice(begin, 2048).take(pa.array(list(first.values()), pa.int64())).to_pylist()
                names = list(first)
                for start, run in blocks(few):
                    sets = shingles(run, N)
                    sig = iter(minhash([s for s in sets if len(s)]))
                    for k, s in enumerate(sets, start):
                        found[names[k]] = (len(s), next(sig).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(begin, 2048), pa.array(own), pa.array([found[k][0] for k in own], pa.int64()),
                    pa.array([found[k][1] for k in own], pa.binary()),
                ], ["doc_id", "key", "n", "sig"])

    plain = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.md5(plain).alias("key"), plain.alias("text")).mapInArrow(sign, "doc_id long, key string, n long, sig binary")


def candidate_edges(texts: DataFrame) -> DataFrame:
    """(a, b) of keys for rows (key, sig): enough pairs to connect all texts joined by surviving candidates."""
    width, least = BAND * 2, least_matches()
    band = F.transform(F.sequence(F.lit(0), F.lit(VALUES // BAND - 1)), lambda b: F.xxhash64(b, F.substring("sig", b * width + 1, F.lit(width))))
    thin = texts.where("sig IS NOT NULL").select(F.xxhash64("key").alias("kid"), F.posexplode(band).alias("band", "bucket"))
    shared = stored(thin.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1"), "buckets")
    members = stored(thin.join(shared, "bucket"), "members")
    signed = members.join(texts.select(F.xxhash64("key").alias("kid"), "key", "sig"), "kid")
    tiles = tiled(signed.withColumn("chunks", F.ceil(F.col("m") / TILE)).select("bucket", "band", "key", "sig", "chunks"), "bucket", "chunks", "key")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[str] = []
        b: list[str] = []
        for table in in_groups(batches, ["bucket", "lo", "hi"]):
            if len(table) > 1:
                sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype=np.uint16).reshape(len(table), VALUES)
                bands = sig.view(np.uint64)
                own = table.column("band")[0].as_py()
                fresh = np.ones((len(table), len(table)), dtype=bool)
                for k in range(own):  # a pair that shares an earlier band is compared there
                    fresh &= bands[:, k, None] != bands[None, :, k]
                i, j = surviving(sig, *_pairs(table, fresh), least)
                keys = table.column("key").to_pylist()
                label = roots(len(keys), i, j)
                linked = np.flatnonzero(label != np.arange(len(keys))).tolist()
                a += [keys[k] for k in linked]
                b += [keys[label[k]] for k in linked]
            if len(a) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], ["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], ["a", "b"])

    return tiles.select("bucket", "lo", "hi", "side", "band", "key", "sig").mapInArrow(compare, "a string, b string").distinct()


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of ``sets``, by products of bounded incidence blocks."""
    all_, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(all_, kind="stable")
    all_, owner = all_[order], owner[order]
    number = np.cumsum(np.concatenate(([0], (all_[1:] != all_[:-1]).astype(np.int64)))) if len(all_) else np.zeros(0, np.int64)
    often = np.bincount(number)[number] > 1 if len(all_) else np.zeros(0, bool)
    number, owner = number[often], owner[often]
    out = np.zeros((len(sets), len(sets)), dtype=np.float64)
    if len(number):
        number = np.cumsum(np.concatenate(([0], (number[1:] != number[:-1]).astype(np.int64))))
        for low in range(0, int(number[-1]) + 1, COLUMNS):
            a, b = np.searchsorted(number, [low, low + COLUMNS])
            block = np.zeros((len(sets), min(COLUMNS, int(number[b - 1]) - low + 1)), dtype=np.float32)
            block[owner[a:b], number[a:b] - low] = 1
            out += block @ block.T
    return out


def verified(docs: DataFrame, texts: DataFrame, groups: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(key, links, linked_docs, to): exact links of texts, by tile; ``to`` is a text in the same component."""
    num, den = round(threshold * 1000), 1000
    members = groups.join(texts.select("key", "rep", "copies", "n"), groups["node"] == texts["key"]).drop("node")
    sizes = members.groupBy("root").agg(F.count("*").alias("m"), F.sum("n").alias("total"))
    sizes = sizes.withColumn("chunks", F.greatest(F.ceil(F.col("m") / TILE), F.ceil(F.col("total") / TILE_SHINGLES)))
    members = stored(members.join(sizes.select("root", "chunks"), "root"), "grouped")
    known = F.coalesce(F.col("doc_id"), F.lit(0)), F.col("doc_id").isNull()
    found = docs.withColumns({"known": known[0], "none": known[1]}).select("key", "known", "none", "text")
    members = members.withColumns({"known": F.coalesce("rep", F.lit(0)), "none": F.col("rep").isNull()})
    # At scale neither side is small: the same join at every size.
    found = found.join(members.hint("merge"), ["key", "known", "none"]).select("key", "root", "copies", "chunks", "text").distinct()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts_ = batch.column("text")
            for begin in range(0, len(batch), 512):
                rows = [s.tobytes() for _, run in blocks(texts_.slice(begin, 512).to_pylist()) for s in shingles(run, N)]
                part = batch.slice(begin, 512)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in ("key", "root", "copies", "chunks")] + [pa.array(rows, pa.binary())], ["key", "root", "copies", "chunks", "sets"])

    members = found.mapInArrow(sets, "key string, root string, copies long, chunks long, sets binary")
    tiles = tiled(members.withColumn("group", F.xxhash64("root")), "group", "chunks", "key")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in in_groups(batches, ["group", "lo", "hi"]):
            own = [np.frombuffer(x, dtype=np.uint64) for x in table.column("sets").to_pylist()]
            n = np.array([len(s) for s in own], dtype=np.float64)
            both = overlaps(own)
            i, j = _pairs(table, both * den >= num * (n[:, None] + n[None, :] - both))
            if not len(i):
                continue
            copies = table.column("copies").to_numpy()
            links = np.bincount(i, minlength=len(own)) + np.bincount(j, minlength=len(own))
            docs_ = np.bincount(i, copies[j], len(own)) + np.bincount(j, copies[i], len(own))
            label = roots(len(own), i, j)
            keys, linked = table.column("key").to_pylist(), np.flatnonzero(links).tolist()
            yield pa.RecordBatch.from_arrays([
                pa.array([keys[k] for k in linked]), pa.array(links[linked], pa.int64()),
                pa.array(docs_[linked].astype(np.int64)), pa.array([keys[label[k]] for k in linked]),
            ], ["key", "links", "linked_docs", "to"])

    return tiles.select("group", "lo", "hi", "side", "key", "copies", "sets").mapInArrow(check, "key string, links long, linked_docs long, to string")


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, key, class_id, keep_key, n_links, n_linked_docs, copy_id, n_copies) of every row.

    Two texts are linked if the Jaccard similarity of their sets of five-word windows is 0.8 or more; a
    text of fewer words has one window. class_id is the smallest doc_id of all documents connected by
    links and copies, copy_id that of equal texts. n_links counts other texts, n_linked_docs the other
    documents, copies included. Texts without words have no links; equal ones are copies. Null text is
    empty text; class_id is null only if all its ids are. No rows give no rows; other columns aren't read.
    """
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("key", F.md5("text"))
    signed = stored(signatures(plain), "signed")
    texts = stored(signed.groupBy("key", "n", "sig").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "texts")
    groups = stored(components(candidate_edges(texts)), "candidates")
    links = stored(verified(plain, texts, groups), "links")
    found = stored(components(links.select(F.col("key").alias("a"), F.col("to").alias("b"))), "classes")
    counts = links.groupBy("key").agg(F.sum("links").alias("links"), F.sum("linked_docs").alias("linked_docs"))
    one = texts.select("key", "rep", "copies").join(found.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    first = one.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "key")).alias("first"))
    first = stored(first, "first")
    summary = one.join(first, "root").join(counts, "key", "left").select(
        "key", F.col("first.rep").alias("class_id"), F.col("first.key").alias("keep_key"),
        F.coalesce("links", F.lit(0)).alias("n_links"),
        (F.coalesce("linked_docs", F.lit(0)) + F.col("copies") - 1).alias("n_linked_docs"),
        F.col("rep").alias("copy_id"), F.col("copies").alias("n_copies"),
    )
    return signed.select("doc_id", "key").join(stored(summary, "summary"), "key")


def without_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: of each class the text with the smallest doc_id, once."""
    from pyspark.sql import Window

    keys = ["__key", "__id", "__none"]
    kept = near_classes(docs, doc_id, text).where("key = keep_key AND doc_id <=> class_id").select(
        F.col("key").alias("__key"), F.coalesce("doc_id", F.lit(0)).alias("__id"), F.col("doc_id").isNull().alias("__none")).distinct()
    own = F.col(doc_id).cast("long")
    rows = docs.withColumn("__key", F.md5(F.coalesce(F.col(text), F.lit("")))).withColumns({"__id": F.coalesce(own, F.lit(0)), "__none": own.isNull()})
    rows = rows.join(kept, keys, "left_semi")
    first = Window.partitionBy(*keys).orderBy(F.xxhash64(*[F.col(c) for c in docs.columns]))
    return rows.withColumn("__n", F.row_number().over(first)).where("__n = 1").select(*docs.columns)


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(documents(spark, sf_dir)).select("doc_id", "class_id", "n_links", "n_linked_docs", "copy_id", "n_copies")


OP4_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), k AS (
  SELECT text, min(doc_id) AS rep, count(*) AS copies FROM t GROUP BY text
), w AS (
  SELECT rep, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM k
), s AS (
  SELECT DISTINCT rep, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT rep, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT rep, count(*) AS n FROM s GROUP BY rep
), p AS (
  SELECT x.rep AS a, y.rep AS b, count(*) AS common FROM s x JOIN s y ON x.g = y.g AND x.rep <> y.rep GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN n na ON na.rep = a JOIN n nb ON nb.rep = b WHERE 5 * common >= 4 * (na.n + nb.n - common)
), r(a, b) AS (
  SELECT rep, rep FROM k UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b
), c AS (
  SELECT a AS rep, min(b) AS class_id FROM r GROUP BY a
), m AS (
  SELECT l.a AS rep, count(*) AS links, sum(k.copies)::BIGINT AS docs FROM l JOIN k ON k.rep = l.b GROUP BY 1
)
SELECT t.doc_id, c.class_id, coalesce(m.links, 0) AS n_links, coalesce(m.docs, 0) + k.copies - 1 AS n_linked_docs, k.rep AS copy_id, k.copies AS n_copies
FROM t JOIN k USING (text) JOIN c USING (rep) LEFT JOIN m USING (rep)
"""

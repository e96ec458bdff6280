"""Mixing sources to target weights with built-in functions only.

The words of a source form one stream, its documents in pseudorandom order, cut into fixed-length blocks.
Every slot of an output shard draws a source, which makes the counts per shard multinomial; the counts are
then settled to the exact number of slots of each source, which moves only the sampling error. The k-th slot
of a source takes the block at place k of a pseudorandom permutation, another one in each pass.

The driver holds one row per source (the table of weights); everything else is distributed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.llm.common import WORD, documents, stored

BLOCK_WORDS = 64
SHARD_SLOTS = 65_536
RUN_SLOTS, TASKS = 4096, 16_384
BUCKETS = 4096
ROUNDS = 16
WEIGHTS = (5, 2, 1)
SEED = 7


def share_out(sizes: list[int], weights: list[float], share: float = 1.5, passes: float = 2.0) -> list[float]:
    """Targets: ``share`` of all sizes by weight, none above ``passes`` times its size, the excess shared again."""
    targets, left, open_ = [0.0] * len(sizes), share * sum(sizes), set(range(len(sizes)))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        over = {i for i in open_ if unit * weights[i] > passes * sizes[i]}
        for i in over or open_:
            targets[i] = float(passes * sizes[i]) if over else unit * weights[i]
            left -= targets[i]
        open_ -= over or set(open_)
    return targets


@dataclass(frozen=True)
class Source:
    s: int
    name: str | None
    size: int
    target: float
    blocks: int
    slots: int


def plan_sources(thin: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, passes: float = 2.0, block_words: int = BLOCK_WORDS) -> list[Source]:
    """The sources of rows (source, size) in code point order, null last, weighed by ``weights`` in turn."""
    rows = [(r["source"], r["size"]) for r in thin.groupBy("source").agg(F.sum("size").alias("size")).collect()]
    rows.sort(key=lambda r: (r[0] is None, r[0] or ""))
    turn = [float(weights[i % len(weights)]) for i in range(len(rows))]
    out = []
    for i, ((name, size), target) in enumerate(zip(rows, share_out([r[1] for r in rows], turn, share, passes))):
        blocks = -(-size // block_words)
        out.append(Source(i, name, size, target, blocks, min(int(passes * blocks), round(target * blocks / size)) if size else 0))
    return out


def _table(spark: SparkSession, sources: list[Source]) -> DataFrame:
    def literal(x: Source) -> Column:
        return F.struct(
            F.lit(x.s).alias("s"), F.lit(x.name).cast("string").alias("name"), F.lit(x.size).cast("long").alias("source_size"),
            F.lit(x.target).cast("double").alias("target"), F.lit(x.blocks).cast("long").alias("blocks"), F.lit(x.slots).cast("long").alias("slots"),
        )

    return spark.range(1).select(F.inline(F.array(*[literal(x) for x in sources])))


def permuted(x: Column, n: Column, *keys: Column, rounds: int = ROUNDS) -> Column:
    """Place of ``x`` in a pseudorandom permutation of 0..n-1: a swap-or-not shuffle keyed by ``keys``.

    Every round pairs x with K - x mod n and swaps the pair or not by a bit that both share.
    """

    def turn(at: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*keys, r), n) - at, n)
        bit = F.xxhash64(*keys, r, F.greatest(at, other)).bitwiseAND(F.lit(1))
        return F.when(bit == 1, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), x.cast("long"), turn)


def _alias(slots: list[int]) -> tuple[list[float], list[int]]:
    """Walker's tables: draw a cell evenly, keep it with its probability, else take its alias."""
    total, n = sum(slots), len(slots)
    scaled = [x * n / total for x in slots]
    keep, other = [1.0] * n, list(range(n))
    small = [i for i in range(n) if scaled[i] < 1]
    large = [i for i in range(n) if scaled[i] >= 1]
    while small and large:
        i, j = small.pop(), large[-1]
        keep[i], other[i] = scaled[i], j
        scaled[j] -= 1 - scaled[i]
        if scaled[j] < 1:
            small.append(large.pop())
    for i in small:  # rounding only
        keep[i] = 1.0 if slots[i] else 0.0
        other[i] = max(range(n), key=lambda k: slots[k])
    return keep, other


def draw_slots(spark: SparkSession, sources: list[Source], seed: int = SEED, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(shard, s, k): source s fills its k-th slot, k from 0 to its slots - 1, in output shard ``shard``."""
    total = sum(x.slots for x in sources)
    if not total:
        return spark.range(0).select(F.lit(0).cast("long").alias("shard"), F.lit(0).alias("s"), F.lit(0).cast("long").alias("k"))
    keep, other = _alias([x.slots for x in sources])
    cell = F.pmod(F.xxhash64(F.lit(seed), F.lit("cell"), "id"), F.lit(len(sources))).cast("int")
    coin = F.pmod(F.xxhash64(F.lit(seed), F.lit("coin"), "id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    slots = spark.range(total).select(F.floor(F.col("id") / shard_slots).alias("shard"), cell.alias("cell"), coin.alias("coin"))
    keeps, others = F.array(*[F.lit(x) for x in keep]), F.array(*[F.lit(x) for x in other])
    drawn = F.when(F.col("coin") < F.element_at(keeps, F.col("cell") + 1), F.col("cell")).otherwise(F.element_at(others, F.col("cell") + 1))
    counts = stored(slots.select("shard", drawn.alias("s")).groupBy("shard", "s").agg(F.count("*").alias("n")), "counts")

    # Settle: slots of a source beyond its number go, in order, to the sources that drew too few.
    have = {r["s"]: r["n"] for r in counts.groupBy("s").agg(F.sum("n").alias("n")).collect()}
    spare, bounds, at = [], [], 0
    for x in sources:
        spare.append(at - x.slots)
        at += max(0, have.get(x.s, 0) - x.slots)
    lack, at = [], 0
    for x in sources:
        missing = x.slots - have.get(x.s, 0)
        if missing > 0:
            lack.append((x.s, have.get(x.s, 0) - at))
            bounds.append(at)
            at += missing
    numbers = F.array(*[F.lit(x.slots).cast("long") for x in sources])
    before = F.sum("n").over(Window.partitionBy("s").orderBy("shard")) - F.col("n")
    runs = counts.withColumn("first", before).withColumn("slots", F.element_at(numbers, F.col("s") + 1))
    # Few rows become many: short runs are dealt to a task per shard, at most TASKS, before they are slots.
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RUN_SLOTS).cast("long")))
    runs = runs.withColumn("part", part).repartition(min(TASKS, -(-total // shard_slots)), "shard", "s", "part")
    last = F.col("first") + F.least(F.col("part") + RUN_SLOTS, F.col("n")) - 1
    runs = runs.select("shard", "s", "slots", F.explode(F.sequence(F.col("first") + F.col("part"), last)).alias("k"))
    if not lack:
        return runs.select("shard", "s", "k")
    number = F.col("k") + F.element_at(F.array(*[F.lit(x).cast("long") for x in spare]), F.col("s") + 1)
    place = F.size(F.filter(F.array(*[F.lit(x).cast("long") for x in bounds]), lambda b: b <= F.col("number")))
    moved = runs.withColumn("over", F.col("k") >= F.col("slots")).withColumn("number", number).withColumn("to", F.when(F.col("over"), place))
    return moved.select(
        "shard",
        F.when(F.col("over"), F.element_at(F.array(*[F.lit(x[0]) for x in lack]), F.col("to"))).otherwise(F.col("s")).alias("s"),
        F.when(F.col("over"), F.col("number") + F.element_at(F.array(*[F.lit(x[1]).cast("long") for x in lack]), F.col("to"))).otherwise(F.col("k")).alias("k"),
    )


def block_draws(spark: SparkSession, sources: list[Source], seed: int = SEED, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(shard, s, pass, block) of every slot of the mix.

    The planner takes the slots for as few as the counts they come from: join them by merge, never by broadcast.
    """
    slots = draw_slots(spark, sources, seed, shard_slots)
    if not sources:
        return slots.select("shard", "s", F.col("k").alias("pass"), F.col("k").alias("block"))
    blocks = F.element_at(F.array(*[F.lit(max(1, x.blocks)).cast("long") for x in sources]), F.col("s") + 1)
    slots = slots.withColumn("blocks", blocks).withColumn("pass", F.floor(F.col("k") / F.col("blocks")))
    return slots.select("shard", "s", "pass", permuted(F.col("k") % F.col("blocks"), F.col("blocks"), F.lit(seed), F.col("s"), F.col("pass")).alias("block"))


def located(thin: DataFrame, sources: list[Source], seed: int = SEED) -> DataFrame:
    """Rows with s, source_size, target and ``start``, the place of their first word in the source's stream.

    Order in a source is by hash, in buckets: sums over buckets first, so no source is sorted as a whole.
    """
    table = _table(thin.sparkSession, sources)
    rows = thin.join(F.broadcast(table), thin["source"].eqNullSafe(table["name"])).drop("name")
    keys = [c for c in thin.columns if c != "source"]
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), *keys)).withColumn("bucket", F.pmod("h", F.lit(BUCKETS)))
    sums = rows.groupBy("s", "bucket").agg(F.sum("size").alias("n"))
    sums = sums.withColumn("base", F.sum("n").over(Window.partitionBy("s").orderBy("bucket")) - F.col("n")).drop("n")
    inside = Window.partitionBy("s", "bucket").orderBy("h", *keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("upto", F.sum("size").over(inside)).join(sums, ["s", "bucket"])
    return rows.withColumn("start", F.col("base") + F.col("upto") - F.col("size")).drop("bucket", "h", "base", "upto", "blocks", "slots")


def pieces(rows: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """A row per document and block that it reaches into: block, first word in the document, words."""
    end = F.col("start") + F.col("size")
    last = F.floor((end - 1) / block_words)
    cut = rows.where("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block_words), last)))
    low = F.greatest(F.col("start"), F.col("block") * block_words)
    return cut.withColumn("first", low - F.col("start")).withColumn("words", F.least(end, (F.col("block") + 1) * block_words) - low)


def word_count(text: str) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), F.lit(0))).cast("long")


def mixed(docs: DataFrame, seed: int = SEED, block_words: int = BLOCK_WORDS, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row.

    Rows without words take none. Of rows alike in id, source and size any may be the one taken. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    thin = stored(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(text).alias("size")), "sizes")
    sources = plan_sources(thin, block_words=block_words)
    if not sources:
        return thin.select("doc_id", "size", F.col("size").alias("source_size"), F.col("size").cast("double").alias("target"), F.col("size").alias("taken"))
    rows = stored(located(thin, sources, seed), "located")
    times = block_draws(spark, sources, seed).groupBy("s", "block").agg(F.count("*").alias("times"))
    keys = ["doc_id", "size", "source_size", "target"]
    cut = pieces(rows, block_words).select("s", "start", *keys, "block", "words").join(times.hint("merge"), ["s", "block"], "left")
    taken = cut.groupBy("s", "start", *keys).agg(F.sum(F.col("words") * F.coalesce(F.col("times"), F.lit(0))).alias("taken"))
    return taken.select(*keys, "taken").unionByName(rows.where("size = 0").select(*keys, F.lit(0).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, seed: int = SEED, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a row per document and pass that takes words of it.

    A pass that takes all words has the text as it is, else the words taken, in order, one space between.
    """
    spark, columns = docs.sparkSession, docs.columns
    own = {"doc_id": F.col("doc_id"), "source": F.col("source"), "size": word_count("text"), "digest": F.md5(F.coalesce(F.col("text"), F.lit("")))}
    thin = stored(docs.select(*[v.alias(k) for k, v in own.items()]), "sizes")
    sources = plan_sources(thin, block_words=block_words)
    if not sources:
        return docs
    found = stored(located(thin, sources, seed), "located")
    draws = block_draws(spark, sources, seed).select("s", "block", "pass")
    cut = pieces(found, block_words).join(draws.hint("merge"), ["s", "block"])
    spans = cut.groupBy("s", "start", "doc_id", "size", "digest", "pass").agg(F.sum("words").alias("taken"), F.sort_array(F.collect_list(F.struct("first", "words"))).alias("spans"))
    names = _table(spark, sources).select("s", F.col("name").alias("source"))
    passes = spans.join(F.broadcast(names), "s").groupBy("doc_id", "source", "size", "digest", "start").agg(F.collect_list(F.struct("pass", "taken", "spans")).alias("passes"))

    def numbered(df: DataFrame, by: dict[str, Column], order: str) -> DataFrame:
        """With keys that are never null, and a number for rows alike in them."""
        df = df.withColumns({f"__{k}": F.to_json(F.struct(v.alias("v"))) for k, v in by.items()})
        return df.withColumn("__n", F.row_number().over(Window.partitionBy(*[f"__{k}" for k in by]).orderBy(order)))

    keys = [*[f"__{k}" for k in own], "__n"]
    right = numbered(passes, {k: F.col(k) for k in own}, "start").select(*keys, F.col("passes").alias("__passes"))
    both = numbered(docs, own, "text").join(right, keys).select(*columns, own["size"].alias("__size"), F.explode("__passes").alias("__p"))
    both = both.withColumn("__words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    part = F.array_join(F.flatten(F.transform("__p.spans", lambda x: F.slice("__words", (x.getField("first") + 1).cast("int"), x.getField("words").cast("int")))), " ")
    text = F.when(F.col("__p.taken") == F.col("__size"), F.col("text")).otherwise(part)
    out = both.withColumn("text", text)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*columns)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(documents(spark, sf_dir))

"""Minimum-cost-flow resharding: from old shard sizes and new capacities, the block transfers that move the
fewest bytes; then only files of affected shards are rewritten.

A shard consists of blocks, hash ranges of its rows. The flow is solved over shards, its arcs are filled
with whole blocks, and what is collected is one row per block, whose number is a parameter.
"""

from __future__ import annotations

import heapq
import uuid
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.llm.common import crc, documents, stored
from meterlake.session import constant_frame, shared_dir

BLOCKS = 32_768
SHARDS = 8
OLD_SHARDS = 12


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> dict[tuple[int, int], int]:
    """Units from each old shard i to each new shard j, all supply placed, at the least sum of cost(i, j).

    Successive shortest paths with potentials. Raises if the capacities don't hold the supply.
    """
    if sum(supply) > sum(capacity):
        raise ValueError("capacities are smaller than the data")
    m, n = len(supply), len(capacity)
    source, sink = m + n, m + n + 1
    head: list[list[int]] = [[] for _ in range(m + n + 2)]
    to, room, price = [], [], []

    def arc(u: int, v: int, units: int, c: int) -> None:
        for a, b, r, p in ((u, v, units, c), (v, u, 0, -c)):
            head[a].append(len(to))
            to.append(b)
            room.append(r)
            price.append(p)

    for i, s in enumerate(supply):
        arc(source, i, s, 0)
    for j, s in enumerate(capacity):
        arc(m + j, sink, s, 0)
    first = len(to)
    for i in range(m):
        for j in range(n):
            arc(i, m + j, sum(supply), cost(i, j))
    potential, left = [0] * (m + n + 2), sum(supply)
    while left:
        far = [None] * (m + n + 2)
        far[source], via, heap = 0, {}, [(0, source)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > far[u]:
                continue
            for e in head[u]:
                if room[e] and (far[v := to[e]] is None or d + price[e] + potential[u] - potential[v] < far[v]):
                    far[v], via[v] = d + price[e] + potential[u] - potential[v], e
                    heapq.heappush(heap, (far[v], v))
        most = max(x for x in far if x is not None)
        potential = [p + (x if x is not None else most) for p, x in zip(potential, far)]
        v, units = sink, left
        while v != source:
            units, v = min(units, room[via[v]]), to[via[v] ^ 1]
        v = sink
        while v != source:
            room[via[v]] -= units
            room[via[v] ^ 1] += units
            v = to[via[v] ^ 1]
        left -= units
    return {(i, j): room[first + 2 * (i * n + j) + 1] for i in range(m) for j in range(n) if room[first + 2 * (i * n + j) + 1]}


def fill_arcs(blocks: dict[int, list[tuple[int, int]]], flow: dict[tuple[int, int], int], capacity: list[int]) -> dict[tuple[int, int], int]:
    """(old shard, block) -> new shard: each arc gets whole blocks, the largest first into the emptiest arc.

    What rounding leaves over or under is evened out with the smallest blocks, so that no new shard
    exceeds its capacity by more than one block.
    """
    placed: dict[tuple[int, int], int] = {}
    room = list(capacity)
    late = []
    for i, own in sorted(blocks.items()):
        heap = [(-units, j) for (k, j), units in flow.items() if k == i]
        heapq.heapify(heap)
        for block, size in sorted(own, key=lambda x: (-x[1], x[0])):
            want, j = heapq.heappop(heap)
            if size > -want and size > 0:
                late.append((size, i, block))
                heapq.heappush(heap, (want, j))
            else:
                placed[i, block] = j
                room[j] -= size
                heapq.heappush(heap, (want + size, j))
    for size, i, block in sorted(late, reverse=True):
        j = max(range(len(room)), key=lambda k: (room[k], k == i))
        placed[i, block] = j
        room[j] -= size
    return placed


def block_of(keys: list[Column], per_shard: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(per_shard)).cast("int")


def transfers(rows: DataFrame, capacity: list[float] | None, shards: int, old_shards: int) -> DataFrame:
    """(old_shard, block, shard, first_slot) for rows (old_shard, block, size); one row per block.

    ``capacity``: shares of the new shards, equal if none. Bytes that stay in the shard of the same
    number cost nothing, every other byte one. Of plans that move equally few bytes any may come.
    """
    sizes = rows.groupBy("old_shard", "block").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    total = sum(r["bytes"] for r in sizes)
    share = capacity or [1.0] * shards
    limits = [int(total * s / sum(share)) for s in share]
    for j in range(total - sum(limits)):
        limits[j % shards] += 1
    supply = [0] * old_shards
    own = defaultdict(list)
    count = {}
    for r in sizes:
        supply[r["old_shard"]] += r["bytes"]
        own[r["old_shard"]].append((r["block"], r["bytes"]))
        count[r["old_shard"], r["block"]] = r["n"]
    flow = min_cost_flow(supply, limits, lambda i, j: int(i != j)) if total else {}
    placed = fill_arcs(own, flow, limits)
    next_slot, out = [0] * shards, []
    for (i, block), j in sorted(placed.items()):
        out.append((i, block, j, next_slot[j]))
        next_slot[j] += count[i, block]
    schema = "old_shard int, block int, shard int, first_slot long"
    return constant_frame(rows.sparkSession, out, rows.sparkSession.createDataFrame([], schema).schema)


def reshard(rows: DataFrame, keys: list[str], shards: int = SHARDS, old_shards: int = OLD_SHARDS, capacity: list[float] | None = None, blocks: int = BLOCKS) -> DataFrame:
    """``rows`` (with old_shard, size and ``keys``) plus block, shard and slot, gapless from 0 in a shard.

    Slots follow blocks and in a block the keys; rows alike in all keys are interchangeable. The plan
    broadcast to the rows has at most ``blocks`` rows. No rows: none come back.
    """
    per_shard = max(1, blocks // old_shards)
    rows = stored(rows.withColumn("block", block_of([F.col(k) for k in keys], per_shard)), "blocks")
    plan = transfers(rows, capacity, shards, old_shards)
    place = Window.partitionBy("old_shard", "block").orderBy(*keys)
    return (
        rows.withColumn("place", F.row_number().over(place) - 1)
        .join(F.broadcast(plan), ["old_shard", "block"])
        .withColumn("slot", F.col("first_slot") + F.col("place"))
        .drop("place", "first_slot")
    )


def rewrite_affected(spark: SparkSession, root: str, new_root: str, plan: DataFrame, keys: list[str], old_shards: int, blocks: int = BLOCKS) -> list[int]:
    """Write the files of new shards that gain or lose rows; returns their numbers.

    ``root`` holds folders old_shard=i. A new shard that keeps exactly the rows of the old one of its
    number isn't written and stays where it is. Written as ``new_root``/shard=j, the old shard of a row as ``came_from``.
    """
    moves = plan.select("old_shard", "block", "shard")
    changed = [r[0] for r in moves.where("old_shard <> shard").select(F.explode(F.array("old_shard", "shard"))).distinct().orderBy("col").collect()]
    if not changed:
        return []
    rows = spark.read.parquet(root)
    rows = rows.withColumn("block", block_of([F.col(k) for k in keys], max(1, blocks // old_shards)))
    rows = rows.join(F.broadcast(moves), ["old_shard", "block"]).where(F.col("shard").isin(changed))
    rows = rows.drop("block").withColumnRenamed("old_shard", "came_from")
    rows.hint("rebalance", "shard").write.option("compression", "zstd").partitionBy("shard").parquet(new_root)
    return changed


def shards_as_they_lie(spark: SparkSession, root: str, new_root: str, changed: list[int], plan: DataFrame, shards: int) -> DataFrame:
    """Rows of all new shards, read from the files they are in: those rewritten, and the old ones that nothing left or entered."""
    new = sorted({*range(shards)} - {*changed})
    old = spark.read.parquet(root).where(F.col("old_shard").isin(new)) if new else None
    kept = None if old is None else old.withColumns({"shard": F.col("old_shard"), "came_from": F.col("old_shard")}).drop("old_shard")
    if not changed:
        return kept
    moved = spark.read.parquet(new_root)
    return moved if kept is None else moved.unionByName(kept.select(*moved.columns))


def op2_min_cost_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From 12 old shards, one hash class of ``source`` each, to 8 of near equal bytes.

    The old shards are written with their whole texts, the affected ones rewritten; every column comes from the
    shards as they then lie. Null texts are empty; rows of a null source are a shard's like others.
    """
    docs = documents(spark, sf_dir)
    size, check = (F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + 1).cast("long"), crc(F.col("text"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", size.alias("size"), check.alias("text_crc32"),
        F.pmod(F.xxhash64("source"), F.lit(OLD_SHARDS)).cast("int").alias("old_shard"),
    )
    keys = ["doc_id", "text_crc32", "size"]
    folder = f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}/shards-{uuid.uuid4().hex}"
    root, new_root = f"{folder}/old", f"{folder}/new"
    rows.write.option("compression", "zstd").partitionBy("old_shard").parquet(root)
    old = spark.read.schema(rows.schema).parquet(root).select(*keys, "old_shard")
    plan = transfers(old.withColumn("block", block_of([F.col(k) for k in keys], BLOCKS // OLD_SHARDS)), None, SHARDS, OLD_SHARDS)
    changed = rewrite_affected(spark, root, new_root, plan, keys, OLD_SHARDS)
    lying = shards_as_they_lie(spark, root, new_root, changed, plan, SHARDS)
    read = lying.select("doc_id", size.alias("size"), check.alias("text_crc32"), "shard", F.col("came_from").alias("old_shard"))
    read = read.withColumn("block", block_of([F.col(k) for k in keys], BLOCKS // OLD_SHARDS))
    place = Window.partitionBy("old_shard", "block").orderBy(*keys)
    first = F.broadcast(plan.select("old_shard", "block", "first_slot"))
    placed = read.withColumn("place", F.row_number().over(place) - 1).join(first, ["old_shard", "block"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first_slot") + F.col("place")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "old_shard",
    )

"""The training-data operators against brute force, SQL and edge rows."""

from __future__ import annotations

import collections
import hashlib
import math
import os
import re
import zlib

import numpy as np
import pytest

import compare
from meterlake.llm import classifier, common, exact, exchange, jaccard, lm_scores, mixing, packing, queries, reshard, rules, suffixes, toxicity

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
COPY = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
ROWS = [
    (1, COPY, "en", "a", 1), (2, COPY, "en", "a", 1), (2, COPY, "en", "a", 1), (3, COPY.replace(" ", "\n "), "en", "b", 1),
    (4, None, None, None, None), (5, "", "en", "b", 0), (None, COPY, "en", None, 1), (7, " \t\n", "en", "a", 3),
    (8, "ab " * 30_000, "en", "a", 90_000), (9, "x", "en", "b", 1), (10, "é 𝔘 <|endoftext|> ß", "de", "b", 3),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, repeated rows and columns whose names the operators use too."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(ROWS, schema)
    return frame.selectExpr("*", "1 as size", "2 as h", "'x' as key", "3 as shard", "4 as score", "5 as kept", "6 as words")


@pytest.fixture(scope="module")
def texts(spark):
    return [(r["doc_id"], r["text"] or "") for r in common.documents(spark, SF).select("doc_id", "text").collect()]


def nothing(spark):
    return common.documents(spark, SF).where("doc_id < 0")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, name):
    assert compare.difference(queries.QUERIES[name](spark, SF), compare.connect(SF), queries.ORACLES[name]) is None


def test_edges_of_row_operators(docs, spark):
    judged = {(r["doc_id"], r["n_words"]): r for r in rules.judge(docs).collect()}
    assert len(judged) == 10 and not judged[4, 0]["kept"] and judged[8, 30_000]["n_repeat_words"] == 30_000
    assert rules.judge(nothing(spark)).count() == 0
    scored = docs.select(classifier.score(docs["text"], np.zeros(1 << classifier.BITS, np.float32), spark).alias("s")).collect()
    assert [r["s"] for r in scored] == [0.5] * len(ROWS)
    index = toxicity.Index(["bad"], np.ones(1), [(1, {0: 2}, 1), (2, {}, 0)])
    found = docs.select(toxicity.scored(docs["text"], index, spark).alias("s")).collect()
    assert len(found) == len(ROWS) and all(0 <= r["s"]["score"] < 0.5 for r in found)


def test_resharding_is_gapless_even_and_minimal(spark):
    rows = [tuple(r) for r in reshard.op2_min_cost_resharding(spark, SF).select("shard", "slot", "size", "old_shard").collect()]
    size = collections.Counter()
    for shard, _, n, _ in rows:
        size[shard] += n
    for s in range(8):
        assert sorted(r[1] for r in rows if r[0] == s) == list(range(sum(r[0] == s for r in rows)))
    largest = max(r[2] for r in rows)
    assert max(size.values()) - min(size.values()) <= largest
    supply = collections.Counter()
    for _, _, n, old in rows:
        supply[old] += n
    share = sum(size.values()) / 8
    needed = sum(supply.values()) - sum(min(supply[s], share) for s in range(8))
    moved = sum(r[2] for r in rows if r[0] != r[3])
    assert needed - largest * 12 <= moved <= needed + largest * 12


def test_min_cost_flow_against_all_plans():
    import itertools

    cost = [[3, 1, 4], [1, 5, 9]]
    flow = reshard.min_cost_flow([3, 2], [2, 2, 2], lambda i, j: cost[i][j])
    best = min(
        sum(c * cost[i][j] for (i, j), c in zip(itertools.product(range(2), range(3)), x))
        for x in itertools.product(range(4), repeat=6)
        if (sum(x[:3]), sum(x[3:])) == (3, 2) and all(x[j] + x[j + 3] <= 2 for j in range(3))
    )
    assert sum(u * cost[i][j] for (i, j), u in flow.items()) == best
    with pytest.raises(ValueError):
        reshard.min_cost_flow([5], [2, 2], lambda i, j: 0)


def test_resharding_edges(docs, spark):
    from pyspark.sql import functions as F

    rows = docs.select("doc_id", F.lit(5).cast("long").alias("size"), F.lit(0).alias("old_shard"), F.lit(0).cast("long").alias("text_crc32"))
    out = reshard.reshard(rows, ["doc_id", "text_crc32"], shards=3, old_shards=1).collect()
    assert len(out) == len(ROWS) and {r["shard"] for r in out} <= {0, 1, 2}
    assert reshard.reshard(rows.where("size < 0"), ["doc_id"], shards=3, old_shards=1).count() == 0


def test_rewrite_affected_moves_only_what_changed(spark, tmp_path):
    rows = spark.createDataFrame([(i, i % 2, 10) for i in range(100)], "doc_id long, old_shard int, size long")
    rows.write.partitionBy("old_shard").parquet(str(tmp_path / "old"))
    keyed = rows.withColumn("block", reshard.block_of([rows["doc_id"]], 32))
    plan = reshard.transfers(keyed, None, 4, 2)
    changed = reshard.rewrite_affected(spark, str(tmp_path / "old"), str(tmp_path / "new"), plan, ["doc_id"], 2, 64)
    assert changed == [0, 1, 2, 3]
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "new")).select("doc_id").collect()) == list(range(100))


def test_untouched_shards_stay_where_they_lie(spark, tmp_path):
    """Shard 0 is full with its own rows; 1 gives to 2: only these two are written."""
    rows = spark.createDataFrame([(i, min(i // 50, 2) if i < 110 else 1, 10, f"text {i}") for i in range(150)], "doc_id long, old_shard int, size long, text string")
    rows.write.partitionBy("old_shard").parquet(str(tmp_path / "old"))
    keyed = rows.withColumn("block", reshard.block_of([rows["doc_id"]], 20))
    plan = reshard.transfers(keyed, [50.0, 60.0, 40.0], 3, 3)
    changed = reshard.rewrite_affected(spark, str(tmp_path / "old"), str(tmp_path / "new"), plan, ["doc_id"], 3, 60)
    assert changed == [1, 2] and sorted(p.name for p in (tmp_path / "new").glob("shard=*")) == ["shard=1", "shard=2"]
    lying = reshard.shards_as_they_lie(spark, str(tmp_path / "old"), str(tmp_path / "new"), changed, plan, 3)
    got = {r["doc_id"]: (r["shard"], r["came_from"], r["text"]) for r in lying.collect()}
    assert len(got) == 150 and all(got[i] == (0, 0, f"text {i}") for i in range(50))
    assert abs(sum(s == 1 for s, _, _ in got.values()) - 60) <= 10
    still = reshard.shards_as_they_lie(spark, str(tmp_path / "old"), str(tmp_path / "new"), [], plan, 3)
    assert sorted(r["doc_id"] for r in still.collect()) == list(range(150))


def test_jaccard_edges(docs, spark):
    out = {(r["doc_id"], r["key"]): r for r in jaccard.near_classes(docs).collect()}
    copy = hashlib.md5(COPY.encode()).hexdigest()
    spread = hashlib.md5(COPY.replace(" ", "\n ").encode()).hexdigest()
    assert out[1, copy]["class_id"] == out[3, spread]["class_id"] == out[None, copy]["class_id"] == 1
    assert out[3, spread]["n_links"] == 1 and out[3, spread]["n_linked_docs"] == 4
    assert out[1, copy]["n_linked_docs"] == 4 and out[1, copy]["n_copies"] == 4
    assert out[4, hashlib.md5(b"").hexdigest()]["class_id"] == 4 and out[8, hashlib.md5(("ab " * 30_000).encode()).hexdigest()]["n_links"] == 0
    assert jaccard.near_classes(nothing(spark)).count() == 0
    kept = jaccard.without_near_copies(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 7, 8, 9, 10]


def test_posterior_pruning_keeps_what_may_reach():
    least = jaccard.least_matches()
    assert list(least) == sorted(least) and 0 < least[-1] < 0.8 * jaccard.VALUES


def test_exact_edges(docs, spark):
    rows = exact.exact_groups(docs).collect()
    assert len(rows) == len(ROWS)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["keep_id"] == 3 and by_id[3]["kept"] and by_id[1]["group_size"] == 5 and not by_id[None]["kept"]
    assert by_id[4]["keep_id"] == 7 and by_id[7]["group_size"] == 3
    kept = exact.without_copies(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 7, 8, 9, 10]
    assert exact.exact_groups(nothing(spark)).count() == 0


def test_chunks_follow_content():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 123, 60_000, dtype=np.uint8).tobytes()
    ends = exact.cuts(data)
    assert ends[-1] == len(data) and all(b - a <= exact.MOST for a, b in zip([0, *ends], ends))
    shifted = exact.cuts(b"zz" + data)
    assert len(set(ends) & {e - 2 for e in shifted}) > 0.8 * len(ends)


def test_a_clash_of_chunk_hashes_gets_two_identifiers(spark):
    chunks = spark.createDataFrame([(5, bytearray(b"a")), (5, bytearray(b"b")), (6, bytearray(b"c"))], "h long, bytes binary")
    assert sorted((bytes(r["bytes"]), r["extra"]) for r in exact.clashes(chunks).collect()) == [(b"a", 0), (b"b", 1)]


def test_mixing(docs, spark):
    rows = mixing.op7_mixing(spark, SF).collect()
    by = collections.defaultdict(list)
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by[r["source_size"], r["target"]].append(r["taken"])
    assert all(abs(sum(v) - target) <= 0.05 * target for (_, target), v in by.items())
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.op7_mixing(spark, SF).collect()))
    edge = mixing.mixed(docs).collect()
    assert len(edge) == len(ROWS) and all(r["taken"] <= 2 * r["size"] for r in edge)
    assert mixing.mixed(nothing(spark)).count() == 0
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    taken = collections.Counter()
    for r in out.collect():
        taken[r["source"]] += len(WORD.findall(r["text"]))
    want = collections.Counter()
    for r in edge:
        want[r["source_size"]] += r["taken"]
    assert sorted(taken.values()) == sorted(v for v in want.values() if v)


def test_mixing_plan_is_native(spark):
    plan = mixing.op7_mixing(spark, SF)._jdf.queryExecution().toString() + rules.op3_quality_rules(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert re.search(r"SortMergeJoin \[s#\d+, block#\d+L\]", plan)


def test_many_slots_are_dealt_to_many_tasks(spark):
    sources = [mixing.Source(0, "a", 64_000, 96_000.0, 1000, 1500), mixing.Source(1, "b", 6400, 12_800.0, 100, 200)]
    slots = mixing.draw_slots(spark, sources, shard_slots=100)
    assert len({r["shard"] for r in slots.collect()}) == 17
    assert sorted((r["s"], r["k"]) for r in slots.collect()) == [(0, k) for k in range(1500)] + [(1, k) for k in range(200)]
    whole = mixing.draw_slots(spark, [mixing.Source(0, "a", 64 * 9000, 64.0 * 13_000, 9000, 13_000)])
    assert sorted(r["k"] for r in whole.collect()) == list(range(13_000))


def test_packed_keys_come_back():
    keys = np.sort(np.random.default_rng(1).integers(0, (1 << 64) - 1, 1000, dtype=np.uint64, endpoint=True))
    for own in (keys, keys[:1], np.array([0, 5, 5, (1 << 64) - 1], np.uint64)):
        assert (exchange.unpacked(exchange.packed(own)) == own).all()


def test_shares_stop_at_two_passes():
    assert mixing.share_out([100, 100, 1000], [5.0, 2.0, 1.0]) == [200.0, 200.0, 1400.0]
    assert sum(mixing.share_out([10, 0, 30], [1.0, 1.0, 1.0])) == pytest.approx(60)


def test_permutations_are_permutations(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 7, 100, 257):
        seen = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(1), F.lit(2)).alias("p")).collect()
        assert sorted(r["p"] for r in seen) == list(range(n))


def test_lm_scores_against_counts(texts, spark):
    one, two, words = collections.Counter(), collections.Counter(), {}
    for key, text in texts:
        w = words[key] = WORD.findall(text)
        one.update(w)
        two.update(zip(w, w[1:]))
    total = sum(one.values())
    for r in lm_scores.op1_lm_scores(spark, SF).collect():
        w = words[r["doc_id"]]
        own1, own2, score, off = collections.Counter(w), collections.Counter(zip(w, w[1:])), 0.0, 0
        for i, x in enumerate(w):
            pair = two[w[i - 1], x] - own2[w[i - 1], x] if i else 0
            history = one[w[i - 1]] - own1[w[i - 1]] if i else 0
            if pair and history:
                score += math.log(pair / history)
                continue
            back = min(i, 1)
            alone = one[x] - own1[x]
            score += math.log(alone / (total - len(w))) + back * math.log(0.4) if alone else (back + 1) * math.log(0.4) - math.log(total - len(w) + 1)
            off += back or not alone
        assert (r["n_words"], r["n_backed_off"]) == (len(w), off) and r["log_score"] == pytest.approx(score)


def test_registered_scores_back_off_from_three_words(texts, spark):
    counts, words = collections.Counter(), {}
    for key, text in texts:
        w = words[key] = WORD.findall(text)
        counts.update(tuple(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    total = sum(map(len, words.values()))
    for r in queries.QUERIES["op1_lm_scores"](spark, SF).collect():
        w = words[r["doc_id"]]
        own = collections.Counter(tuple(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
        score, off = 0.0, 0
        for i in range(len(w)):
            longest = min(i + 1, 3)
            for k in range(longest, 0, -1):
                gram = tuple(w[i - k + 1:i + 1])
                seen = counts[gram] - own[gram]
                base = counts[gram[:-1]] - own[gram[:-1]] if k > 1 else total - len(w)
                if seen and base:
                    score += math.log(seen / base) + (longest - k) * math.log(0.4)
                    break
            else:
                k = 0
                score += longest * math.log(0.4) - math.log(total - len(w) + 1)
            off += k < longest
        assert (r["n_words"], r["n_backed_off"]) == (len(w), off) and r["log_score"] == pytest.approx(score)


def test_lm_scores_shuffle_less_than_four_times_their_input(spark):
    from pyspark.sql import functions as F

    def shuffled() -> dict[str, int]:
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName(): files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle")}

    path = "/root/testdata/sf0.01/documents.parquet"
    frame = spark.read.parquet(path).select("doc_id", "text")
    before = shuffled()
    assert lm_scores.scores(frame, order=3).agg(F.count("*")).first()[0] == 1000
    moved = sum(size for name, size in shuffled().items() if name not in before)
    assert 0 < moved < 4 * os.path.getsize(path)


def test_ranges_ask_and_answer_in_key_order():
    keys = np.unique(common.mix(np.arange(1, 5000, dtype=np.uint64)))
    for chosen in (keys, keys[:1], keys[:0], np.array([1, 2**64 - 1], dtype=np.uint64)):
        for buckets in (1, 8, 1561):
            n = np.arange(len(chosen), dtype=np.uint32)
            rows = exchange.asked_ranges(7, 3, chosen, n, buckets)
            assert [r[0] for r in rows] == sorted({r[0] for r in rows}) and all(0 <= r[0] < buckets for r in rows)
            assert np.concatenate([exchange.unpacked(r[3]) for r in rows] or [chosen]).tolist() == chosen.tolist()
            assert b"".join(r[4] for r in rows) == n.tobytes()
    for data in (b"", b"x", bytes(100_000), keys.tobytes()):
        assert exchange.opened(exchange.squeezed(data)) == data
    for chosen in (keys, keys[:1], keys[:0]):
        assert exchange.opened_keys(exchange.squeezed_keys(exchange.packed(chosen))) == exchange.packed(chosen)


def test_lm_score_edges(docs, spark):
    rows = lm_scores.scores(docs, order=3).collect()
    assert len(rows) == len(ROWS) and {r["log_score"] for r in rows if not r["n_words"]} == {0.0}
    assert all(np.isfinite(r["log_score"]) for r in rows) and lm_scores.scores(nothing(spark)).count() == 0


def brute_repeats(rows, length=50):
    first = {}
    for key, data in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for i in range(len(data) - length + 1):
            first.setdefault(data[i:i + length], math.inf if key is None else key)
    for key, data in rows:
        gone = np.zeros(len(data) + 1, dtype=bool)
        for i in range(len(data) - length + 1):
            if first[data[i:i + length]] < (math.inf if key is None else key):
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        yield key, len(data), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()


def test_repeats_against_all_windows(texts, docs, spark):
    got = sorted(tuple(r) for r in suffixes.op8_suffix_array_dedup(spark, SF).collect())
    assert got == sorted(brute_repeats([(k, t.encode()) for k, t in texts]))
    edge = sorted((tuple(r)[:5] for r in suffixes.without_repeats(docs).collect()), key=str)
    assert edge == sorted(brute_repeats([(r[0], (r[1] or "").encode()) for r in ROWS]), key=str)
    assert suffixes.without_repeats(nothing(spark)).count() == 0


def test_index_family_levels_grow_geometrically():
    family = exchange.IndexFamily()
    rng = np.random.default_rng(5)
    for _ in range(16):
        keys = rng.integers(0, 1 << 60, 64).astype(np.uint64)
        family.add(keys, np.arange(64), np.arange(64))
    assert len(family.levels) <= 5
    family.add(np.array([7], np.uint64), np.array([3]), np.array([9]))
    family.add(np.array([7], np.uint64), np.array([2]), np.array([4]))
    assert [x.tolist() for x in family.scan(np.array([7], np.uint64))] == [[2], [9]]


@pytest.mark.parametrize("query, label, least", [("op5_quality_classifier", "quality", 0.95), ("op9_toxicity", "toxic", 0.94)])
def test_held_out_accuracy(spark, query, label, least):
    sf = "/root/testdata/sf0.1"
    out = queries.QUERIES[query](spark, sf).join(common.labels(spark, sf), "doc_id").where("held_out")
    right = out.selectExpr(f"avg(if(predicted = {label}, 1.0, 0.0)) as a").first()["a"]
    assert right >= least


def test_index_finds_the_true_nearest():
    rng = np.random.default_rng(9)
    names = [f"t{i}" for i in range(12)]
    examples = [(i, {int(t): int(rng.integers(1, 4)) for t in rng.choice(12, rng.integers(1, 5), replace=False)}, int(rng.integers(0, 2))) for i in range(1000)]
    index = toxicity.Index(names, rng.random(12) + 1, examples)
    for _ in range(50):
        counts = {int(t): 1 for t in rng.choice(12, 3, replace=False)}
        query = np.zeros(12, np.float32)
        for t, v in index.unit(counts).items():
            query[t] = v
        true = sorted(np.round(np.tensordot(query, index.lists, 1).ravel(), 6), reverse=True)[: toxicity.NEIGHBOURS]
        assert [s for s, _ in index.nearest(counts)] == pytest.approx([float(x) for x in true], abs=2e-6)


def test_a_copy_without_telling_terms_has_its_original_as_neighbour(spark):
    clean = [(i, f"plain words about topic {i % 7} and number {i}", 0) for i in range(40)]
    toxic = [(100 + i, f"zorb grunt{'le' * (i % 3)} people {i}", 1) for i in range(12)]
    odd = (200, "quixotic blether upon thrawn folk", 1)
    held = next(i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 5 == 0)
    rows = [*clean, *toxic, odd]
    docs = spark.createDataFrame([*[(i, t) for i, t, _ in rows], (held, odd[1]), (held, odd[1] + " unheard"), (None, None)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5], "doc_id long, toxic int")
    assert zlib.crc32(b"200") % 5
    out = toxicity.judged(docs, *toxicity.fit(docs, marks)).where("doc_id IS NULL OR doc_id >= 200").collect()
    by = collections.defaultdict(list)
    for r in out:
        by[r["doc_id"]].append(r)
    assert all(r["neighbours"][0] == 200 and not r["evidence"] for r in by[held])
    # An unheard word lengthens the text, so its neighbours weigh less.
    assert by[held][0]["score"] != by[held][1]["score"] and min(r["score"] for r in by[held]) > by[None][0]["score"]
    assert by[None][0]["neighbours"] == []


def test_all_words_count_in_the_cosine():
    index = toxicity.Index(["a", "b", "c"], np.array([1.0, 2.0, 3.0]), [(1, {0: 1, 1: 1}, 0), (2, {1: 1, 2: 2}, 1), (3, {}, 0)])
    near = dict((index.ids[i], s) for s, i in index.nearest({0: 1, 1: 1}))
    other = 3 * (1 + math.log(2))
    assert near == pytest.approx({1: 1.0, 2: 4 / math.sqrt(5 * (4 + other * other))}, abs=1e-5)
    assert index.score("a b unheard")[0] != index.score("a b")[0]


def test_packing_keeps_every_token(docs, texts, spark):
    encoder = packing.Encoder.of(packing.default_vocabulary())
    import public_tokenizers
    plain = packing.Encoder.of(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.op10_best_fit_packing(spark, SF).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for key, text in texts:
        ids = np.array([*plain.ids(text), packing.END], dtype="<u4")
        assert encoder.ids(text) == plain.ids(text)
        own = sorted(by_doc[key], key=lambda r: r["piece"])
        at = 0
        for r in own:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids) and all(r["length"] == 1024 for r in own[1:])
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    total = sum(r["length"] for r in rows)
    assert len(by_sequence) <= 1.02 * math.ceil(total / 1024) + 1
    pieces = packing.token_pieces(docs, packing.default_vocabulary(), with_ids=True)
    packed = packing.pack(pieces.drop("ids"))
    assert sum(len(r["ids"]) // 2 for r in packing.sequences(pieces).collect()) == sum(r["length"] for r in packed.collect())
    assert packing.pack(packing.token_pieces(nothing(spark), packing.default_vocabulary())).count() == 0


def test_packed_sequences_are_written_with_their_ids(docs, spark):
    encoder = packing.Encoder.of(packing.default_vocabulary())
    rows = packing.packed_rows(docs, packing.default_vocabulary())
    assert rows.inputFiles() and packing.packed_rows(nothing(spark), packing.default_vocabulary()).count() == 0
    found = collections.defaultdict(list)
    for r in rows.collect():
        own = np.frombuffer(r["ids"], packing.NARROW).tolist()
        assert len(own) == sum(x["length"] for x in r["pieces"]) <= packing.LENGTH
        for x in r["pieces"]:
            found[x["doc_id"]].append((x["start"], own[x["offset"]:x["offset"] + x["length"]]))
    for key, text, *_ in ROWS:
        if [x[0] for x in ROWS].count(key) == 1:
            assert [i for _, ids in sorted(found[key]) for i in ids] == [*encoder.ids(text or ""), packing.END]
    assert sum(len(x) for x in found.values()) == packing.places(rows).count()


def test_best_fit_closes_the_fullest():
    assert packing.best_fit([6, 6, 4, 3], 10, 2) == ([0, 1, 0, 1], [0, 0, 6, 6])
    assert packing.best_fit([6, 7, 8, 4], 10, 2)[0] == [0, 1, 2, 0]


def test_pipeline_stages(docs, spark):
    import corpus_pipeline

    now = common.documents(spark, SF)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = common.stored(stage(spark, now, SF), name)
        assert now.columns == ["doc_id", "text", "lang", "source", "n_chars"] and now.count()
    assert corpus_pipeline.STAGES[-1][1](spark, now, SF).count()
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for frame in (plain, plain.where("1 = 0")):
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, frame, SF).count()

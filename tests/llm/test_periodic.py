"""Periodic runs against trying every period, and edge rows."""

from __future__ import annotations

import hashlib
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from meterlake.llm import common, periodic

SF = "/root/testdata/sf0.001"


def all_runs(words: list, least_length: int = 6, least_exponent: int = 4) -> list[tuple[int, int, int]]:
    """Every period, every maximal stretch; those with a smaller period fall out."""
    n, out = len(words), {}
    for q in range(1, n // least_exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            end = i
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end + q - i
            if length >= max(least_length, least_exponent * q):
                own = words[i:i + length]
                if not any(own[k:] == own[:-k] for k in range(1, q)):
                    out[i, q] = length
            i = end
    return sorted((s, n, q) for (s, q), n in out.items())


def expected(doc_id, text) -> tuple:
    words = (text or "").encode("utf-8", "surrogatepass").split()
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = all_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = None
    for s, length, q in sorted(runs, key=lambda r: (r[0], r[2])):
        if best is None or length * best[2] > best[1] * q:
            best = (s, length, q)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *four, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), min_size=1, max_size=4), st.integers(0, 8), st.integers(1, 6))
def test_blocks_against_every_period(texts, times, width):
    texts = texts + [texts[0][:width] * times + texts[-1]]
    assert periodic.block_runs(texts) == [all_runs(t) for t in texts]
    assert periodic.block_runs(texts, 5, 3) == [all_runs(t, 5, 3) for t in texts]


def test_query_against_every_period(spark):
    rows = common.documents(spark, SF).select("doc_id", "text").collect()
    got = periodic.op12_periodic_runs(spark, SF).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((expected(*r) for r in rows), key=repr)
    assert sum(r["n_runs"] > 0 for r in got) > 10


def test_edges(spark):
    loop = "one two three four five six seven "
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (None, loop * 6), (4, loop * 5), (4, loop * 5), (5, "x" * 400_000), (6, "a " * 5), (7, "a " * 6),
        (8, "ab cd " * 60_000), (9, "b a a a a a a b a a a a a a b"), (10, "é ß é ß é ß é ß é"), (11, "a\x0bb a\x0cb a b a b a b"), (12, "a b " * 6),
    ]
    frame = spark.createDataFrame([(i, t, 1, "x", 2, 3, 4) for i, t in rows], "doc_id long, text string, runs int, collapsed string, start int, length int, period int")
    got = sorted(map(tuple, periodic.digest(periodic.periodic_runs(frame, edit=periodic.looped)).select(*COLUMNS).collect()), key=repr)
    short = [r for r in rows if r[0] != 8]
    assert sorted((g for g in got if g[0] != 8), key=repr) == sorted((expected(*r) for r in short), key=repr)
    plain = {r["doc_id"]: r for r in periodic.periodic_runs(frame).collect()}
    assert [tuple(x) for x in plain[8]["runs"]] == [(0, 120_000, 2)] and plain[8]["collapsed"] == "ab cd"
    assert plain[6]["runs"] == [] and plain[7]["collapsed"] == "a" and plain[1]["n_words"] == 0
    assert periodic.op12_periodic_runs(spark, SF).where("false").count() == 0
    assert periodic.digest(periodic.periodic_runs(frame.where("doc_id < 0"))).count() == 0

"""Spelling variants against brute force over all pairs, and edge rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from meterlake.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})
SCHEMA = "doc_id long, text string, word string, n long, key string, other int"


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(rows) -> list[tuple]:
    n = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    vocab = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = {w: [v for v in vocab if one_edit(w, v)] for w in vocab}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-vocab[v], v), default=None)
        form[w] = best if best is not None and vocab[best] >= 2 * vocab[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), vocab[w], len(near[w]), vocab.get(form[w])) for w in vocab)


def result(df) -> list[tuple]:
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert all((r["form"] is None) == (r["form_n"] is None) for r in rows)
    return sorted((r["word"], r["form"] or "", *r[2:]) for r in rows)


def test_against_all_pairs(spark):
    rng = random.Random(7)
    base = ["".join(rng.choice("abcdéß") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    variants = [w[:i] + rng.choice("abcdéßÿ") + w[i + rng.randint(0, 1):] for w in base for i in (0, len(w) // 2, len(w))]
    pool = base * 6 + variants
    rows = [(i, " ".join(rng.choice(pool).upper() if rng.random() < 0.1 else rng.choice(pool) for _ in range(80))) for i in range(60)]
    # Nulls, empties, repeated rows, words that a chain of forms joins, and runs of thousands of letters.
    long = "ab" * 4_000
    rows += [(None, "Straße straße STRAßE"), (None, "Straße straße STRAßE"), (61, None), (62, ""), (63, "... 12 --")]
    rows += [(64, " ".join(["chain"] * 30 + ["chains"] * 10 + ["chainss"] * 3)), (65, " ".join([long] * 6 + [long + "c"] * 3)), (66, "x" * 300_000)]
    frame = spark.createDataFrame([(i, t, "w", 1, "k", 2) for i, t in rows], SCHEMA)
    got = result(spelling.variants(frame))
    assert got == expected(rows)
    assert ("chainss", "chains", "chain", 3, 1, 10) in got
    assert sum(r[3] for r in got if len(r[0]) >= 8_000) == 9


def test_empty_table_and_nothing_near(spark):
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).count() == 0
    lone = spark.createDataFrame([(1, "lonely " * 4, "w", 1, "k", 2)], SCHEMA)
    assert result(spelling.variants(lone)) == [("lonely", "", "lonely", 4, 0, None)]


def test_ties_take_the_first_word(spark):
    rows = [(9_999_991, "tesua " * 8 + "tesub " * 8 + "tesuc " * 4)]
    got = {r[0]: r[1] for r in result(spelling.variants(spark.createDataFrame([(i, t, "", 0, "", 0) for i, t in rows], SCHEMA)))}
    assert got == {r[0]: r[1] for r in expected(rows)} and got["tesuc"] == "tesua"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("012345", min_size=1, max_size=6), min_size=2, max_size=12, unique=True))
def test_every_near_pair_of_reduced_words_meets(words):
    raw = [w.encode() for w in words]
    own = spelling.keys(raw).tolist()
    number, key = spelling.neighbours(raw)
    sent = set(zip(number.tolist(), key.tolist()))
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            if one_edit(a, b):
                assert (i, own[j]) in sent or (j, own[i]) in sent

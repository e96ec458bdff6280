"""The classifier's training against a plain loop, and edge rows of the whole operator."""

from __future__ import annotations

import math

import numpy as np
import pytest

from meterlake.llm import classifier

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, label int, h long"


def plain_ftrl(examples, size: int, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> list[float]:
    """Follow-the-regularised-leader updates, one coordinate at a time."""
    z, n = [0.0] * size, [0.0] * size

    def weight(i: int) -> float:
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for terms, values, label in examples:
            own = [weight(t) for t in terms]
            p = 1 / (1 + math.exp(-sum(w * v for w, v in zip(own, values))))
            for t, v, w in zip(terms, values, own):
                g = (p - label) * v
                z[t] += g - (math.sqrt(n[t] + g * g) - math.sqrt(n[t])) / alpha * w
                n[t] += g * g
    return [weight(i) for i in range(size)]


@pytest.mark.parametrize("l1, l2", [(0.00001, 0.00001), (0.3, 0.1)])
def test_ftrl_against_a_plain_loop(l1, l2):
    rng = np.random.default_rng(3)
    examples = []
    for k in range(60):
        terms = np.sort(rng.choice(64, rng.integers(1, 12), replace=False))
        examples.append((terms, rng.random(len(terms)), int(k % 3 == 0)))
    got = classifier.ftrl(examples, 6, 4, 0.7, 1.0, l1, l2)
    want = plain_ftrl([(t.tolist(), v.tolist(), y) for t, v, y in examples], 64, 4, 0.7, 1.0, l1, l2)
    assert got == pytest.approx(want, abs=1e-6) and any(want)


def test_whole_operator_on_edge_rows(spark):
    """Nulls, empty, blank and very long texts, repeated rows, clashing columns; then no labels, then no documents."""
    rows = [(i, ("good clean words here " if i % 2 else "bad bad !!! 123 ") * 5, "en", "a", 1, 0.5, 7, 8) for i in range(80)]
    rows += [(100, None, None, None, None, None, None, None), (101, "", "", "", 0, 0.0, 0, 0), (102, " \t\n", "", "", 0, 0.0, 0, 0)]
    rows += [(103, "word " * 200_000, "", "", 0, 0.0, 0, 0), (None, "good", "", "", 0, 0.0, 0, 0), (None, "good", "", "", 0, 0.0, 0, 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame([(i, i % 2, None, "x") for i in range(80)] + [(None, 1, 0, "x"), (100, None, 0, "x")], "doc_id long, quality int, toxic int, text string")
    weights = classifier.quality_weights(docs, marks)
    out = docs.select("doc_id", classifier.score(docs["text"], weights, spark).alias("s")).collect()
    assert len(out) == len(rows) and all(0 <= r["s"] <= 1 for r in out)
    by_id = {r["doc_id"]: r["s"] for r in out}
    assert min(by_id[i] for i in range(1, 80, 2)) > 0.5 > max(by_id[i] for i in range(0, 80, 2))
    assert by_id[100] == by_id[101] == by_id[102]
    none = classifier.quality_weights(docs, marks.where("false"))
    assert not none.any()
    assert {r["s"] for r in docs.select(classifier.score(docs["text"], none, spark).alias("s")).collect()} == {0.5}
    assert not classifier.quality_weights(docs.where("false"), marks).any()
    assert docs.where("false").select(classifier.score(docs["text"], weights, spark).alias("s")).count() == 0


def test_scores_do_not_depend_on_the_block(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"w{i % 7} and some words {i}" * (1 + i % 5)) for i in range(300)], "doc_id long, text string").coalesce(1)
    weights = np.random.default_rng(0).normal(size=1 << classifier.BITS).astype(np.float32)
    whole = [r["s"] for r in docs.select(classifier.score(docs["text"], weights, spark).alias("s")).collect()]
    monkeypatch.setattr(classifier, "ARRAY_BYTES", 100)
    assert [r["s"] for r in docs.select(classifier.score(docs["text"], weights, spark).alias("s")).collect()] == pytest.approx(whole, abs=1e-12)

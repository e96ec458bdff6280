"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import WHITE, WORD, documents

STOP_WORDS = (
    "the of and to a in is that for it on with as are be this by was or an not from at have "
    "le la les des du et un une en que qui dans pour sur est pas au ce de "
    "der die das und den dem ein eine ist nicht mit zu von im auf für des als auch "
    "el los las y por con para no se del lo una"
).split()
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``least`` <= 1000 * value / per <= ``most``; a bound that is None doesn't count, per 0 fails no rule."""

    name: str
    value: str
    per: str
    least: int | None = None
    most: int | None = None


RULES = (
    Rule("length", "n_words", "one", 10_000, 100_000_000),
    Rule("word_length", "word_chars", "n_words", 2_000, 40_000),
    Rule("symbols", "n_symbols", "n_words", most=300),
    Rule("stop_words", "n_stop_words", "n_words", least=5),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", most=400),
    Rule("line_length", "n_words", "n_lines", most=20_000_000),
)


def compiled(rules: tuple[Rule, ...] = RULES) -> Column:
    """True where a row of :func:`measures` keeps to every rule."""
    tests = []
    for rule in rules:
        value, per = F.col(rule.value) * 1000, F.col(rule.per)
        if rule.least is not None:
            tests.append(value >= per * rule.least)
        if rule.most is not None:
            tests.append(value <= per * rule.most)
    return reduce(Column.__and__, tests, F.lit(True))


def measures(docs: DataFrame, text: str = "text", stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """``doc_id`` and the measures of every row, as longs.

    Null and empty texts measure 0 throughout. n_repeat_words compares 5-word windows by a 64-bit hash
    within one text; only texts that repeat a window sort them.
    """
    plain = F.coalesce(F.col(text), F.lit(""))
    words = docs.select("doc_id", plain.alias("t"), F.regexp_extract_all(plain, F.lit(WORD), F.lit(0)).alias("words"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD))
    windows = F.when(
        F.size("words") > WINDOW,
        F.transform(F.sequence(F.lit(0), F.size("words") - WINDOW), lambda i: F.xxhash64(F.slice("words", i + 1, WINDOW))),
    )
    counted = words.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("t", WHITE, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(stop_words))).cast("long").alias("n_stop_words"),
        lines.alias("lines"), windows.alias("windows"),
    )
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    ordered = counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_stop_words",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(repeats, F.array_sort(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))).alias("windows"),
    )

    def alike(x: Column, i: Column) -> Column:
        before, after = F.get("windows", i - 1).getField("w"), F.get("windows", i + 1).getField("w")
        same = F.coalesce(before == x.getField("w"), F.lit(False)) | F.coalesce(after == x.getField("w"), F.lit(False))
        return F.when(same, x.getField("i"))

    places = ordered.withColumn("windows", F.array_sort(F.array_compact(F.transform("windows", alike))))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate(
        "windows", start,
        lambda at, i: F.struct((i + WINDOW).alias("end"), (at.getField("n") + i + WINDOW - F.greatest(at.getField("end"), i)).alias("n")),
        lambda at: at.getField("n"),
    )
    return places.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).withColumn("one", F.lit(1).cast("long")).drop("windows")


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """:func:`measures` with base_failed and kept: kept rows pass the base and every rule."""
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measures(docs, text).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & compiled(rules))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_stop_words", "n_lines",
    )


def _sql_rules(rules: tuple[Rule, ...] = RULES) -> str:
    tests = []
    for r in rules:
        if r.least is not None:
            tests.append(f"1000 * {r.value} >= {r.least} * {r.per}")
        if r.most is not None:
            tests.append(f"1000 * {r.value} <= {r.most} * {r.per}")
    return " AND ".join(tests)


def op3_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    return rf"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t
), g AS (
  SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS gram FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)
), d AS (
  SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, gram) > 1
), c AS (
  SELECT r, count(DISTINCT i + k) AS n FROM d, range(5) AS k(k) GROUP BY r
), m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(ws, lambda x: lower(x) IN ({stop})))::BIGINT AS n_stop_words, len(ls)::BIGINT AS n_lines, 1 AS one
  FROM w LEFT JOIN c USING (r)
), b AS (
  SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND {_sql_rules()}) AS kept, n_stop_words, n_lines FROM b
"""

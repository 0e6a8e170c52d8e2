"""Keywords inside phrases against a plain search."""

import random
import time

import pytest
from pyspark.sql import functions as F

from guestlens.operators import aspects, matching

DICTIONARY = "priority int, category string, keyword string"


def brute(phrase, rows):
    best = min(((p, c) for p, c, k in rows if k and phrase is not None and k in phrase.lower()), default=None)
    return "OTHER" if best is None else best[1]


def some_words(rng, n, letters="abcd"):
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 7))) for _ in range(n)]


@pytest.mark.parametrize("most", [matching.AUTOMATON_CHARACTERS, 0])
def test_both_ways_equal_a_plain_search(spark, most):
    rng = random.Random(3)
    rows = [(rng.randrange(6), rng.choice("XYZ"), k) for k in some_words(rng, 60, "abcdé ")] + [(0, "N", None), (0, "E", ""), (3, "B", "bc"), (3, "A", "bc")]
    phrases = [" ".join(some_words(rng, rng.randrange(1, 5), "abcdéAB")) for _ in range(400)] + ["", None, "ÉB", "x" * 5000, "bc", "日本"]
    df = spark.createDataFrame([(i, p, "kept") for i, p in enumerate(phrases * 2)], "i int, extracted_aspect string, priority string")
    out = aspects.categorise_by_table(df, spark.createDataFrame(rows, DICTIONARY), most=most)
    assert out.columns == ["i", "extracted_aspect", "priority", "aspect_category"]
    assert sorted((r.i, r.aspect_category) for r in out.collect()) == [(i, brute(p, rows)) for i, p in enumerate(phrases * 2)]


def test_many_keywords(spark):
    """10^5 keywords: every phrase is read once, and its substrings are never rows."""
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    keywords = list({"".join(rng.choice(letters) for _ in range(rng.randrange(4, 12))) for _ in range(110_000)})[:100_000]
    ranks = {k: i % 50 for i, k in enumerate(keywords)}
    phrases = [" ".join("".join(rng.choice(letters) for _ in range(8)) + rng.choice(keywords) for _ in range(5)) for _ in range(300)]
    dictionary = spark.createDataFrame([(p, f"C{p:02}", k) for k, p in ranks.items()], DICTIONARY)
    df = spark.createDataFrame([(p,) for p in phrases], "extracted_aspect string")
    out = aspects.categorise_by_table(df, dictionary)
    assert "Generate explode" not in out._jdf.queryExecution().optimizedPlan().toString().replace("explode(sequence(0", "")

    def plain(phrase):
        pieces = {phrase[i : i + n] for n in range(4, 12) for i in range(len(phrase) - n + 1)}
        return f"C{min(ranks[x] for x in pieces if x in ranks):02}"

    assert sorted((r[0], r[1]) for r in out.collect()) == sorted((p, plain(p)) for p in phrases)


def test_time_is_linear_in_the_text():
    """Nested keywords of falling rank decide alone: a long text of them costs no more than its length."""
    ranks = {"a" * n: n for n in range(1, 2000)}
    automaton = matching.Automaton(ranks)
    assert len(automaton.found) == 1
    start = time.perf_counter()
    assert automaton.best("a" * 1_000_000) == 1 and automaton.best("b") is None
    assert time.perf_counter() - start < 5


def test_empty_tables(spark):
    df = spark.createDataFrame([("bed",), (None,)], "extracted_aspect string")
    none = spark.createDataFrame([], DICTIONARY)
    assert [r.aspect_category for r in aspects.categorise_by_table(df, none).collect()] == ["OTHER", "OTHER"]
    assert aspects.categorise_by_table(df.limit(0), spark.createDataFrame([(1, "C", "bed")], DICTIONARY)).collect() == []


def test_only_the_phrase_is_read(spark, tiny):
    parts = spark.read.parquet(f"{tiny}/part.parquet")
    dictionary = spark.createDataFrame([(1, "C", "red")], DICTIONARY)
    found = aspects.categorise_by_table(parts, dictionary, "p_name").groupBy("aspect_category").agg(F.count(F.lit(1)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<p_name:string>" in plan and "p_retailprice" not in plan

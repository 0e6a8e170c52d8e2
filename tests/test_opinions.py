"""Opinion words learnt from reviews."""

import math
from collections import Counter

import pytest

from guestlens.operators import aspects, opinions

SCHEMA = "source_id string, pos_text string, neg_text string"


@pytest.fixture(scope="module")
def reviews(spark):
    good = ["the staff was splendid and the room airy", "splendid breakfast, airy hall", "the bed was splendid"]
    bad = ["the room was grotty and the bed lumpy", "grotty shower in the room", "lumpy bed, grotty towels"]
    rows = [(str(i), good[i % 3], bad[i % 3]) for i in range(30)] + [("x", None, "grotty"), ("y", "", None)]
    return spark.createDataFrame(rows, SCHEMA)


def test_weights_are_smoothed_log_odds(reviews):
    sides = [Counter(), Counter()]
    for row in reviews.collect():
        for side, text in zip(sides, (row.pos_text, row.neg_text)):
            side.update((text or "").replace(",", "").split())
    kinds = len(set(sides[0]) | set(sides[1]))
    shares = [lambda w, s=s: (s[w] + 0.5) / (sum(s.values()) + 0.5 * kinds) for s in sides]
    found = {r.word: r for r in opinions.opinion_weights(reviews).collect()}
    assert set(found) == {w for w in set(sides[0]) | set(sides[1]) if sides[0][w] + sides[1][w] >= 5}
    for word, row in found.items():
        assert (row.positive, row.negative) == (sides[0][word], sides[1][word])
        assert math.isclose(row.weight, math.log(shares[0](word) / shares[1](word)), abs_tol=1e-9)


def test_extractor_reads_the_learnt_table(spark, reviews):
    weights = opinions.opinion_weights(reviews)
    positive, negative = opinions.opinion_words(weights)
    assert "splendid" in positive and {"grotty", "lumpy"} <= set(negative)
    assert not any("bed" in w or "towel" in w or "shower" in w for w in positive + negative)  # things, not opinions
    (row,) = opinions.extract_learnt(spark.createDataFrame([("1", None, "a grotty bed")], SCHEMA), weights).collect()
    assert (row.aspect, row.sentiment) == (["bed"], ["Negative"])
    (row,) = aspects.extract_phrases(spark.createDataFrame([("1", None, "a grotty bed")], SCHEMA)).collect()
    assert row.sentiment == ["Neutral"]  # the built-in words don't know it


def test_bounds_and_empty_tables(spark, reviews):
    weights = opinions.opinion_weights(reviews, least=1)
    assert all(len(ws) == 1 for ws in opinions.opinion_words(weights, most=1))
    none = opinions.opinion_weights(reviews.limit(0))
    assert none.collect() == [] and opinions.opinion_words(none) == ([], [])
    (row,) = opinions.extract_learnt(spark.createDataFrame([("1", None, "a dirty bed")], SCHEMA), none).collect()
    assert (row.aspect, row.sentiment) == (["bed"], ["Neutral"])

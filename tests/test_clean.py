import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from guestlens.functions import labels, scores, text
from guestlens.operators import clean, dedup, take
from guestlens.schemas import REVIEW


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def review(spark, *rows):
    filled = [{**{f.name: None for f in REVIEW.fields}, **row} for row in rows]
    return spark.createDataFrame([tuple(r[n] for n in REVIEW.names) for r in filled], REVIEW)


def test_parse_score(spark):
    assert column(spark, ["Scored 8.5", "9,2", "", None, "none", "10", "7.", "from 1,234.5"], scores.parse_score) == [
        8.5, 9.2, 0.0, 0.0, 0.0, 10.0, 7.0, 1.234,
    ]


def test_bracketed_count(spark):
    assert column(spark, ["Fair: 5-7 (326)", "Fair: 5-7", None, "()"], scores.bracketed_count) == [326, None, None, None]


def test_review_key_keeps_separators(spark):
    import hashlib

    df = spark.createDataFrame([("Hotel", None, "Nice"), ("Hótel", "Ann", "")], "h string, r string, t string")
    keys = [r[0] for r in df.select(scores.review_key(F.col("h"), F.col("r"), F.col("t"))).collect()]
    assert keys == [hashlib.md5(x.encode()).hexdigest() for x in ("Hotel||Nice", "Hótel|Ann|")]


def test_month_parse(spark):
    values = ["May 2026", "may 2026", "June 2026", "December 2023", "January 2024", "junk", None, "2026-05"]
    months = column(spark, values, scores.stay_month)
    assert months[:2] == [datetime.date(2026, 5, 1)] * 2 and months[5:] == [None, None, None]
    kept = column(spark, values, clean.in_period)
    assert kept == [True, True, False, False, True, False, False, False]


def test_score_bands(spark):
    values = [9.0, 8.9, 7.0, 6.9, 5.0, 3.0, 1.0, 0.9, 10.0, None]
    assert column(spark, values, scores.score_band, "double") == [
        "wonderful_9plus", "good_7to9", "good_7to9", "fair_5to7", "fair_5to7", "poor_3to5", "very_poor_1to3", None,
        "wonderful_9plus", None,
    ]


def test_traveler_labels(spark):
    values = [" Solo Traveller ", "solo traveler", "BUSINESS", " couple\t", "group", None, "pet owner", ""]
    assert column(spark, values, labels.traveler_label) == ["Solo", "Solo", "Business", "Couple"] + ["Group of friends"] * 4


def test_origin(spark):
    assert column(spark, [" POLAND ", "poland", "Germany", None], labels.is_home_country) == ["Poland", "Poland", "Other", "Other"]
    assert column(spark, [" France ", "", None, "  "], scores.country_or_unknown) == ["France"] + ["Unknown"] * 3


def test_translate_keeps_or_drops(spark):
    names = {"a": "A"}
    assert column(spark, ["a", "b", None], lambda c: labels.translate(c, names)) == ["A", "b", None]
    assert column(spark, ["a", "b", None], lambda c: labels.lookup(c, names)) == ["A", None, None]


def test_unicode_strip_and_words(spark):
    values = [" \t too hot  ", "bed was\thard", "", "   ", None, "żółty ręcznik mały"]
    assert column(spark, values, text.word_count) == [2, 3, 0, 0, 0, 3]
    assert column(spark, values[:1], text.strip) == ["too hot"]
    assert column(spark, ["Łóżko, i ręcznik_1!"], text.words) == [["łóżko", "i", "ręcznik_1"]]


def test_min_words_and_commentless(spark):
    df = review(spark, {"neg_text": "too hot"}, {"neg_text": " bed was hard "}, {"pos_text": " ", "neg_text": ""}, {"pos_text": "ok"})
    assert [r["neg_text"] for r in clean.filter_min_words(df).collect()] == ["bed was hard"]
    assert clean.drop_commentless(df).count() == 3


def test_union_stamps_business_and_fills_columns(spark):
    general = review(spark, {"source_id": "a", "traveler_type": "Solo traveller"})
    negative = review(spark, {"source_id": "b"}).drop("title")
    business = review(spark, {"source_id": "a", "traveler_type": "Solo traveller"})
    out = clean.union_passes(general, negative, business)
    assert sorted((r["source_id"], r["traveler_type"]) for r in out.select("source_id", F.coalesce("traveler_type", F.lit("")).alias("traveler_type")).collect()) == [
        ("a", "Business"), ("a", "Solo traveller"), ("b", ""),
    ]
    assert clean.union_passes(general, negative).count() == 2 and "title" in out.columns


def test_filter_period_drops_missing_scores_but_keeps_zero(spark):
    rows = [{"source_id": str(i), "stay_date": "May 2025", "rating_score": s} for i, s in enumerate([8.0, None, float("nan"), 0.0])]
    df = review(spark, *rows)
    assert sorted(r["source_id"] for r in clean.filter_period(df).collect()) == ["0", "3"]
    assert [r["source_id"] for r in clean.filter_period(df, drop_zero=True).collect()] == ["0"]


def test_missing_stars_are_an_error(spark):
    df = review(spark, {"hotel_stars": None})
    with pytest.raises(PySparkException):
        clean.normalise_labels(df).collect()


def test_dedup_content_prefers_business_and_equates_nulls(spark):
    same = {"hotel_name": "H", "stay_date": "May 2025", "rating_score": 7.0, "neg_text": "x"}
    df = review(
        spark,
        {**same, "source_id": "1", "traveler_type": "Solo traveller"},
        {**same, "source_id": "2", "traveler_type": "Business"},
        {**same, "source_id": "3", "traveler_type": None},
        {**same, "source_id": "4", "pos_text": "", "traveler_type": "Couple"},
    )
    assert sorted(r["source_id"] for r in dedup.dedup_content(df).collect()) == ["2", "4"]


def test_dedup_by_key_and_batches(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 2), (None, 1), (None, 2)], "id string, band int")
    out = sorted((r["id"] or "", r["band"]) for r in dedup.dedup_across_batches(df, "id", "band").collect())
    assert out == [("", 1), ("", 2), ("a", 1), ("a", 1), ("b", 2)]
    first = dedup.dedup_by_key(df.where("id IS NOT NULL"), "id", [F.desc("band")]).collect()
    assert sorted((r["id"], r["band"]) for r in first) == [("a", 2), ("b", 2)]


def test_whole_pages(spark):
    df = spark.createDataFrame([("h", i // 10 + 1, i) for i in range(30)] + [("k", 1, 0)], "hotel string, page int, i int")
    assert take.take_whole_pages(df, "hotel", "page", 15).where("hotel = 'h'").count() == 20
    assert take.take_whole_pages(df, "hotel", "page", 10).where("hotel = 'h'").count() == 10
    assert take.take_whole_pages(df, "hotel", "page", 500).count() == 31
    assert take.take_per_group(df, "hotel", [F.asc("i")], 15).count() == 16
    assert take.first_rows(df, [F.desc("i")]).collect()[0]["i"] == 29


def test_small_groups_are_dropped(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 4, "g string")
    assert [r["g"] for r in take.min_group_size(df, "g").collect()] == ["a"] * 5


def test_stage_counts(spark):
    base = {"hotel_name": "H", "stay_date": "May 2025", "rating_score": 7.0}
    df = review(spark, base, base, {**base, "rating_score": None}, {**base, "stay_date": "May 2020"})
    rows = {r["stage"]: r["rows"] for r in clean.stage_counts(df).collect()}
    assert rows == {"loaded": 4, "in_period": 3, "with_score": 2, "distinct_content": 1}

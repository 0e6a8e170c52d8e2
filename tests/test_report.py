"""Published result tables turned into the published report tables, and the market numbers."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from guestlens.functions import display
from guestlens.operators import describe, market, report
from guestlens.schemas import NEGATIVE_BANDS, SCORE_BAND_COLUMNS, TRAVELER_COUNT_COLUMNS
from guestlens.sources import files

DISTRIBUTION = str(Path(__file__).parent / "data" / "distribution.csv")
KINDS = ["Standard Hotelu", "Profil Podróżnego", "Pochodzenie"]
DESCRIPTIVES = [
    ("", "", 6718, 7.128, 8.0, 2.565),
    ("Standard Hotelu", "3", 3709, 7.014, 8.0, 2.644),
    ("Standard Hotelu", "4", 2071, 7.179, 8.0, 2.399),
    ("Standard Hotelu", "5", 938, 7.464, 8.0, 2.573),
    ("Profil Podróżnego", "Business", 1871, 8.24, 9.0, 2.049),
    ("Profil Podróżnego", "Couple", 1944, 6.515, 6.0, 2.607),
    ("Profil Podróżnego", "Family", 1430, 6.68, 6.0, 2.58),
    ("Profil Podróżnego", "Group of friends", 386, 6.202, 6.0, 2.548),
    ("Profil Podróżnego", "Solo", 1087, 7.226, 8.0, 2.621),
    ("Pochodzenie", "Other", 2676, 7.036, 8.0, 2.496),
    ("Pochodzenie", "Poland", 4042, 7.188, 8.0, 2.609),
]
REPORT_1 = [
    ("OGÓŁEM", "Cała próba", 6718, 7.13, 8.0, 2.56),
    ("Standard Hotelu", "3 gwiazdki", 3709, 7.01, 8.0, 2.64),
    ("Standard Hotelu", "4 gwiazdki", 2071, 7.18, 8.0, 2.4),
    ("Standard Hotelu", "5 gwiazdek", 938, 7.46, 8.0, 2.57),
    ("Profil Podróżnego", "Biznes", 1871, 8.24, 9.0, 2.05),
    ("Profil Podróżnego", "Pary", 1944, 6.52, 6.0, 2.61),
    ("Profil Podróżnego", "Rodziny", 1430, 6.68, 6.0, 2.58),
    ("Profil Podróżnego", "Grupy znajomych", 386, 6.2, 6.0, 2.55),
    ("Profil Podróżnego", "Solo", 1087, 7.23, 8.0, 2.62),
    ("Pochodzenie", "Reszta Świata", 2676, 7.04, 8.0, 2.5),
    ("Pochodzenie", "Polska", 4042, 7.19, 8.0, 2.61),
]
DUNN_2 = {
    "Business": (1.0, 0.0, 0.0, 0.0, 0.0),
    "Couple": (0.0, 1.0, 0.7778, 0.0, 0.1654),
    "Family": (0.0, 0.7778, 1.0, 0.0, 0.0067),
    "Solo": (0.0, 0.0, 0.0, 1.0, 0.0),
    "Group of friends": (0.0, 0.1654, 0.0067, 0.0, 1.0),
}
REPORT_3 = {
    "Biznes": ("1.000", "< 0.001", "< 0.001", "< 0.001", "< 0.001"),
    "Pary": ("< 0.001", "1.000", "0.7778", "< 0.001", "0.1654"),
    "Rodziny": ("< 0.001", "0.7778", "1.000", "< 0.001", "0.0067"),
    "Solo": ("< 0.001", "< 0.001", "< 0.001", "1.000", "< 0.001"),
    "Grupy znajomych": ("< 0.001", "0.1654", "0.0067", "< 0.001", "1.000"),
}
ASPECTS = [
    ("Udogodnienia i Pokój", 2234, 850, 129, 3213),
    ("Inne (pominięte)", 1027, 344, 77, 1448),
    ("Komfort i Akustyka", 1027, 146, 80, 1253),
    ("Czystość i Higiena", 825, 206, 26, 1057),
    ("Personel i Obsługa", 665, 86, 62, 813),
    ("Stosunek Jakości do Ceny", 228, 58, 15, 301),
    ("Lokalizacja", 57, 18, 28, 103),
]


def test_descriptive_report(spark):
    rows = spark.createDataFrame(DESCRIPTIVES, "kind string, label string, n long, mean double, median double, std double")
    out = describe.report_rows(rows, KINDS)
    assert sorted(tuple(r)[1:] for r in out.collect()) == sorted(REPORT_1)
    assert [r["kategoria"] for r in out.orderBy("position").select("kategoria").distinct().collect()]


def test_report_drops_unreadable_numbers_and_stars(spark):
    rows = spark.createDataFrame([("Standard Hotelu", "3★", 1, "x", "2.5", None)], "kind string, label string, n long, mean string, median string, std string")
    out = describe.report_rows(rows, KINDS).collect()[0]
    assert (out["podgrupa"], out["srednia"], out["mediana"]) == ("3 gwiazdki", None, 2.5)


def test_segments_partition_the_sample(spark):
    df = spark.createDataFrame([(3, "Solo", 7.0), (4, "Couple", 9.0), (3, "Couple", 8.0)], "stars int, kind string, v double")
    rows = describe.segment_summary(df, "v", {"a": "stars", "b": "kind"}).collect()
    assert {k: sum(r["n"] for r in rows if r["kind"] == k) for k in ("", "a", "b")} == {"": 3, "a": 3, "b": 3}


def test_dunn_report(spark):
    levels = list(DUNN_2)
    rows = [(i, name, *cells) for i, (name, cells) in enumerate(DUNN_2.items(), 1)]
    matrix = spark.createDataFrame(rows, "position int, label string, " + ", ".join(f"`{x}` double" for x in levels))
    out = report.matrix_report(matrix, levels).orderBy("position")
    assert out.columns[2:] == list(REPORT_3)
    assert {r["label"]: tuple(r)[2:] for r in out.collect()} == REPORT_3


def test_dunn_report_of_stars(spark):
    levels = ["3★", "4★", "5★"]
    matrix = spark.createDataFrame(
        [(1, "3★", 1.0, 0.6236, 0.0), (2, "4★", 0.6236, 1.0, 0.0002), (3, "5★", 0.0, 0.0002, 1.0)],
        "position int, label string, `3★` double, `4★` double, `5★` double",
    )
    rows = [tuple(r)[1:] for r in report.matrix_report(matrix, levels).orderBy("position").collect()]
    assert rows == [
        ("3 gwiazdki", "1.000", "0.6236", "< 0.001"),
        ("4 gwiazdki", "0.6236", "1.000", "< 0.001"),
        ("5 gwiazdek", "< 0.001", "< 0.001", "1.000"),
    ]


def test_aspect_report(spark):
    counts = spark.createDataFrame([r[:4] for r in ASPECTS], "category_name string, NEGATIVE long, NEUTRAL long, POSITIVE long")
    assert [tuple(r) for r in report.aspect_report(counts).collect()] == ASPECTS


def test_p_values_rounding_and_annotation(spark):
    df = spark.createDataFrame([("1.0",), ("0.7778",), ("0.0002",), ("0.0",), ("x",), (None,), ("0.99995",)], "p string")
    assert [r[0] for r in df.select(display.p_text(F.col("p"))).collect()] == ["1.000", "0.7778", "< 0.001", "< 0.001", "x", None, "1.000"]
    df = spark.createDataFrame([(2.565,), (6.515,), (1.015,), (-0.125,)], "x double")
    assert [r[0] for r in df.select(display.half_even(F.col("x"), 2)).collect()] == [2.56, 6.52, 1.01, -0.12]
    df = spark.createDataFrame([("Kruskal-Wallis", "H", 26.957, 0.00001), ("Mann-Whitney U", "U", 5678009.0, 0.0004)], "t string, l string, s double, p double")
    notes = [r[0] for r in df.select(display.annotation(F.col("t"), F.col("l"), F.col("s"), F.col("p"))).collect()]
    assert notes == ["Kruskal-Wallis: H = 26,96, p < 0,0001", "Mann-Whitney U: U = 5678009,00, p = 0,0004"]


def test_language_shares(spark):
    df = files.read_distribution(spark, DISTRIBUTION)
    rows = market.language_structure(df).orderBy("position").collect()
    assert [(r["language"], r["reviews"], r["share"]) for r in rows] == [
        ("Polski", 30389, 52.9), ("Angielski", 7860, 13.7), ("Niemiecki", 7176, 12.5), ("Czeski", 2219, 3.9), ("Inne", 9784, 17.0),
    ]


def test_language_counts_read_any_number_and_python_dictionaries(spark):
    texts = ['{"pl": 3.0}', "{'pl': 3, 'en': None}", "{'pl': 3,}", "{'pl': 1, 'de': None , }", '{"pl": 1e2, "cs": NaN}', "{'en': 2, 'None': 4}", "None", "[1]", ""]
    rows = market.language_structure(spark.createDataFrame([(t,) for t in texts], "languages_json string")).collect()
    assert {r["code"]: r["reviews"] for r in rows} == {"pl": 110, "en": 2, "de": 0, "cs": 0, "Inne": 4}


def test_unreadable_language_cells_are_skipped(spark):
    df = spark.createDataFrame([("{'pl': 3, 'xx': 2}",), ("junk",), (None,), ('{"pl": 1}',)], "languages_json string")
    rows = {r["code"]: r["reviews"] for r in market.language_structure(df).collect()}
    assert rows == {"pl": 4, "en": 0, "de": 0, "cs": 0, "Inne": 2}


def test_negative_rates(spark):
    df = files.read_distribution(spark, DISTRIBUTION)
    rates = {r["hotel_stars"]: r["negative_rate"] for r in market.negative_rate_by(df).collect()}
    assert rates == pytest.approx({3: 10.900923, 4: 8.057540, 5: 7.985640}, abs=1e-6)
    pooled = {r["hotel_stars"]: r["negative_rate"] for r in market.negative_rate_by(df, pooled=True).collect()}
    assert pooled == pytest.approx({3: 10.771286, 4: 7.567543, 5: 7.564463}, abs=1e-6)
    zero = spark.createDataFrame([(3, 0, 0), (3, 1, 2)], "hotel_stars int, negative_total long, total long")
    assert market.negative_rate_by(zero).collect()[0]["negative_rate"] == 50.0


def test_distribution_invariants(spark):
    df = files.read_distribution(spark, DISTRIBUTION)
    bands = sum(F.col(c) for c in SCORE_BAND_COLUMNS)
    types = sum(F.col(c) for c in TRAVELER_COUNT_COLUMNS)
    broken = df.where(
        (bands != F.col("total"))
        | (sum(F.col(c) for c in NEGATIVE_BANDS) != F.col("negative_total"))
        | (types != F.col("total") + F.col("type_business_travellers"))
    )
    assert df.count() == 19 and broken.count() == 0
    assert df.agg(F.sum("total"), F.sum("negative_total")).collect()[0] == (57456, 5235)


def test_score_distribution_of_reviews(spark):
    df = spark.createDataFrame(
        [("H", 9.5, "Family", "pl"), ("H", 5.0, "Solo", "en"), ("H", 0.0, "Solo", "pl"), ("K", 2.0, None, None)],
        "hotel_name string, rating_score double, traveler_type string, lang string",
    )
    out = market.score_distribution(df, traveler="traveler_type", traveler_columns={"type_families": "Family"}, language="lang")
    rows = {r["hotel_name"]: r for r in out.collect()}
    assert (rows["H"]["total"], rows["H"]["wonderful_9plus"], rows["H"]["negative_total"], rows["H"]["type_families"]) == (3, 1, 1, 1)
    assert rows["H"]["languages_json"] == '{"en":1,"pl":2}' and rows["K"]["languages_json"] == "{}"
    assert market.filter_bands(df).count() == 2

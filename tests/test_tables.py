"""The whole way from raw passes to the published tables, on invented reviews."""

import numpy as np
import pytest

from guestlens.operators.clean import normalise_labels
from guestlens.plans import reviews, tables
from guestlens.schemas import REVIEW
from guestlens.sources import files
from tests.test_report import DISTRIBUTION

PHRASES = [
    "The shower was dirty and the bed was hard", "Very loud noise from the street at night", "The breakfast was not good at all",
    "Small room and the towels were stained", "The staff was rude at the reception desk",
]
TYPES = ["Solo traveller", "Couple", "Family", "Business", None]


@pytest.fixture(scope="module")
def statistics(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(600):
        stars = int(rng.integers(3, 6))
        kind = TYPES[int(rng.integers(0, 5))]
        score = float(np.clip(rng.integers(1, 11) + (stars - 4) * 2, 1, 10))
        country = "Poland" if rng.random() < 0.5 else "Germany"
        rows.append((f"id{i}", f"Hotel {i % 7}", "May 2025", stars, kind, country, score, "t", None, f"{PHRASES[i % 5]} {i}"))
    raw = spark.createDataFrame(rows, REVIEW)
    return reviews.statistics_table(raw, raw.limit(0)).cache()


def test_statistics_tables(spark, statistics, tmp_path):
    out = tables.statistics_tables(normalise_labels(statistics))
    assert out["descriptive_overall"].columns == ["Statistic", "Value"]
    assert out["descriptive_by_stars"].columns == ["hotel_stars", "N", "Mean", "Median", "Std"]
    assert out["pb1_shapiro"].columns == ["Group", "N", "W statistic", "p-value", "Normal (α=0.05)"]
    assert [r["Group"] for r in out["pb1_shapiro"].collect()] == ["3★", "4★", "5★"]
    main = out["pb1_main_test"].collect()[0]
    assert main.asDict().keys() == {"Research Problem", "Test", "Statistic", "Statistic label", "p-value", "Decision (α=0.05)"}
    assert (main["Test"], main["Decision (α=0.05)"]) == ("Kruskal-Wallis", "Reject H₀ (p < 0.05)")
    assert out["pb1_posthoc_dunn"].columns == ["3★", "4★", "5★"]
    assert [r[i] for i, r in enumerate(out["pb1_posthoc_dunn"].collect())] == [1.0, 1.0, 1.0]
    assert out["report_pb1_dunn"].columns == ["Standard", "3 gwiazdki", "4 gwiazdki", "5 gwiazdek"]
    assert out["report_characteristics"].columns == ["Kategoria", "Podgrupa", "Liczba Opinii", "Średnia", "Mediana", "Odch. Stand."]
    first = out["report_characteristics"].collect()
    assert first[0]["Podgrupa"] == "Cała próba" and len(first) == 1 + 3 + 5 + 2
    assert {r["Liczba Opinii"] for r in first[:1]} == {statistics.count()}
    assert [r["Group"] for r in out["pb3_shapiro"].collect()] == ["Poland", "Other"]
    assert out["pb3_main_test"].collect()[0]["Test"] == "Mann-Whitney U"
    tables.write_tables({"t": out["descriptive_by_origin"]}, str(tmp_path))
    assert spark.read.csv(str(tmp_path / "t"), header=True).columns == ["origin", "N", "Mean", "Median", "Std"]


def test_all_tables_come_from_one_scan(spark, statistics, tmp_path):
    """Only the counts touch the reviews; every table reads the stored counts."""
    normalise_labels(statistics).write.parquet(str(tmp_path / "reviews"))
    df = spark.read.parquet(str(tmp_path / "reviews"))
    out = tables.statistics_tables(df)
    plans = [t._jdf.queryExecution().executedPlan().toString() for t in out.values()]
    assert not any("FileScan" in plan for plan in plans) and all("Scan ExistingRDD" in plan or "LocalTableScan" in plan for plan in plans)


def test_aspect_tables(spark, statistics):
    texts = reviews.aspect_input(statistics)
    out = tables.aspect_tables(reviews.aspect_results(texts), texts)
    assert out["aspect_counts"].columns == ["kategoria_pl", "NEGATIVE", "NEUTRAL", "POSITIVE"]
    top = {(r["aspect_category"], r["bigram"]) for r in out["chart_aspect_bigrams"].collect()}
    assert ("COMFORT", "głośny-hałas") in top
    shares = out["chart_aspect_shares"].collect()
    assert [r["hotel_stars"] for r in shares] == [3, 4, 5]
    assert all(sum(v for k, v in r.asDict().items() if k != "hotel_stars") == pytest.approx(100) for r in shares)
    assert out["report_aspects"].columns[-1] == "Łączna liczba aspektów"


def test_market_tables(spark):
    out = tables.market_tables(files.read_distribution(spark, DISTRIBUTION))
    assert [r["language"] for r in out["chart_languages"].collect()] == ["Polski", "Angielski", "Niemiecki", "Czeski", "Inne"]
    assert [r["hotel_stars"] for r in out["chart_negative_rate"].collect()] == [3, 4, 5]

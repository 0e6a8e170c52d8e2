"""All result, figure and report tables of the analysis, by name and with their published headings."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestlens.functions.display import half_even
from guestlens.functions.labels import ASPECT_KEYWORDS, CATEGORY_NAMES
from guestlens.operators import aspects, describe, market, report
from guestlens.operators import significance as sig
from guestlens.plans.comparison import Comparison, problem_origin, problem_stars, problem_travelers
from guestlens.plans.ranking import score_cube
from guestlens.session import stored
from guestlens.sources.files import write_result

STAR_LABELS = {3: "3★", 4: "4★", 5: "5★"}
SEGMENTS = {"Standard Hotelu": "hotel_stars", "Profil Podróżnego": "traveler_type", "Pochodzenie": "origin"}


def _label(column: Column, labels: dict[Any, str] | None) -> Column:
    if not labels:
        return column.cast("string")
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), column), column.cast("string"))


def descriptive_tables(df: DataFrame, value: str = "rating_score", weight: str | None = None) -> dict[str, DataFrame]:
    """Overall and per segment; ``df`` has normalised labels."""

    def by(group: str) -> DataFrame:
        renamed = {"n": "N", "mean": "Mean", "median": "Median", "std": "Std"}
        return describe.describe_by(df, value, group, weight=weight).withColumnsRenamed(renamed).orderBy(group)

    overall = describe.describe_overall(df, value, weight=weight).orderBy("position")
    return {
        "descriptive_overall": overall.select(F.col("statistic").alias("Statistic"), F.col("value").alias("Value")),
        "descriptive_by_stars": by("hotel_stars"),
        "descriptive_by_traveler": by("traveler_type"),
        "descriptive_by_origin": by("origin"),
        "chart_rating_histogram": describe.histogram(df, value, weight=weight).orderBy("bin"),
    }


def comparison_tables(
    problem: str, out: Comparison, group: str, labels: dict[Any, str] | None = None
) -> dict[str, DataFrame]:
    """Normality, main test and, where it ran, the post-hoc table of one problem."""
    place = sig.level_place(group, out.levels)
    tables = {
        f"{problem}_shapiro": out.normality.orderBy(place).select(
            _label(F.col(group), labels).alias("Group"),
            F.col("n").alias("N"),
            half_even(F.col("w"), 4).alias("W statistic"),
            half_even(F.col("p_value"), 4).alias("p-value"),
            F.col("normal").alias("Normal (α=0.05)"),
        ),
        f"{problem}_main_test": out.main.select(
            F.col("research_problem").alias("Research Problem"),
            F.col("test").alias("Test"),
            F.col("statistic").alias("Statistic"),
            F.col("statistic_label").alias("Statistic label"),
            F.col("p_value").alias("p-value"),
            F.col("decision").alias("Decision (α=0.05)"),
        ),
    }
    if out.posthoc_kind == "dunn":
        matrix = sig.symmetric_matrix(out.posthoc, out.levels).orderBy("position")
        shown = [F.col(f"`{x}`").alias((labels or {}).get(x, str(x))) for x in out.levels]
        tables[f"{problem}_posthoc_dunn"] = matrix.select(*shown)
    elif out.posthoc_kind == "tukey":
        numbers = [half_even(F.col(c), 4).alias(name) for c, name in (("meandiff", "meandiff"), ("p_adj", "p-adj"), ("lower", "lower"), ("upper", "upper"))]
        tables[f"{problem}_posthoc_tukey"] = out.posthoc.orderBy("group1", "group2").select(
            "group1", "group2", *numbers, "reject"
        )
    return tables


def statistics_tables(df: DataFrame, value: str = "rating_score") -> dict[str, DataFrame]:
    """Descriptives, the three problems, their box-plot numbers and the report tables built on them.

    The reviews are read once: counted by all segments and the score, and stored. Every table is computed from these counts.
    """
    cube = stored(score_cube(df, value, list(SEGMENTS.values())))
    counted = (cube, "value")
    stars = problem_stars(*counted, weight="n")
    travelers = problem_travelers(*counted, weight="n")
    origin = problem_origin(*counted, weight="n")
    tables = descriptive_tables(*counted, weight="n")
    tables |= comparison_tables("pb1", stars, "hotel_stars", STAR_LABELS)
    tables |= comparison_tables("pb2", travelers, "traveler_type")
    tables |= comparison_tables("pb3", origin, "origin")
    for name, group, out in (
        ("chart_pb1_boxes", "hotel_stars", stars),
        ("chart_pb2_boxes", "traveler_type", travelers),
        ("chart_pb3_boxes", "origin", origin),
    ):
        box = describe.boxplot(sig.select_levels(cube, group, out.levels), "value", group, weight="n")
        tables[name] = box.orderBy(sig.level_place(group, out.levels))
    headings = {
        "kategoria": "Kategoria",
        "podgrupa": "Podgrupa",
        "liczba_opinii": "Liczba Opinii",
        "srednia": "Średnia",
        "mediana": "Mediana",
        "odch_stand": "Odch. Stand.",
    }
    characteristics = describe.descriptive_report(*counted, SEGMENTS, weight="n").orderBy("position", "podgrupa")
    tables["report_characteristics"] = characteristics.drop("position").withColumnsRenamed(headings)
    for name, heading, out in (("report_pb1_dunn", "Standard", stars), ("report_pb2_dunn", "Profil", travelers)):
        if out.posthoc_kind == "dunn":
            shown = report.matrix_report(sig.symmetric_matrix(out.posthoc, out.levels), out.levels)
            tables[name] = shown.orderBy("position").drop("position").withColumnRenamed("label", heading)
    return tables


def aspect_tables(
    results: DataFrame, texts: DataFrame, order: Sequence[Column] = (), limit: int = 30
) -> dict[str, DataFrame]:
    """Tables of the categorised aspect rows; ``texts`` are the reviews they came from.

    Reviews that share an id are told apart by ``order``; by default the one that the
    content rule would have put first speaks for the id.
    """
    first = [F.asc_nulls_last(c) for c in ("traveler_type", "hotel_name", "neg_text")]
    counts = report.aspect_counts(results)
    negative = aspects.negative_aspects(results)
    names = [CATEGORY_NAMES[c] for c in ASPECT_KEYWORDS]
    bigrams = aspects.aspect_bigrams(negative, texts, order=list(order) or first)
    headings = {
        "kategoria_skargi": "Kategoria Skargi",
        "sentyment_negatywny": "Sentyment Negatywny",
        "sentyment_neutralny": "Sentyment Neutralny",
        "sentyment_pozytywny": "Sentyment Pozytywny",
        "laczna_liczba_aspektow": "Łączna liczba aspektów",
    }
    return {
        "aspect_counts": counts.withColumnRenamed("category_name", "kategoria_pl").orderBy(
            F.desc("NEGATIVE"), "kategoria_pl"
        ),
        "chart_negative_aspects": aspects.ranking(negative, "category_name"),
        "chart_aspect_bigrams": aspects.top_bigrams(bigrams, limit=limit).orderBy("aspect_category", "place"),
        "chart_aspect_shares": aspects.crosstab_share(negative, "hotel_stars", "category_name", names).orderBy(
            "hotel_stars"
        ),
        "report_aspects": report.aspect_report(counts).withColumnsRenamed(headings),
    }


def market_tables(distribution: DataFrame) -> dict[str, DataFrame]:
    return {
        "chart_languages": market.language_structure(distribution).orderBy("position"),
        "chart_negative_rate": market.negative_rate_by(distribution).orderBy("hotel_stars"),
    }


def write_tables(tables: dict[str, DataFrame], folder: str, format: str = "csv") -> None:
    """One folder per table. All are small: a row per group, category, pair or bin."""
    for name, table in tables.items():
        write_result(table, f"{folder}/{name}", format)

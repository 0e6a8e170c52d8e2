"""The decision procedure that links the tests, and the three research problems built on it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestlens.functions.display import ALPHA, decision, half_even
from guestlens.functions.labels import TRAVELER_ORDER
from guestlens.operators import significance as sig
from guestlens.plans.ranking import recount
from guestlens.session import stored

MIN_GROUP = 5


@dataclass(frozen=True)
class Comparison:
    """Result tables of one problem. ``posthoc`` is None where the gate stays shut."""

    levels: tuple[Any, ...]
    all_normal: bool
    normality: DataFrame
    levene: DataFrame
    main: DataFrame
    posthoc: DataFrame | None
    posthoc_kind: str | None


def _main_row(test: DataFrame, problem: str, name: str, label: str, alpha: float, digits: int) -> DataFrame:
    """Result layout. The decision uses the unrounded p, the shown p is rounded."""
    return test.select(
        F.lit(problem).alias("research_problem"),
        F.lit(name).alias("test"),
        half_even(F.col("statistic"), digits).alias("statistic"),
        F.lit(label).alias("statistic_label"),
        half_even(F.col("p_value"), digits).alias("p_value"),
        decision(F.col("p_value"), alpha).alias("decision"),
    )


def all_normal(normality: DataFrame) -> bool:
    """Whether no group is called non-normal; the table has one row per listed level."""
    return normality.where(F.col("normal") == "No").isEmpty()


def main_test(
    df: DataFrame,
    value: str,
    group: str,
    levels: Sequence[Any],
    problem: str,
    normal: bool,
    alpha: float = ALPHA,
    digits: int = 4,
    weight: str | None = None,
) -> DataFrame:
    """One-way ANOVA for normal groups, Kruskal-Wallis otherwise."""
    if normal:
        test = sig.anova_oneway(df, value, group, levels, weight)
        return _main_row(test, problem, "One-Way ANOVA", "F", alpha, digits)
    test = sig.kruskal_wallis(df, value, group, levels, weight)
    return _main_row(test, problem, "Kruskal-Wallis", "H", alpha, digits)


def two_sample_test(
    df: DataFrame,
    value: str,
    group: str,
    levels: Sequence[Any],
    problem: str,
    normal: bool,
    alpha: float = ALPHA,
    digits: int = 4,
    weight: str | None = None,
) -> DataFrame:
    """t-test for normal groups, with Levene choosing the variant; Mann-Whitney otherwise."""
    first, second = levels
    if normal:
        equal = sig.levene(df, value, group, levels, weight).select(F.col("p_value") > alpha).scalar()
        test = sig.ttest_ind(df, value, group, first, second, equal, weight)
        return _main_row(test, problem, "Welch's t-test", "t", alpha, digits)
    test = sig.mann_whitney_u(df, value, group, first, second, weight)
    return _main_row(test, problem, "Mann-Whitney U", "U", alpha, digits)


def gate_open(main: DataFrame, alpha: float = ALPHA) -> bool:
    """Whether post-hoc tests run: taken on the rounded p of the result row, not on the exact one."""
    p = main.first()["p_value"]
    return p is not None and p < alpha


def compare_groups(
    df: DataFrame,
    value: str,
    group: str,
    levels: Sequence[Any],
    problem: str,
    posthoc: bool = True,
    all_groups: bool = False,
    alpha: float = ALPHA,
    digits: int = 4,
    weight: str | None = None,
) -> Comparison:
    """Normality per group, spread, main test, and the post-hoc test where the main one is significant.

    The values are counted once and the counts stored, so the whole procedure reads
    the data a single time. ``weight`` names the count column of a table that is counted already (``score_cube``).
    Two driver decisions are taken, each on a single flag of a stored result table of a few rows. With ``all_groups`` the Tukey comparison
    covers every group that occurs, also those left out of the main test.
    """
    levels = tuple(levels)
    counted = stored(recount(sig.select_levels(df, group, levels), value, [group], weight))
    columns = (counted, "value", group, levels)
    normality = stored(sig.shapiro_wilk(*columns, alpha, weight="n"))
    normal = all_normal(normality)
    spread = sig.levene(*columns, weight="n")
    test = main_test if posthoc else two_sample_test
    main = stored(test(*columns, problem, normal, alpha, digits, weight="n"))
    after, kind = None, None
    if posthoc and gate_open(main, alpha):
        if normal and all_groups:
            after, kind = sig.tukey_hsd(recount(df, value, [group], weight), "value", group, None, alpha, "n"), "tukey"
        elif normal:
            after, kind = sig.tukey_hsd(*columns, alpha, weight="n"), "tukey"
        else:
            after, kind = sig.dunn_posthoc(*columns, weight="n"), "dunn"
    return Comparison(levels, normal, normality, spread, main, after, kind)


def levels_of_size(df: DataFrame, value: str, group: str, levels: Sequence[Any], least: int = MIN_GROUP, weight: str | None = None) -> list[Any]:
    """The listed levels with at least ``least`` values, in listed order."""
    counted = recount(sig.select_levels(df, group, levels), value, [group], weight)  # what the tests count: neither null nor NaN
    sizes = counted.groupBy(group).agg(F.sum("n").alias("n"))
    kept = {row[group] for row in sizes.where(F.col("n") >= least).collect()}  # at most one row per listed level
    return [x for x in levels if x in kept]


def problem_stars(df: DataFrame, value: str = "rating_score", group: str = "hotel_stars", **options: Any) -> Comparison:
    """Problem 1: three, four and five stars. A Tukey comparison covers every star value present."""
    return compare_groups(df, value, group, (3, 4, 5), "PB1", all_groups=True, **options)


def problem_travelers(
    df: DataFrame, value: str = "rating_score", group: str = "traveler_type", levels: Sequence[Any] = TRAVELER_ORDER, **options: Any
) -> Comparison:
    """Problem 2: the traveler types with at least five reviews."""
    return compare_groups(df, value, group, levels_of_size(df, value, group, levels, weight=options.get("weight")), "PB2", **options)


def problem_origin(
    df: DataFrame, value: str = "rating_score", group: str = "origin", levels: Sequence[Any] = ("Poland", "Other"), **options: Any
) -> Comparison:
    """Problem 3: home country against the rest; no post-hoc test."""
    return compare_groups(df, value, group, levels, "PB3", posthoc=False, **options)

"""Descriptive numbers of a score, overall and by segment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestlens.functions.display import half_even
from guestlens.functions.labels import GROUP_NAMES, translate
from guestlens.plans.ranking import moments, quantiles, rank_table, recount, score_cube
from guestlens.plans.skew import lookup_join

# The rows of the overall table, in order.
OVERALL_ROWS = ("N", "Mean", "Median", "Std Dev", "Min", "Max")


def summary(df: DataFrame, value: str, keys: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """n, mean, median, std (n - 1), min and max per key, or of the whole table.

    ``weight`` names the count column of a table whose rows stand for several, here and below. All numbers come from one rank table: the data are scanned once, reduced to
    distinct values before the shuffle, and no task ever holds all values of a group.
    """
    keys = list(keys)
    ranked = rank_table(recount(df, value, keys, weight), keys)
    out = quantiles(ranked, [0.5], ["median"], keys, extra=moments())
    return out.select(*keys, "n", "mean", "median", "std", "min", "max")


def _rounded(columns: Sequence[str], digits: int) -> list[Column]:
    return [half_even(F.col(c), digits).alias(c) for c in columns]


def describe_by(df: DataFrame, value: str, group: str, digits: int = 3, weight: str | None = None) -> DataFrame:
    """One row per group: n, mean, median, std."""
    return summary(df, value, [group], weight).select(group, "n", *_rounded(("mean", "median", "std"), digits))


def describe_wide(df: DataFrame, value: str, digits: int = 3, weight: str | None = None) -> DataFrame:
    """One row: n, mean, median, std, min, max of the whole table."""
    return summary(df, value, (), weight).select("n", *_rounded(("mean", "median", "std", "min", "max"), digits))


def describe_overall(df: DataFrame, value: str, digits: int = 3, weight: str | None = None) -> DataFrame:
    """The same numbers as (position, statistic, value) rows."""
    wide = describe_wide(df, value, digits, weight)
    rows = F.array(
        *(
            F.struct(F.lit(i).alias("position"), F.lit(name).alias("statistic"), F.col(c).cast("double").alias("value"))
            for i, (name, c) in enumerate(zip(OVERALL_ROWS, ("n", "mean", "median", "std", "min", "max")))
        )
    )
    return wide.select(F.inline(rows))


def transpose_overall(rows: DataFrame) -> DataFrame:
    """(statistic, value) rows turned back into one wide row."""
    out = rows.groupBy().pivot("statistic", list(OVERALL_ROWS)).agg(F.first("value"))
    return out.withColumnRenamed("Std Dev", "Std")


def segment_summary(df: DataFrame, value: str, segments: Mapping[str, str], weight: str | None = None) -> DataFrame:
    """Overall numbers and those of every segment: (kind, label, n, mean, median, std).

    ``segments`` maps a kind to its column. Rows are counted by all segments together first; only these counts are
    repeated, once for the whole table and once per kind.
    """
    if weight is None:
        df, value, weight = score_cube(df, value, list(dict.fromkeys(segments.values()))), "value", "n"
    pairs = [F.struct(F.lit("").alias("kind"), F.lit("").alias("label"))]
    pairs += [F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("label")) for kind, c in segments.items()]
    long = df.select(F.col(value), F.col(weight), F.inline(F.array(*pairs)))
    return summary(long, value, ["kind", "label"], weight)


def descriptive_report(
    df: DataFrame,
    value: str,
    segments: Mapping[str, str],
    overall: tuple[str, str] = ("OGÓŁEM", "Cała próba"),
    names: Mapping[str, str] = GROUP_NAMES,
    digits: int = 2,
    source_digits: int | None = 3,
    weight: str | None = None,
) -> DataFrame:
    """The consolidated table of the whole sample and all segments, translated and rounded.

    The published table is rounded twice: its sources to ``source_digits``, then the
    report to ``digits``. ``None`` skips the first step.
    """
    rows = segment_summary(df, value, segments, weight)
    return report_rows(rows, list(segments), overall, names, digits, source_digits)


def report_rows(
    rows: DataFrame,
    kinds: Sequence[str],
    overall: tuple[str, str] = ("OGÓŁEM", "Cała próba"),
    names: Mapping[str, str] = GROUP_NAMES,
    digits: int = 2,
    source_digits: int | None = 3,
) -> DataFrame:
    """Report layout of (kind, label, n, mean, median, std) rows; ``position`` gives the order of kinds."""
    whole = F.col("kind") == ""
    position = F.when(whole, F.lit(0))
    for i, kind in enumerate(kinds, 1):
        position = position.when(F.col("kind") == kind, F.lit(i))

    def shown(c: str) -> Column:
        number = F.col(c).cast("string").try_cast("double")
        return half_even(number if source_digits is None else half_even(number, source_digits), digits)

    label = translate(F.replace(F.col("label"), F.lit("★"), F.lit("")), names)
    return rows.select(
        position.alias("position"),
        F.when(whole, F.lit(overall[0])).otherwise(F.col("kind")).alias("kategoria"),
        F.when(whole, F.lit(overall[1])).otherwise(label).alias("podgrupa"),
        F.col("n").alias("liczba_opinii"),
        shown("mean").alias("srednia"),
        shown("median").alias("mediana"),
        shown("std").alias("odch_stand"),
    )


def histogram(df: DataFrame, value: str, bins: int = 20, weight: str | None = None) -> DataFrame:
    """Equal-width counts over [min, max], the top edge in the last bin, empty bins as 0.

    Also carries the mean. Rows are counted per distinct value once; the edges and the bins come
    from these counts.
    """
    values = recount(df, value, (), weight)
    low, high = F.col("low"), F.col("high")
    flat = low == high  # a range of width zero is widened by a half on both sides
    edges = (
        values.agg(F.min("value").alias("low"), F.max("value").alias("high"), (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"))
        .select(
            F.struct(
                F.when(flat, low - 0.5).otherwise(low).alias("start"),
                (F.when(flat, F.lit(1.0)).otherwise(high - low) / bins).alias("width"),
                "mean",
            )
        )
        .scalar()
    )
    start, width, number, guess = F.col("edges.start"), F.col("edges.width"), F.col("value"), F.col("guess")
    first = F.greatest(F.lit(0), F.least(F.floor((number - start) / width), F.lit(bins - 1))).cast("int")
    # the division may miss an edge by one unit in the last place; the edges decide
    place = (
        F.when(number < start + guess * width, guess - 1)
        .when((number >= start + (guess + 1) * width) & (guess < bins - 1), guess + 1)
        .otherwise(guess)
    )
    counts = (
        values.withColumn("edges", edges)
        .withColumn("guess", first)
        .groupBy(place.alias("bin"))
        .agg(F.sum("n").alias("rows"))
    )
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).withColumn("edges", edges)
    return frame.join(counts, "bin", "left").select(
        "bin",
        (start + F.col("bin") * width).alias("lower"),
        (start + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("rows", F.lit(0).cast("long")).alias("rows"),
        F.col("edges.mean").alias("mean"),
    )


def boxplot(df: DataFrame, value: str, group: str, reach: float = 1.5, weight: str | None = None) -> DataFrame:
    """Box numbers per group: quartiles, whiskers at the last datum within reach, outliers beyond."""
    counted = recount(df, value, [group], weight)
    distinct = F.count(F.lit(1)).alias("distinct_values")
    box = quantiles(rank_table(counted, [group]), [0.25, 0.5, 0.75], ["q1", "median", "q3"], [group], [distinct])
    spread = (F.col("q3") - F.col("q1")) * reach
    inside = F.col("value").between(F.col("q1") - spread, F.col("q3") + spread)
    # only counted values meet the box of their group again
    joined = lookup_join(counted, box, [group], "distinct_values", how="inner")
    return joined.groupBy(group).agg(
        F.max("total").alias("n"),
        F.max("q1").alias("q1"),
        F.max("median").alias("median"),
        F.max("q3").alias("q3"),
        F.least(F.min(F.when(inside & (F.col("value") <= F.col("q1")), F.col("value"))), F.max("q1")).alias("whisker_low"),
        F.greatest(F.max(F.when(inside & (F.col("value") >= F.col("q3")), F.col("value"))), F.max("q3")).alias(
            "whisker_high"
        ),
        F.sum(F.when(inside, F.lit(0)).otherwise(F.col("n"))).alias("outliers"),
    )

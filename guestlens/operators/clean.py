"""Union of the collection passes and the filters common to all later work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestlens.functions.labels import is_home_country, traveler_label
from guestlens.functions.scores import stay_month
from guestlens.functions.text import has_words, none_if_blank, strip

# The observed months, both ends included.
FIRST_DAY = "2024-01-01"
LAST_DAY = "2026-05-31"
MIN_WORDS = 3
CONTENT_KEYS = ("hotel_name", "stay_date", "rating_score", "pos_text", "neg_text")


def union_passes(general: DataFrame, negative: DataFrame, business: DataFrame | None = None) -> DataFrame:
    """All passes by column name, repeats kept; the optional third one is stamped "Business"."""
    out = general.unionByName(negative, allowMissingColumns=True)
    if business is None:
        return out
    return out.unionByName(business.withColumn("traveler_type", F.lit("Business")), allowMissingColumns=True)


def business_only(df: DataFrame, column: str = "traveler_type") -> DataFrame:
    """Rows whose traveler type reads "business" in any case, with blanks around it or not."""
    return df.where(F.lower(strip(F.col(column))) == "business")


def text_stage_counts(df: DataFrame, text: str = "neg_text", language: Column | None = None, code: str = "en", least: int = MIN_WORDS) -> DataFrame:
    """Rows left after each stage of the text branch, as (position, stage, rows), in one pass.

    ``language`` is the language of the text (``language_of``); undetectable texts count as ``code``.
    """
    filled = none_if_blank(F.col(text)).isNotNull()
    long = filled & has_words(F.col(text), least)
    known = F.lit(True) if language is None else F.coalesce(language == code, F.lit(True))
    stages = {"loaded": F.lit(True), "with_text": filled, "enough_words": long, "in_language": long & known}
    row = df.agg(*(F.count_if(F.coalesce(kept, F.lit(False))).alias(name) for name, kept in stages.items()))
    pairs = (F.struct(F.lit(i).alias("position"), F.lit(s).alias("stage"), F.col(s).alias("rows")) for i, s in enumerate(stages))
    return row.select(F.inline(F.array(*pairs)))


def in_period(text: Column, first: str = FIRST_DAY, last: str = LAST_DAY) -> Column:
    """Whether a written month lies in the period; a month that cannot be read does not."""
    return F.coalesce(stay_month(text).between(F.lit(first).cast("date"), F.lit(last).cast("date")), F.lit(False))


def has_score(score: Column, drop_zero: bool = False) -> Column:
    """Whether a score is present. 0.0 marks a label without a number and is kept unless asked."""
    present = score.isNotNull() & ~F.isnan(score)
    return present & (score != 0.0) if drop_zero else present


def filter_period(
    df: DataFrame,
    date: str = "stay_date",
    score: str = "rating_score",
    first: str = FIRST_DAY,
    last: str = LAST_DAY,
    drop_zero: bool = False,
) -> DataFrame:
    """Rows with a readable month of the period and a score. Stays a narrow filter at the scan."""
    return df.where(in_period(F.col(date), first, last) & has_score(F.col(score), drop_zero))


def filter_min_words(df: DataFrame, text: str = "neg_text", least: int = MIN_WORDS) -> DataFrame:
    """Rows whose stripped text has at least ``least`` words; the text comes out stripped."""
    return df.where(has_words(F.col(text), least)).withColumn(text, strip(F.col(text)))


def drop_commentless(df: DataFrame, texts: Sequence[str] = ("pos_text", "neg_text")) -> DataFrame:
    """Rows with at least one text that is not empty."""
    return df.where(F.coalesce(*(none_if_blank(F.col(t)) for t in texts)).isNotNull())


def normalise_labels(df: DataFrame) -> DataFrame:
    """Traveler label, home/rest origin and whole stars, as the statistics expect them."""
    return (
        df.withColumn("traveler_type", traveler_label(F.col("traveler_type")))
        .withColumn("origin", is_home_country(F.col("reviewer_country")))
        .withColumn("hotel_stars", require_int(F.col("hotel_stars")))
    )


def require_int(number: Column) -> Column:
    """Whole number; a missing one is an error, not a silent null."""
    return F.when(number.isNull(), F.raise_error(F.lit("a whole number is missing"))).otherwise(number.cast("int"))


def stage_counts(
    df: DataFrame,
    date: str = "stay_date",
    score: str = "rating_score",
    keys: Sequence[str] = CONTENT_KEYS,
    first: str = FIRST_DAY,
    last: str = LAST_DAY,
) -> DataFrame:
    """Rows left after each cleaning stage, as (position, stage, rows), in one pass over the data.

    The number left after dropping repeats is a distinct count of the content key,
    which Spark reduces before its shuffle like any other aggregate.
    """
    dated = in_period(F.col(date), first, last)
    scored = dated & has_score(F.col(score))
    row = df.agg(
        F.count(F.lit(1)).alias("loaded"),
        F.count_if(dated).alias("in_period"),
        F.count_if(scored).alias("with_score"),
        F.count_distinct(F.when(scored, F.struct(*keys))).alias("distinct_content"),
    )
    stages = ("loaded", "in_period", "with_score", "distinct_content")
    pairs = F.array(
        *(F.struct(F.lit(i).alias("position"), F.lit(s).alias("stage"), F.col(s).alias("rows")) for i, s in enumerate(stages))
    )
    return row.select(F.inline(pairs))

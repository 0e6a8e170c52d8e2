"""Structure of the review population: languages, negative rates, score bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guestlens.functions.labels import LANGUAGE_NAMES, REST_LANGUAGES, SHOWN_LANGUAGES, translate
from guestlens.functions.scores import SCORE_BANDS, score_band
from guestlens.schemas import NEGATIVE_BANDS, SCORE_BAND_COLUMNS, TRAVELER_COUNT_COLUMNS


#: ``None`` where a value stands, and a comma after the last entry.
_NONE = r"(?<=:\s{0,20})None(?=\s*[,}])"
_LAST_COMMA = r",\s*}\s*$"


def language_counts(text: Column) -> Column:
    """JSON object of counts as a map of doubles; null where it cannot be read.

    Any JSON number counts. Written as a Python dictionary it is read too: single quotes, ``None`` and a comma after
    the last entry. A missing count stays in the map as null.
    """
    plain = F.regexp_replace(F.regexp_replace(text, _NONE, "null"), _LAST_COMMA, "}")
    kind = "map<string,double>"
    return F.coalesce(F.from_json(text, kind), F.from_json(plain, kind))


def language_structure(
    df: DataFrame,
    languages: str = "languages_json",
    shown: Sequence[str] = SHOWN_LANGUAGES,
    rest: str = REST_LANGUAGES,
    names: Mapping[str, str] = LANGUAGE_NAMES,
    digits: int = 1,
) -> DataFrame:
    """Reviews per shown language, 0 where absent, and the rest, with shares.

    ``position`` orders by count, the rest always last. The window sees one row per
    shown language and one for the rest. Sums are rounded to whole reviews.
    """
    pairs = df.select(F.explode(language_counts(F.col(languages))).alias("code", "reviews"))
    code = F.when(F.col("code").isin(*shown), F.col("code")).otherwise(F.lit(rest))
    known = F.nanvl("reviews", F.lit(None).cast("double"))
    counted = pairs.groupBy(code.alias("code")).agg(F.round(F.sum(known)).cast("long").alias("reviews"))
    wanted = df.sparkSession.createDataFrame([(c,) for c in (*shown, rest)], "code string")
    filled = wanted.join(counted, "code", "left").select(
        "code", F.coalesce("reviews", F.lit(0).cast("long")).alias("reviews"), (F.col("code") == rest).alias("is_rest")
    )
    one = Window.partitionBy(F.lit(1))
    order = one.orderBy("is_rest", F.desc("reviews"), "code")
    share = F.try_divide(F.col("reviews") * 100.0, F.sum("reviews").over(one))
    return filled.select(
        F.row_number().over(order).alias("position"),
        "code",
        translate(F.col("code"), names).alias("language"),
        "reviews",
        F.round(share, digits).alias("share"),
    )


def negative_rate(part: Column, total: Column) -> Column:
    """Percentage; null where the total is 0."""
    return F.try_divide(part.cast("double"), total.cast("double")) * 100.0


def negative_rate_by(
    df: DataFrame,
    group: str = "hotel_stars",
    part: str = "negative_total",
    total: str = "total",
    pooled: bool = False,
    digits: int | None = None,
) -> DataFrame:
    """Mean of the hotels' own rates per group, or the rate of the pooled reviews."""
    if pooled:
        rate = negative_rate(F.sum(part), F.sum(total))
    else:
        rate = F.avg(negative_rate(F.col(part), F.col(total)))
    return df.groupBy(group).agg((rate if digits is None else F.round(rate, digits)).alias("negative_rate"))


def filter_bands(
    df: DataFrame, score: str = "rating_score", keep: Sequence[str] = NEGATIVE_BANDS, column: str = "band"
) -> DataFrame:
    """Rows of the named score bands with their band; an empty band simply yields no rows."""
    bands = [b for b in SCORE_BANDS if b[0] in keep]
    low, high = min(b[1] for b in bands), max(b[2] for b in bands)
    # the plain range reaches the scan; the band itself is a CASE that cannot
    in_range = (F.col(score) >= low) if high == float("inf") else (F.col(score) >= low) & (F.col(score) < high)
    return df.where(in_range).withColumn(column, score_band(F.col(score), bands)).where(F.col(column).isNotNull())


def score_distribution(
    df: DataFrame,
    hotel: str = "hotel_name",
    score: str = "rating_score",
    traveler: str | None = None,
    traveler_columns: Mapping[str, str] | None = None,
    language: str | None = None,
) -> DataFrame:
    """Per hotel: total, reviews per score band, negative total, per traveler type, languages as JSON.

    Counts are first reduced per (hotel, language), then per hotel, so a hotel with
    a third of all rows reaches one task only as a few partial counts per language.
    """
    band = score_band(F.col(score))
    sums = ["total", *SCORE_BAND_COLUMNS]
    aggregates = [F.count(F.lit(1)).alias("total")]
    aggregates += [F.count_if(F.coalesce(band == name, F.lit(False))).alias(name) for name in SCORE_BAND_COLUMNS]
    for column, label in (traveler_columns or {}).items():
        aggregates.append(F.count_if(F.coalesce(F.col(traveler) == label, F.lit(False))).alias(column))
        sums.append(column)
    code = F.col(language) if language else F.lit(None).cast("string")
    fine = df.groupBy(hotel, code.alias("__code")).agg(*aggregates)
    languages = F.map_from_entries(
        F.array_sort(
            F.collect_list(F.when(F.col("__code").isNotNull(), F.struct(F.col("__code"), F.col("total").alias("__n"))))
        )
    )
    wide = fine.groupBy(hotel).agg(
        *(F.sum(c).alias(c) for c in sums if c != "total"), F.sum("total").alias("total"), languages.alias("languages")
    )
    return distribution_rows(wide, hotel=hotel, languages="languages", travelers=list(traveler_columns or {}))


def distribution_rows(
    df: DataFrame,
    hotel: str = "hotel_name",
    languages: str = "languages",
    travelers: Sequence[str] = TRAVELER_COUNT_COLUMNS,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Rows of the distribution table: absent or missing counts are 0, languages become JSON text."""

    def count(name: str) -> Column:
        if name not in df.columns:
            return F.lit(0).cast("long").alias(name)
        return F.coalesce(F.col(name).cast("long"), F.lit(0).cast("long")).alias(name)

    bands = [count(name) for name in SCORE_BAND_COLUMNS]
    out = df.select(
        hotel, *extra, count("total"), *bands, *(count(t) for t in travelers), F.col(languages).alias("__languages")
    )
    negative = F.col(NEGATIVE_BANDS[0])
    for name in NEGATIVE_BANDS[1:]:
        negative = negative + F.col(name)
    return out.select(
        hotel,
        *extra,
        "total",
        *SCORE_BAND_COLUMNS,
        negative.alias("negative_total"),
        *travelers,
        F.coalesce(F.to_json("__languages"), F.lit("{}")).alias("languages_json"),
    )

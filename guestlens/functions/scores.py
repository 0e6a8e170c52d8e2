"""Scores, bands, dates and keys of a review."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from guestlens.functions.text import none_if_blank

# Score bands as (name, lower edge, upper edge). A band owns its lower edge.
SCORE_BANDS = (
    ("wonderful_9plus", 9.0, float("inf")),
    ("good_7to9", 7.0, 9.0),
    ("fair_5to7", 5.0, 7.0),
    ("poor_3to5", 3.0, 5.0),
    ("very_poor_1to3", 1.0, 3.0),
)


def parse_score(text: Column) -> Column:
    """First number of a label such as "Scored 8.5" or "9,2"; 0.0 where there is none."""
    number = F.regexp_extract(F.replace(text, F.lit(","), F.lit(".")), r"[0-9]+(\.[0-9]+)?", 0)
    return F.coalesce(F.nullif(number, F.lit("")).try_cast("double"), F.lit(0.0))


def bracketed_count(text: Column) -> Column:
    """The number in brackets of a label such as "Fair: 5-7 (326)"; null where there is none."""
    return F.nullif(F.regexp_extract(text, r"\(([0-9]+)\)", 1), F.lit("")).try_cast("bigint")


def review_key(hotel: Column, reviewer: Column, title: Column) -> Column:
    """Content key of a review. Missing parts count as empty so that the separators stay."""
    return F.md5(F.concat_ws("|", *(F.coalesce(part, F.lit("")) for part in (hotel, reviewer, title))))


def stay_month(text: Column) -> Column:
    """First day of a month written like "November 2024"; null where it is not one."""
    return F.try_to_timestamp(F.concat(F.lit("1 "), text), F.lit("d MMMM yyyy")).cast("date")


def country_or_unknown(text: Column) -> Column:
    return F.coalesce(none_if_blank(text), F.lit("Unknown"))


def score_band(score: Column, bands: Sequence[tuple[str, float, float]] = SCORE_BANDS) -> Column:
    """Name of the half-open band ``[low, high)`` that holds the score; null outside all."""
    out = None
    for name, low, high in bands:
        cond = score >= F.lit(low)
        if high != float("inf"):
            cond = cond & (score < F.lit(high))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out

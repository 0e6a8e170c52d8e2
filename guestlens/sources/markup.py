"""Review cards, filter options and hotel names from stored page markup.

Fetching pages is out of scope; these jobs read pages that are already in a table.
Menus and names are built-in string expressions on the page's own row; cards, whose
elements nest, are read by a small parser in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guestlens.functions.scores import bracketed_count, country_or_unknown, parse_score, review_key
from guestlens.functions.text import none_if_blank, strip, unescape_html
from guestlens.operators.clean import drop_commentless
from guestlens.schemas import REVIEW, SCORE_BAND_COLUMNS, TRAVELER_COUNT_COLUMNS
from guestlens.sources.cards import read_cards

# Element names of a review page and the column each one fills.
CARD_NAME = "review-card"
CARD_FIELDS = {
    "title": "review-title",
    "pos_text": "review-positive-text",
    "neg_text": "review-negative-text",
    "author": "review-author-name",
    "score_text": "review-score",
    "stay_date": "review-stay-date",
    "traveler_type": "review-traveler-type",
}

# Fixed value: part of the address of a country's flag.
FLAG_ADDRESS = "flags"

# The filter menus and the option values of the score menu.
SCORE_MENU, TRAVELER_MENU, LANGUAGE_MENU = "scoreRange", "customerType", "languages"
SCORE_OPTIONS = {
    "ALL": "total",
    "REVIEW_ADJ_SUPERB": "wonderful_9plus",
    "REVIEW_ADJ_GOOD": "good_7to9",
    "REVIEW_ADJ_AVERAGE_PASSABLE": "fair_5to7",
    "REVIEW_ADJ_POOR": "poor_3to5",
    "REVIEW_ADJ_VERY_POOR": "very_poor_1to3",
}
ALL_TRAVELERS, ALL_LANGUAGES = "ALL", "0"
NAME_PREFIX = "Guest reviews for "


def split_blocks(pages: DataFrame, html: str, opening: str, carry: list[str], column: str = "block") -> DataFrame:
    """One row per block: from one opening tag (a pattern) up to the next."""
    parts = F.split(F.col(html), f"(?={opening})")
    blocks = F.filter(parts, lambda b: F.regexp_like(b, F.lit(f"^(?:{opening})")))
    return pages.select(*carry, F.posexplode(blocks).alias("place", column))


def extract_fields(blocks: DataFrame, fields: Mapping[str, str], carry: list[str], column: str = "block") -> DataFrame:
    """First group of each pattern as a column of visible text."""
    return blocks.select(
        *carry, *(unescape_html(F.regexp_extract(F.col(column), pattern, 1)).alias(name) for name, pattern in fields.items())
    )


def extract_cards(pages: DataFrame, html: str = "html", hotel: str = "hotel_name") -> DataFrame:
    """Reviews of stored review pages, one row per card with a comment, in the review schema.

    Stars are stamped by the caller and are 0 here, as is a score that cannot be read.
    """
    names = [*CARD_FIELDS, "country_text"]

    @F.pandas_udf(T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in names])))
    def cards(source: pd.Series) -> pd.Series:
        found = (read_cards(page, CARD_NAME, CARD_FIELDS, FLAG_ADDRESS) if page else () for page in source)
        return pd.Series([[{c: card.get(c, "") for c in names} for card in page] for page in found], index=source.index, dtype="object")

    raw = pages.select(hotel, F.inline(cards(F.col(html))))
    rows = drop_commentless(raw).select(
        review_key(F.col(hotel), F.col("author"), F.col("title")).alias("source_id"),
        F.col(hotel).alias("hotel_name"),
        "stay_date",
        F.lit(0).alias("hotel_stars"),
        "traveler_type",
        country_or_unknown(F.col("country_text")).alias("reviewer_country"),
        parse_score(F.col("score_text")).alias("rating_score"),
        "title",
        "pos_text",
        "neg_text",
    )
    return rows.select(*REVIEW.names)


def menu_options(pages: DataFrame, menu: str, html: str = "html", carry: list[str] | None = None) -> DataFrame:
    """Options of a menu that show a count: (carried columns, value, reviews)."""
    body = F.regexp_extract(F.col(html), rf'(?s)<select\b[^>]*\bdata-testid="{menu}"[^>]*>(.*?)</select\s*>', 1)
    option = r'(?s)<option\b[^>]*\bvalue="([^"]*)"[^>]*>(.*?)</option\s*>'
    found = pages.withColumn("__menu", body).select(
        *(carry or []),
        F.explode(
            F.arrays_zip(
                F.regexp_extract_all("__menu", F.lit(option), F.lit(1)).alias("value"),
                F.regexp_extract_all("__menu", F.lit(option), F.lit(2)).alias("label"),
            )
        ).alias("option"),
    )
    return found.select(
        *(carry or []), F.col("option.value").alias("value"), bracketed_count(F.col("option.label")).alias("reviews")
    ).where(F.col("reviews").isNotNull() & (F.col("value") != ""))


def _menu_map(html: Column, menu: str, skip: str) -> Column:
    """The same options as a map inside the page's row; the last of equal values counts."""
    body = F.regexp_extract(html, rf'(?s)<select\b[^>]*\bdata-testid="{menu}"[^>]*>(.*?)</select\s*>', 1)
    option = r'(?s)<option\b[^>]*\bvalue="([^"]*)"[^>]*>(.*?)</option\s*>'
    pairs = F.zip_with(
        F.regexp_extract_all(body, F.lit(option), F.lit(1)),
        F.regexp_extract_all(body, F.lit(option), F.lit(2)),
        lambda value, label: F.struct(value.alias("value"), bracketed_count(label).alias("reviews")),
    )
    kept = F.filter(pairs, lambda o: (o["value"] != "") & (o["value"] != skip) & o["reviews"].isNotNull())
    last = F.filter(kept, lambda o, i: ~F.exists(F.slice(kept, i + 2, F.size(kept)), lambda later: later["value"] == o["value"]))
    return F.map_from_entries(last)


def extract_counts(pages: DataFrame, html: str = "html", carry: list[str] | None = None) -> DataFrame:
    """Counts shown in the filter menus of each page: score bands, ``type_*`` and a language map.

    A count that the page does not show is null; ``market.distribution_rows`` turns it into 0.
    """
    scores = pages.withColumn("__scores", _menu_map(F.col(html), SCORE_MENU, "")).withColumn(
        "__types", _menu_map(F.col(html), TRAVELER_MENU, ALL_TRAVELERS)
    )
    by_column = {column: value for value, column in SCORE_OPTIONS.items()}
    return scores.select(
        *(carry or []),
        *(F.col("__scores")[by_column[c]].alias(c) for c in ("total", *SCORE_BAND_COLUMNS)),
        *(F.col("__types")[c.removeprefix("type_").upper()].alias(c) for c in TRAVELER_COUNT_COLUMNS),
        _menu_map(F.col(html), LANGUAGE_MENU, ALL_LANGUAGES).alias("languages"),
    )


def hotel_name(html: Column) -> Column:
    """Name in the review heading; else the page title up to its first comma, or first bar."""
    # all second-level headings in order, the first one with the phrase counts
    headings = F.transform(F.regexp_extract_all(html, F.lit(r"(?s)<h2\b[^>]*>(.*?)</h2\s*>"), F.lit(1)), unescape_html)
    phrase = NAME_PREFIX.strip().lower()
    heading = F.get(F.filter(headings, lambda h: F.contains(F.lower(h), F.lit(phrase))), F.lit(0))
    title = unescape_html(F.regexp_extract(html, r"(?s)<title\b[^>]*>(.*?)</title\s*>", 1))
    named = none_if_blank(F.replace(heading, F.lit(NAME_PREFIX), F.lit("")))
    return F.coalesce(named, strip(title_part(title)))


def title_part(title: Column) -> Column:
    return F.when(F.contains(title, F.lit(",")), F.substring_index(title, ",", 1)).otherwise(
        F.substring_index(title, "|", 1)
    )

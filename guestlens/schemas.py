"""Explicit schemas of every table; nothing is inferred from text."""

from __future__ import annotations

from pyspark.sql import types as T

REVIEW = T.StructType(
    [
        T.StructField("source_id", T.StringType()),
        T.StructField("hotel_name", T.StringType()),
        T.StructField("stay_date", T.StringType()),
        T.StructField("hotel_stars", T.IntegerType()),
        T.StructField("traveler_type", T.StringType()),
        T.StructField("reviewer_country", T.StringType()),
        T.StructField("rating_score", T.DoubleType()),
        T.StructField("title", T.StringType()),
        T.StructField("pos_text", T.StringType()),
        T.StructField("neg_text", T.StringType()),
    ]
)

# The order of the count columns of the distribution table.
SCORE_BAND_COLUMNS = ("wonderful_9plus", "good_7to9", "fair_5to7", "poor_3to5", "very_poor_1to3")
NEGATIVE_BANDS = ("fair_5to7", "poor_3to5", "very_poor_1to3")
TRAVELER_COUNT_COLUMNS = (
    "type_families",
    "type_couples",
    "type_group_of_friends",
    "type_solo_travellers",
    "type_business_travellers",
)

DISTRIBUTION = T.StructType(
    [T.StructField("hotel_name", T.StringType()), T.StructField("hotel_stars", T.IntegerType())]
    + [
        T.StructField(name, T.LongType())
        for name in ("total", *SCORE_BAND_COLUMNS, "negative_total", *TRAVELER_COUNT_COLUMNS)
    ]
    + [T.StructField("languages_json", T.StringType())]
)

ASPECT = T.StructType(
    [
        T.StructField("source_id", T.StringType()),
        T.StructField("hotel_stars", T.IntegerType()),
        T.StructField("traveler_type", T.StringType()),
        T.StructField("extracted_aspect", T.StringType()),
        T.StructField("sentiment", T.StringType()),
    ]
)

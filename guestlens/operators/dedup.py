"""Keep-first rules. Each keeps whole rows under an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guestlens.operators.clean import CONTENT_KEYS
from guestlens.plans.skew import lookup_join


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key under ``order``; null keys equal each other.

    The rank filter lets Spark cut each key to one row per task before the shuffle,
    so many copies of one key never meet in one task. The hash in front of the keys
    makes the sort compare one number instead of long texts; the keys behind it keep
    the result exact.
    """
    window = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*order)
    return df.withColumn("__place", F.row_number().over(window)).where(F.col("__place") == 1).drop("__place")


def first_by_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """``keep_first`` for one short key, left partitioned by that key: a join on it needs no further shuffle."""
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("__place", F.row_number().over(window)).where(F.col("__place") == 1).drop("__place")


def dedup_content(df: DataFrame, keys: Sequence[str] = CONTENT_KEYS, id_column: str = "source_id", ties: Sequence[Column] = ()) -> DataFrame:
    """One review per content. Sorting by traveler type lets "Business" win; missing types come last, ``ties`` decide among equals."""
    return keep_first(df, keys, [F.asc_nulls_last("traveler_type"), F.asc_nulls_last(id_column), *ties])


def dedup_by_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """First row per id; different reviews can share one."""
    return keep_first(df, [key], order)


def dedup_across_batches(df: DataFrame, key: str, batch: str) -> DataFrame:
    """Drops a row only if its id was seen in an earlier batch; repeats inside one batch stay."""
    first = df.groupBy(key).agg(F.min(batch).alias("__first"), F.count(F.lit(1)).alias("__rows"))
    return (
        lookup_join(df, first, [key], "__rows", spread=[key, batch])
        .where((F.col(batch) == F.col("__first")) | F.col(key).isNull())
        .drop("__first", "__rows")
    )

"""Joins of a large table with a keyed lookup when a few keys hold most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guestlens.session import shuffle_width


def row_salt(df: DataFrame, slices: Column, columns: Sequence[str] | None = None) -> Column:
    """A slice number in ``[0, slices)`` that a re-run task computes again.

    With ``columns`` only these are read, and rows equal in them are dealt by their task
    alone; a plan that needs few columns then reads few.

    It depends only on the row and on the number of the task that holds it, so a
    lost executor cannot move a row to another slice; equal rows of different
    tasks still spread.
    """
    plain = list(columns) if columns else [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.pmod(F.xxhash64(F.spark_partition_id(), *plain), slices)


def hot_keys(counts: DataFrame, keys: Sequence[str], weight: str) -> DataFrame:
    """Keys with more rows than an average reduce task, with the number of slices for each.

    ``counts`` has one row per key. With P reduce tasks a hot key holds more than
    1/P of all rows, so at most P keys qualify: the result is always small enough
    to broadcast, whatever the data.
    """
    width = shuffle_width(counts.sparkSession)
    total = counts.agg(F.sum(weight)).scalar()
    return counts.where(F.col(weight) * F.lit(width) > total).select(
        *keys, F.ceil(F.col(weight) * F.lit(width) / total).cast("long").alias("__slices")
    )


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    weight: str,
    how: str = "left",
    counts: DataFrame | None = None,
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """``big`` joined with ``lookup`` (at most one row per key), safe for hot keys.

    Rows of a hot key are dealt to several slices and its single lookup row is
    repeated once per slice, at most 2P extra rows in all. ``weight`` names the lookup
    column with the number of ``big`` rows of the key, which the aggregate that builds
    the lookup gets for nothing. The adaptive planner splits hot partitions only where
    both sides are shuffled for the join; a lookup that is already grouped by its key
    is not, which is why the keys are salted here. ``spread`` names the columns the salt is taken from. A measured small lookup is still
    broadcast.
    """
    keys = list(keys)
    # a null key never matches; the check the planner would add to some uses is made in all, so they share a shuffle
    lookup = present(lookup, keys)
    counts = lookup if counts is None else present(counts, keys)
    hot = F.broadcast(hot_keys(counts.select(*keys, weight), keys, weight))
    salted = big.join(hot, keys, "left")
    salted = salted.withColumn(
        "__salt", F.when(F.col("__slices").isNull(), F.lit(0).cast("long")).otherwise(row_salt(big, F.col("__slices"), spread))
    ).drop("__slices")
    copies = (
        lookup.join(hot, keys, "left")
        .withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("__slices", F.lit(1)) - 1)))
        .drop("__slices")
    )
    return salted.join(copies, [*keys, "__salt"], how).drop("__salt")


def present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a null in the columns, written as the planner itself writes such checks."""
    for column in columns:
        df = df.where(F.col(column).isNotNull())
    return df

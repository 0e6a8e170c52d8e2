"""Bounded takes per hotel and small-group filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guestlens.plans.skew import lookup_join, row_salt
from guestlens.session import shuffle_width


def take_per_group(df: DataFrame, group: str, order: Sequence[Column], target: int) -> DataFrame:
    """Exactly the first ``target`` rows of each group, whatever its size; a null group is a group.

    Rows of a group are dealt to slices and cut there first, so the last step sorts no
    more than ``target`` rows of each slice.
    """
    slices = shuffle_width(df.sparkSession)
    dealt = df.withColumn("__slice", row_salt(df, F.lit(slices)))
    for keys in ([group, "__slice"], [group]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        dealt = dealt.withColumn("__place", place).where(F.col("__place") <= target)
    return dealt.drop("__place", "__slice")


def take_whole_pages(df: DataFrame, group: str, page: str, target: int) -> DataFrame:
    """Whole pages of each group, in page order, until at least ``target`` rows are reached.

    Pages are counted first. A page has at least one row, so the last page taken is
    among the first ``target`` pages of its group, and the running sum needs no others.
    """
    order = Window.partitionBy(group).orderBy(page)
    counted = df.groupBy(group, page).agg(F.count(F.lit(1)).alias("page_rows"))
    sizes = counted.groupBy(group).agg(F.sum("page_rows").alias("__rows"))
    last = (
        counted.withColumn("__place", F.row_number().over(order))
        .where(F.col("__place") <= target)
        .withColumn("__earlier", F.sum("page_rows").over(order) - F.col("page_rows"))
        .where(F.col("__earlier") < target)
        .groupBy(group)
        .agg(F.max(page).alias("__last"))
    )
    taken = lookup_join(df, last, [group], "__rows", how="inner", counts=sizes, spread=[group, page])
    return taken.where(F.col(page) <= F.col("__last")).drop("__last")


def first_rows(df: DataFrame, order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first sources of a list, for trial runs; each task keeps its first n before they meet."""
    return df.orderBy(*order).limit(n)


def min_group_size(df: DataFrame, group: str, least: int = 5) -> DataFrame:
    """Rows of groups with at least ``least`` rows; rows without a group belong to none and go."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") >= least)
    return lookup_join(df, sizes, [group], "__rows", how="inner", spread=[group]).drop("__rows")

"""Exact order statistics without sorting a table, or one group, in a single task.

Rows are first reduced to a frequency table (one row per distinct value). Its
values are dealt to buckets by cut points taken from a quantile sketch; equal
values always share a bucket, and a bucket number depends on the value alone, so
a re-run task finds the same one. Running counts are taken inside each bucket and
shifted by the row counts of the earlier buckets, a table of one row per bucket.
The sketch decides only how evenly the work is spread, never a result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guestlens.plans.skew import present
from guestlens.session import shuffle_width


# Columns of the tables below; a group column may not have one of these names.
OWN_COLUMNS = ("value", "n", "cuts", "bucket", "center", "total", "ties", "before", "cell", "offset")


def _not_taken(keys: Sequence[str]) -> None:
    taken = set(keys) & set(OWN_COLUMNS)
    if taken:
        raise ValueError(f"rename the group column {sorted(taken)[0]!r}: the name is used by rank tables")


def clean_values(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """``keys`` and the value as a double named ``value``; missing and NaN values are left out."""
    _not_taken(keys)
    number = F.col(value).cast("double")
    out = df.select(*keys, F.nanvl(number, F.lit(None).cast("double")).alias("value"))
    return present(out, [*keys, "value"])


def frequency(df: DataFrame, value: str, keys: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """One row per distinct (keys, value) with its count ``n``; counted before the shuffle.

    ``weight`` names the count column of a table that already has that form.
    """
    if weight is not None:
        return df.select(*keys, F.col(value).alias("value"), F.col(weight).alias("n"))
    return clean_values(df, value, keys).groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))


def score_cube(df: DataFrame, value: str, columns: Sequence[str]) -> DataFrame:
    """(columns, value, n): the rows counted once by all the columns together and the value.

    Every table by one of the columns follows from it without another pass over the rows. Missing values are left
    out, missing labels kept. Counted before the shuffle; as many rows as combinations occur.
    """
    _not_taken(columns)
    counted = clean_values(df.withColumn("__labels", F.struct(*columns)), value, ["__labels"])
    return counted.groupBy("__labels", "value").agg(F.count(F.lit(1)).alias("n")).select("__labels.*", "value", "n")


def recount(df: DataFrame, value: str, keys: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """``frequency`` of rows, or of a table like ``score_cube`` whose rows stand for ``weight`` rows each."""
    if weight is None:
        return frequency(df, value, keys)
    counted = present(df.select(*keys, F.col(value).alias("value"), F.col(weight).alias("n")), [*keys, "value"])
    return counted.groupBy(*keys, "value").agg(F.sum("n").alias("n"))


def bucket_steps(width: int) -> list[int]:
    """Step sizes of the bucket search, halving down to 1; there are twice the first step's buckets."""
    levels = max(4, math.ceil(math.log2(2 * width)))
    return [2**level for level in reversed(range(levels))]


def cut_points(freq: DataFrame) -> Column:
    """Sorted cut points between the buckets, as a scalar subquery; fewer than twice 2P of them."""
    buckets = 2 * bucket_steps(shuffle_width(freq.sparkSession))[0]
    shares = [i / buckets for i in range(1, buckets)]
    return freq.agg(F.percentile_approx("value", shares, 4 * buckets)).scalar()


def deal(freq: DataFrame) -> DataFrame:
    """Adds ``bucket``, the number of cut points below the value, and ``center``, a middle cut point.

    The binary search is unrolled into one compiled step per halving. No step can be
    null: a nullable bucket would make the planner guard the joins on it with a null
    check and push that check, search included, below the count onto the raw rows.
    """
    steps = bucket_steps(shuffle_width(freq.sparkSession))
    names = [f"__bucket{i}" for i in range(len(steps) + 1)]
    search = [
        f"{below} + IF(get(cuts, {below} + {step - 1}) < value, {step}, 0) AS {here}"
        for below, here, step in zip(names, names[1:], steps)
    ]
    found = freq.withColumn("cuts", cut_points(freq)).selectExpr("*", f"0 AS {names[0]}", *search)
    return found.select(
        *freq.columns, F.col(names[-1]).alias("bucket"), F.get("cuts", F.lit(steps[0] - 1)).alias("center")
    )


def moments() -> list[Column]:
    """Aggregates of a rank table: n, mean, std (n - 1), min, max.

    Values are shifted to the middle of the table first, so a large common offset
    costs no precision.
    """
    n = F.sum("n").cast("double")
    shifted = F.col("value") - F.col("center")
    first, second = F.sum(F.col("n") * shifted), F.sum(F.col("n") * shifted * shifted)
    return [
        F.sum("n").alias("n"),
        (F.max("center") + first / n).alias("mean"),
        F.sqrt(F.try_divide(F.greatest(second - first * first / n, F.lit(0.0)), n - 1.0)).alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ]


def rank_table(freq: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Adds to each frequency row, counted inside ``within``:

    ``before`` rows with a smaller value, ``ties`` rows with the same value,
    ``total`` all rows, and ``center``, a value near the middle of the whole table.
    Rows of one ``bucket`` (inside ``within``) are neighbours in rank and share a task.
    """
    within = list(within)
    dealt = deal(freq)
    scope = [*within, "bucket"]
    # one row per (within, bucket): the window over them sees at most one row per bucket
    order = Window.partitionBy(*(within or [F.lit(0)])).orderBy("bucket")
    cells = (
        dealt.groupBy(*scope)
        .agg(F.sum("n").alias("cell"))
        .select(
            *scope,
            (F.sum("cell").over(order) - F.col("cell")).alias("offset"),
            F.sum("cell")
            .over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
            .alias("total"),
        )
    )
    upto = Window.partitionBy(*scope).orderBy("value")
    if set(freq.columns) == {*within, "value", "n"}:  # one row per value: no peers to look for
        ties = F.col("n")
        smaller = F.sum("n").over(upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    else:
        ties = F.sum("n").over(Window.partitionBy(*scope, "value"))
        smaller = F.sum("n").over(upto.rangeBetween(Window.unboundedPreceding, Window.currentRow)) - ties
    return dealt.join(cells, scope).select(
        *freq.columns, "bucket", "center", "total", ties.alias("ties"), (F.col("offset") + smaller).alias("before")
    )


def mid_ranks(df: DataFrame, value: str) -> DataFrame:
    """Average rank of each distinct value over the whole table."""
    ranked = rank_table(frequency(df, value))
    return ranked.select(
        "value", F.col("ties").alias("n"), (F.col("before") + (F.col("ties") + 1) / 2).alias("mid_rank")
    )


def quantiles(
    ranked: DataFrame,
    shares: Sequence[float],
    names: Sequence[str],
    within: Sequence[str] = (),
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Exact linear-interpolation quantiles from a rank table, one row per ``within`` key.

    ``extra`` aggregates are taken in the same pass.
    """
    picks = []
    for share, name in zip(shares, names):
        place = (F.col("total") - 1) * F.lit(float(share))
        for side, position in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            inside = (F.col("before") <= position) & (position < F.col("before") + F.col("n"))
            picks.append(F.max(F.when(inside, F.col("value"))).alias(f"__{name}_{side}"))
    found = ranked.groupBy(*within).agg(F.max("total").alias("total"), *picks, *extra)
    columns = []
    for share, name in zip(shares, names):
        place = (F.col("total") - 1) * F.lit(float(share))
        low, high = F.col(f"__{name}_lo"), F.col(f"__{name}_hi")
        columns.append((low + (high - low) * (place - F.floor(place))).alias(name))
    kept = [c for c in found.columns if c not in {*within, "total"} and not c.startswith("__")]
    return found.select(*within, "total", *columns, *kept)

"""Hypothesis tests between the groups of a score.

Every test takes ``(df, value, group, levels)``. ``levels`` lists the groups in
report order, so all tables "per group" below have at most that many rows. Spark
does every pass over the data; only the last step from statistic to p-value runs
on the result rows. With ``weight`` a test reads a table already counted by
``count_values``, so that several tests can share one pass over the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guestlens.functions import normal, royston, tails
from guestlens.functions.display import ALPHA, half_even, yes_no
from guestlens.plans.ranking import clean_values, frequency, quantiles, rank_table
from guestlens.session import shuffle_width

# The published approximation of W covers groups up to this size.
RELIABLE_N = 5000


def select_levels(df: DataFrame, group: str, levels: Sequence[Any] | None) -> DataFrame:
    """Rows of the listed groups; without a list, of all groups."""
    return df.where(F.col(group).isNotNull() if levels is None else F.col(group).isin(*levels))


def count_values(
    df: DataFrame, value: str, group: str, levels: Sequence[Any] | None, weight: str | None = None
) -> DataFrame:
    """(group, value, n): what all tests below are computed from."""
    return frequency(select_levels(df, group, levels), value, [group], weight)


def level_place(group: str, levels: Sequence[Any]) -> Column:
    """Position of a group in the listed order."""
    return F.array_position(F.array(*(F.lit(x) for x in levels)), F.col(group))


def each_pair(per_group: DataFrame, group: str, levels: Sequence[Any] | None, *totals: Column) -> DataFrame:
    """One row per pair of groups, with structs ``one`` and ``two`` of their rows and the totals of all groups.

    ``per_group`` has one row per group, in the listed order or, without a list, by label. Each row is
    repeated for the places behind its own, and these copies are joined by place with the groups
    there: pairs are made by many tasks. Pairs with an absent group are left out.
    """
    fields = [c for c in per_group.columns if c != group]
    order = group if levels is None else level_place(group, levels)
    entry = per_group.select(F.col(group).alias("name"), F.struct(*fields).alias("row"), F.row_number().over(Window.orderBy(order)).alias("place"))  # a row per group
    whole = per_group.agg(F.struct(*totals, F.count(F.lit(1)).cast("int").alias("__groups"))).scalar()
    names = per_group.agg(*totals).columns
    counted = entry.withColumn("__whole", whole).where(F.col("place") < F.col("__whole.__groups"))
    behind = F.explode(F.sequence(F.col("place") + 1, F.col("__whole.__groups")))
    first = counted.select(F.col("name").alias("group1"), F.col("row").alias("one"), *(F.col(f"__whole.{c}").alias(c) for c in names), behind.alias("place"))
    first = first.repartition(shuffle_width(per_group.sparkSession), "place")  # small rows, but the work on pairs may be dear
    second = entry.select(F.col("name").alias("group2"), F.col("row").alias("two"), "place")
    return first.join(second, "place").select("group1", "group2", *names, "one", "two")


# ---------------------------------------------------------------- rank tests


def rank_sums(
    df: DataFrame, value: str, group: str, levels: Sequence[Any], weight: str | None = None
) -> DataFrame:
    """Per group: n, twice the rank sum, and its share of the tie term, all as whole numbers.

    The tie term is the sum of t^3 - t over distinct values. 38-digit decimals hold
    it for about 10^12 rows, where a 64-bit number overflows at 2 * 10^6 equal rows.
    """
    wide = "decimal(38,0)"
    ranked = rank_table(count_values(df, value, group, levels, weight))
    n, ties = F.col("n").cast("decimal(19,0)"), F.col("ties").cast("decimal(19,0)")
    doubled = (F.col("before") * 2 + F.col("ties") + 1).cast("decimal(19,0)")
    return ranked.groupBy(group).agg(
        F.sum("n").alias("n"),
        F.sum((n * doubled).cast(wide)).cast(wide).alias("rank_sum2"),
        F.sum((n * (ties * ties - 1).cast(wide)).cast(wide)).cast(wide).alias("tie_term"),
    )


def _excess2(n: Column, rank_sum2: Column, total: Column) -> Column:
    """Twice the rank sum beyond its expectation, subtracted as whole numbers."""
    return (rank_sum2 - n.cast("decimal(19,0)") * (total.cast("decimal(19,0)") + 1)).cast("double")


def kruskal_wallis(
    df: DataFrame, value: str, group: str, levels: Sequence[Any], weight: str | None = None
) -> DataFrame:
    """One row: n, k, df, statistic H corrected for ties, p_value; null H where all values are equal."""
    sums = rank_sums(df, value, group, levels, weight)
    part = F.struct(F.col("n"), F.col("rank_sum2"))
    row = sums.agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("k"),
        F.sum("tie_term").cast("double").alias("tie_term"),
        F.sort_array(F.collect_list(part)).alias("parts"),  # one entry per listed level
    )
    total = F.col("n").cast("double")
    spread = F.aggregate(
        "parts",
        F.lit(0.0),
        lambda acc, g: acc + F.pow(_excess2(g["n"], g["rank_sum2"], F.col("n")) / 2.0, F.lit(2.0)) / g["n"].cast("double"),
    )
    correction = F.lit(1.0) - F.try_divide(F.col("tie_term"), total * total * total - total)
    h = F.try_divide(spread * 12.0 / (total * (total + 1.0)), correction)
    return (
        row.select("n", "k", (F.col("k") - 1).alias("df"), h.alias("statistic"))
        .withColumn("p_value", tails.chi2_p("statistic", "df"))
    )


def mann_whitney_u(
    df: DataFrame, value: str, group: str, first: Any, second: Any, weight: str | None = None
) -> DataFrame:
    """One row: n1, n2, U of the first group, z, method and the two-sided p.

    Normal approximation with tie and continuity correction; exact where a group
    has at most eight values and there are no ties.
    """
    sums = rank_sums(df, value, group, [first, second], weight)
    row = sums.agg(
        F.coalesce(F.sum(F.when(F.col(group) == first, F.col("n"))), F.lit(0)).alias("n1"),
        F.coalesce(F.sum(F.when(F.col(group) == second, F.col("n"))), F.lit(0)).alias("n2"),
        F.sum(F.when(F.col(group) == first, F.col("rank_sum2"))).alias("rank_sum2"),
        F.sum("tie_term").cast("double").alias("tie_term"),
    )
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    total = n1 + n2
    pairs2 = F.col("n1").cast("decimal(19,0)") * (F.col("n1") + 1).cast("decimal(19,0)")
    excess = _excess2(F.col("n1"), F.col("rank_sum2"), F.col("n1") + F.col("n2")) / 2.0
    spread = F.sqrt(n1 * n2 / 12.0 * (total + 1.0 - F.try_divide(F.col("tie_term"), total * (total - 1.0))))
    exact = (F.least("n1", "n2") <= 8) & (F.col("tie_term") == 0.0)
    out = row.select(
        "n1",
        "n2",
        ((F.col("rank_sum2") - pairs2).cast("double") / 2.0).alias("statistic"),
        F.try_divide(F.abs(excess) - 0.5, spread).alias("z"),
        F.when(exact, F.lit("exact")).otherwise(F.lit("asymptotic")).alias("method"),
    )
    larger = F.greatest(F.col("statistic"), n1 * n2 - F.col("statistic"))
    near = F.least(tails.normal_upper_p("z") * 2.0, F.lit(1.0))
    # arguments are null, and the Pandas function idle, where the other method applies
    sure = tails.rank_sum_exact_p(F.when(F.col("method") == "exact", larger), "n1", "n2")
    return out.withColumn("p_value", F.when(F.col("method") == "exact", sure).otherwise(near))


def dunn_posthoc(
    df: DataFrame, value: str, group: str, levels: Sequence[Any], weight: str | None = None
) -> DataFrame:
    """One row per pair of listed groups: mean ranks, z, Bonferroni-adjusted p. The long form of the matrix."""
    sums = rank_sums(df, value, group, levels, weight)
    means = sums.select(
        group, "n", (F.col("rank_sum2").cast("double") / F.col("n") / 2.0).alias("mean_rank"), "tie_term"
    )
    pairs = each_pair(
        means,
        group,
        levels,
        F.sum("n").cast("double").alias("size"),
        F.sum("tie_term").cast("double").alias("ties"),
        F.count(F.lit(1)).alias("k"),
    )
    size = F.col("size")
    variance = (size * (size + 1.0) / 12.0 - F.col("ties") / (size - 1.0) / 12.0) * (1.0 / F.col("one.n") + 1.0 / F.col("two.n"))
    apart = F.abs(F.col("one.mean_rank") - F.col("two.mean_rank"))
    comparisons = F.col("k") * (F.col("k") - 1) / 2
    return (
        pairs.withColumn("z", F.try_divide(apart, F.sqrt(variance)))
        .withColumn("p_adjusted", F.least(F.lit(1.0), tails.normal_upper_p("z") * 2.0 * comparisons))
        .select(
            "group1",
            "group2",
            F.col("one.n").alias("n1"),
            F.col("two.n").alias("n2"),
            F.col("one.mean_rank").alias("mean_rank1"),
            F.col("two.mean_rank").alias("mean_rank2"),
            "z",
            "p_adjusted",
        )
    )


def symmetric_matrix(
    pairs: DataFrame, levels: Sequence[Any], cell: str = "p_adjusted", digits: int | None = 4
) -> DataFrame:
    """Square matrix of a pair table with a unit diagonal: position, label, one column per level."""
    kind = pairs.schema["group1"].dataType.simpleString()
    shown = F.col(cell) if digits is None else half_even(F.col(cell), digits)
    both = F.array(
        F.struct(F.col("group1"), F.col("group2"), shown.alias("cell")),
        F.struct(F.col("group2").alias("group1"), F.col("group1").alias("group2"), shown.alias("cell")),
    )
    diagonal = pairs.sparkSession.createDataFrame([(x, x, 1.0) for x in levels], f"group1 {kind}, group2 {kind}, cell double")
    out = pairs.select(F.inline(both)).union(diagonal).groupBy("group1").pivot("group2", list(levels)).agg(F.first("cell"))
    return out.select(
        level_place("group1", levels).cast("int").alias("position"),
        F.col("group1").cast("string").alias("label"),
        *(F.col(f"`{x}`").alias(str(x)) for x in levels),
    )


# ---------------------------------------------------------------- moment tests


def group_moments(
    df: DataFrame, value: str, group: str, levels: Sequence[Any] | None, weight: str | None = None
) -> DataFrame:
    """Per group: n, mean, variance (n - 1); reduced before the shuffle."""
    if weight is None:
        return (
            clean_values(select_levels(df, group, levels), value, [group])
            .groupBy(group)
            .agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.var_samp("value").alias("variance"))
        )
    counted = count_values(df, value, group, levels, weight)
    # shifted to the common mean first, so a large offset costs no precision
    center = counted.agg(F.sum(F.col("n") * F.col("value")) / F.sum("n")).scalar()
    shifted = counted.withColumn("center", center).withColumn("x", F.col("value") - F.col("center"))
    n = F.sum("n").cast("double")
    first, second = F.sum(F.col("n") * F.col("x")), F.sum(F.col("n") * F.col("x") * F.col("x"))
    return shifted.groupBy(group).agg(
        F.sum("n").alias("n"),
        (F.max("center") + first / n).alias("mean"),
        F.try_divide(F.greatest(second - first * first / n, F.lit(0.0)), n - 1.0).alias("variance"),
    )


def _sum_over(parts: str, term) -> Column:
    return F.aggregate(parts, F.lit(0.0), lambda acc, g: acc + term(g))


def sums_of_squares(moments: DataFrame) -> DataFrame:
    """One row: n, k, between and within sums of squares; the array has one entry per listed group."""
    part = F.struct(F.col("n"), F.col("mean"), F.col("variance"))
    row = moments.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.sort_array(F.collect_list(part)).alias("parts")
    ).withColumn("grand", _sum_over("parts", lambda g: g["n"] * g["mean"]) / F.col("n"))
    return row.select(
        "n",
        "k",
        _sum_over("parts", lambda g: g["n"] * F.pow(g["mean"] - F.col("grand"), F.lit(2.0))).alias("between"),
        _sum_over("parts", lambda g: (g["n"] - 1) * F.coalesce(g["variance"], F.lit(0.0))).alias("within"),
    )


def anova_oneway(
    df: DataFrame, value: str, group: str, levels: Sequence[Any], weight: str | None = None
) -> DataFrame:
    """One row: n, k, df1, df2, statistic F, p_value."""
    row = sums_of_squares(group_moments(df, value, group, levels, weight))
    df1, df2 = F.col("k") - 1, F.col("n") - F.col("k")
    f = F.try_divide(F.try_divide(F.col("between"), df1.cast("double")), F.try_divide(F.col("within"), df2.cast("double")))
    return row.select("n", "k", df1.alias("df1"), df2.alias("df2"), f.alias("statistic")).withColumn(
        "p_value", tails.f_p("statistic", "df1", "df2")
    )


def levene(
    df: DataFrame, value: str, group: str, levels: Sequence[Any], weight: str | None = None
) -> DataFrame:
    """Equal spread around the group medians: the one-way test on the distances.

    Distances are taken from the counted values. The medians are one row per listed
    level, so sending them to every task is safe whatever the size of the data.
    """
    counted = count_values(df, value, group, levels, weight)
    centers = quantiles(rank_table(counted, [group]), [0.5], ["median"], [group]).select(group, "median")
    distances = counted.join(F.broadcast(centers), group).select(
        group, F.abs(F.col("value") - F.col("median")).alias("distance"), "n"
    )
    return anova_oneway(distances, "distance", group, levels, weight="n")


def ttest_ind(
    df: DataFrame,
    value: str,
    group: str,
    first: Any,
    second: Any,
    equal_variance: bool | Column = False,
    weight: str | None = None,
) -> DataFrame:
    """One row: n1, n2, statistic t, df, variant ("student" or "welch"), two-sided p.

    ``equal_variance`` may be a scalar subquery, so Levene's verdict can choose the variant.
    """
    moments = group_moments(df, value, group, [first, second], weight)

    def pick(column: str, level: Any, name: str) -> Column:
        return F.max(F.when(F.col(group) == level, F.col(column))).alias(name)

    row = moments.agg(
        *(pick(c, level, f"{c}{i}") for i, level in ((1, first), (2, second)) for c in ("n", "mean", "variance"))
    ).withColumn("__equal", equal_variance if isinstance(equal_variance, Column) else F.lit(equal_variance))
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    v1, v2 = F.col("variance1"), F.col("variance2")
    pooled_df = n1 + n2 - 2.0
    pooled = ((n1 - 1.0) * v1 + (n2 - 1.0) * v2) / pooled_df * (1.0 / n1 + 1.0 / n2)
    apart = v1 / n1 + v2 / n2
    welch_df = apart * apart / (F.pow(v1 / n1, F.lit(2.0)) / (n1 - 1.0) + F.pow(v2 / n2, F.lit(2.0)) / (n2 - 1.0))
    return (
        row.withColumn("statistic", F.try_divide(F.col("mean1") - F.col("mean2"), F.sqrt(F.when(F.col("__equal"), pooled).otherwise(apart))))
        .withColumn("df", F.when(F.col("__equal"), pooled_df).otherwise(welch_df))
        .withColumn("variant", F.when(F.col("__equal"), F.lit("student")).otherwise(F.lit("welch")))
        .select("n1", "n2", "statistic", "df", "variant")
        .withColumn("p_value", tails.t_p("statistic", "df"))
    )


def tukey_statistics(
    df: DataFrame, value: str, group: str, levels: Sequence[Any] | None, weight: str | None = None
) -> DataFrame:
    """Per pair of groups in label order: mean difference, standard error, q, k and degrees of freedom."""
    moments = group_moments(df, value, group, levels, weight)
    within = F.sum((F.col("n") - 1) * F.coalesce(F.col("variance"), F.lit(0.0)))
    pairs = each_pair(
        moments,
        group,
        None,
        F.sum("n").alias("size"),
        F.count(F.lit(1)).alias("k"),
        within.alias("within"),
    ).withColumn("df", F.col("size") - F.col("k"))
    square = F.try_divide(F.col("within"), F.col("df").cast("double"))
    return (
        pairs.withColumn("meandiff", F.col("two.mean") - F.col("one.mean"))
        .withColumn("se", F.sqrt(square / 2.0 * (1.0 / F.col("one.n") + 1.0 / F.col("two.n"))))
        .select("group1", "group2", "meandiff", "se", F.try_divide(F.abs("meandiff"), F.col("se")).alias("q"), "k", "df")
    )


def tukey_hsd(
    df: DataFrame,
    value: str,
    group: str,
    levels: Sequence[Any] | None = None,
    alpha: float = ALPHA,
    weight: str | None = None,
) -> DataFrame:
    """Per pair: meandiff, adjusted p, confidence limits, verdict; without ``levels``, for all groups.

    The quantile behind the limits depends on the number of groups and the degrees of freedom alone: it is found once.
    """
    pairs = tukey_statistics(df, value, group, levels, weight)
    moments = group_moments(df, value, group, levels, weight)
    k = F.count(F.lit(1))
    sizes = moments.agg(k.alias("k"), (F.sum("n") - k).alias("df"))
    quantile = sizes.select(tails.studentized_range_q(F.lit(alpha), "k", "df")).scalar()
    return (
        pairs.withColumn("p_adj", tails.studentized_range_p("q", "k", "df"))
        .withColumn("__reach", quantile * F.col("se"))
        .select(
            "group1",
            "group2",
            "meandiff",
            "p_adj",
            (F.col("meandiff") - F.col("__reach")).alias("lower"),
            (F.col("meandiff") + F.col("__reach")).alias("upper"),
            (F.abs("meandiff") > F.col("__reach")).alias("reject"),
        )
    )


# ---------------------------------------------------------------- normality


def shapiro_wilk(
    df: DataFrame,
    value: str,
    group: str,
    levels: Sequence[Any],
    alpha: float = ALPHA,
    weight: str | None = None,
) -> DataFrame:
    """Per group: n, W, p, normal ("Yes"/"No") and whether p is inside the approximation's range.

    Order statistics come from the rank table; a block of equal values adds its value
    times the weights of all its ranks at once. Undefined cases (fewer than three
    values, all equal) give null and "No".
    """
    ranked = rank_table(count_values(df, value, group, levels, weight), [group])
    # A block of equal values weighs in with the sum of its ranks' scores: the sum up to its last rank
    # less that up to the rank before its first. Neighbouring blocks share that rank, so one sum per
    # block is enough, plus one behind the last block of each bucket.
    along = Window.partitionBy(group, "bucket").orderBy("value")
    x = F.col("value") - F.col("center")
    own = F.struct(
        F.col("before").alias("rank"),
        F.coalesce(F.lag("value").over(along) - F.col("value"), -x).alias("weight"),
        F.lit(True).alias("whole"),
    )
    behind = F.struct((F.col("before") + F.col("n")).alias("rank"), x.alias("weight"), F.lit(False).alias("whole"))
    last = F.lead("value").over(along).isNull()
    sums_at = (
        ranked.withColumn("own", own)
        .withColumn("points", F.when(last, F.array("own", behind)).otherwise(F.array("own")))
        .select(group, "total", "n", "before", x.alias("x"), F.inline("points"))
    )
    # score sums of the first r and of the first n - r ranks are equal, so only the nearer end matters
    inner = F.col("near") > royston.END_RANKS
    shares = (
        sums_at.withColumn("near", F.least(F.col("rank"), F.col("total") - F.col("rank")))
        .withColumn("width", F.col("total") + 0.25)
        .withColumn("share", F.when(inner, (F.col("near") + 0.125) / F.col("width")))
    )
    scored = normal.with_normal_quantile(shares, "share", "z").withColumn(
        "sum",
        F.when(inner, normal.score_prefix_edge(F.col("z"), F.col("width"))).when(
            F.col("near") > 0, normal.score_prefix_end(F.col("near"), F.col("width"))
        ),
    )

    def at(rank: Column, name: str) -> Column:
        inside = F.col("whole") & (F.col("before") < rank) & (rank <= F.col("before") + F.col("n"))
        return F.max(F.when(inside, F.col("x"))).alias(name)

    sums = scored.groupBy(group).agg(
        F.max("total").alias("n"),
        F.coalesce(F.sum(F.col("weight") * F.col("sum")), F.lit(0.0)).alias("dot"),
        F.coalesce(F.sum(F.when(inner, F.col("weight"))), F.lit(0.0)).alias("inner_weight"),
        F.sum(F.when(F.col("whole"), F.col("n") * F.col("x"))).alias("sum1"),
        F.sum(F.when(F.col("whole"), F.col("n") * F.col("x") * F.col("x"))).alias("sum2"),
        at(F.lit(1), "x_first"),
        at(F.lit(2), "x_second"),
        at(F.col("total") - 1, "x_next"),
        at(F.col("total"), "x_last"),
    )
    result = royston.w_and_p(
        "n",
        "dot",
        "inner_weight",
        F.col("x_last") - F.col("x_first"),
        F.col("x_next") - F.col("x_second"),
        F.col("sum2") - F.col("sum1") * F.col("sum1") / F.col("n"),
    )
    return (
        sums.select(group, "n", result.alias("result"))
        .select(group, "n", "result.w", "result.p_value")
        .withColumn("normal", yes_no(F.col("p_value") > alpha))
        .withColumn("p_reliable", F.col("n") <= RELIABLE_N)
    )

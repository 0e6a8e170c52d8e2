"""Shapiro-Wilk W and p of one group from its summed order statistics.

Published approximation (Royston 1995, AS R94). It runs on one result row per
group; the sums over the data are made by Spark.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guestlens.functions.tails import normal_upper

# Polynomials of the approximation, lowest power first.
LAST_WEIGHT = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
NEXT_WEIGHT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
SMALL_MEAN = (0.5440, -0.39978, 0.025054, -6.714e-4)
SMALL_SPREAD = (1.3822, -0.77857, 0.062767, -0.0020322)
LARGE_MEAN = (-1.5861, -0.31082, -0.083751, 0.0038915)
LARGE_SPREAD = (-0.4803, -0.082676, 0.0030302)
SMALL_SHIFT = (-2.273, 0.459)

# Ranks up to this distance from an end are summed one by one, the others by the smooth rule.
END_RANKS = 32

_NORMAL = NormalDist()


def polynomial(coefficients: Sequence[float], x: float) -> float:
    out = 0.0
    for c in reversed(coefficients):
        out = out * x + c
    return out


def rank_score(rank: float, n: int) -> float:
    return _NORMAL.inv_cdf((rank - 0.375) / (n + 0.25))


def end_sums(n: int, power: int = 1) -> list[float]:
    """Running sums of the first rank scores (or their powers), index = number of ranks."""
    out = [0.0]
    for rank in range(1, min(END_RANKS, n) + 1):
        out.append(out[-1] + rank_score(rank, n) ** power)
    return out


def smooth_edge(edge: float, n: int, power: int = 1) -> float:
    """Antiderivative of the scores (or their squares) with end corrections, at a half rank."""
    width = n + 0.25
    z = _NORMAL.inv_cdf((edge - 0.375) / width)
    density = math.exp(-z * z / 2.0) / math.sqrt(2.0 * math.pi)
    if power == 1:
        area, first, third = -density, 1.0 / density, (1.0 + 2.0 * z * z) / density**3
    else:
        area = (edge - 0.375) / width - z * density
        first, third = 2.0 * z / density, (8.0 * z + 4.0 * z**3) / density**3
    return width * area - first / width / 24.0 + third / width**3 * (7.0 / 5760.0)


def squared_score_sum(n: int) -> float:
    """Sum of the squares of all n rank scores; both halves are equal."""
    half = n // 2
    total = end_sums(n, 2)[min(half, END_RANKS)]
    if half > END_RANKS:
        total += smooth_edge(half + 0.5, n, 2) - smooth_edge(END_RANKS + 0.5, n, 2)
    return 2.0 * total


def w_statistic(n: int, dot: float, inner_weight: float, outer: float, inner: float, squares: float) -> float:
    """W from the sums of one group.

    ``dot`` is the sum of values times rank scores, in which sums of more than
    ``END_RANKS`` scores lack the same constant; ``inner_weight`` is the total weight of
    those. ``outer``/``inner`` are the distances between the last and first, and the
    next-to-last and second value, ``squares`` the sum of squares about the mean.
    """
    if inner_weight:
        dot += inner_weight * (end_sums(n)[END_RANKS] - smooth_edge(END_RANKS + 0.5, n))
    m1, m2 = -rank_score(1, n), -rank_score(2, n)
    mm = squared_score_sum(n)
    if n == 3:
        linear = math.sqrt(0.5) * outer
    else:
        root = 1.0 / math.sqrt(n)
        w1 = polynomial(LAST_WEIGHT, root) + m1 / math.sqrt(mm)
        if n > 5:
            w2 = polynomial(NEXT_WEIGHT, root) + m2 / math.sqrt(mm)
            scale = math.sqrt((mm - 2.0 * m1 * m1 - 2.0 * m2 * m2) / (1.0 - 2.0 * w1 * w1 - 2.0 * w2 * w2))
            linear = (dot - m1 * outer - m2 * inner) / scale + w1 * outer + w2 * inner
        else:
            scale = math.sqrt((mm - 2.0 * m1 * m1) / (1.0 - 2.0 * w1 * w1))
            linear = (dot - m1 * outer) / scale + w1 * outer
    return min(1.0, linear * linear / squares)


def w_upper(w: float, n: int) -> float:
    """Probability of a W at most as large under normality."""
    if n == 3:
        return max(0.0, min(1.0, 6.0 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75)))))
    if w >= 1.0:
        return 1.0
    y = math.log1p(-w)
    if n <= 11:
        shift = polynomial(SMALL_SHIFT, n)
        if y >= shift:
            return 1e-99
        return normal_upper((-math.log(shift - y) - polynomial(SMALL_MEAN, n)) / math.exp(polynomial(SMALL_SPREAD, n)))
    ln_n = math.log(n)
    return normal_upper((y - polynomial(LARGE_MEAN, ln_n)) / math.exp(polynomial(LARGE_SPREAD, ln_n)))


RESULT = T.StructType([T.StructField("w", T.DoubleType()), T.StructField("p_value", T.DoubleType())])


@F.pandas_udf(RESULT)
def w_and_p(
    n: pd.Series, dot: pd.Series, inner_weight: pd.Series, outer: pd.Series, inner: pd.Series, squares: pd.Series
) -> pd.DataFrame:
    """Null for fewer than three values and for values that are all equal."""
    out = []
    for size, d, weight, o, i, s in zip(n, dot, inner_weight, outer, inner, squares):
        if size < 3 or not o > 0 or not s > 0:
            out.append((None, None))
            continue
        w = w_statistic(int(size), d, weight, o, i, s)
        out.append((w, w_upper(w, int(size))))
    return pd.DataFrame(out, columns=["w", "p_value"], dtype="float64")

"""Normal quantiles and sums of them as column expressions.

The quantile is the published approximation AS 241 (Wichura 1988, PPND16).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rational approximations of AS 241, lowest power first.
CENTRAL = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
     4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
)
MIDDLE = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
     1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
OUTER = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
     2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)


def polynomial(coefficients: Sequence[float], x: Column) -> Column:
    """Coefficients lowest power first."""
    out = F.lit(float(coefficients[-1]))
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(float(c))
    return out


def _ratio(table: tuple[Sequence[float], Sequence[float]], x: Column) -> Column:
    return polynomial(table[0], x) / polynomial(table[1], x)


def _branches(q: Column, r: Column, central: Column, middle: Column, outer: Column) -> Column:
    tail = F.when(r <= 5.0, _ratio(MIDDLE, middle)).otherwise(_ratio(OUTER, outer))
    return F.when(F.abs(q) <= 0.425, q * _ratio(CENTRAL, central)).otherwise(F.signum(q) * tail)


def normal_quantile(p: Column) -> Column:
    """Inverse of the normal distribution function for ``0 < p < 1``."""
    q = p - F.lit(0.5)
    r = F.sqrt(-F.ln(F.least(p, F.lit(1.0) - p)))
    return _branches(q, r, F.lit(0.180625) - q * q, r - 1.6, r - 5.0)


def with_normal_quantile(df: DataFrame, p: str, name: str) -> DataFrame:
    """The same as a new column of a table.

    The arguments of the polynomials become columns first. Written out in every term
    they would make one compiled method too long for the JVM to optimise.
    """
    q, r = F.col("__q"), F.col("__r")
    return (
        df.withColumn("__q", F.col(p) - 0.5)
        .withColumn("__r", F.sqrt(-F.ln(F.least(F.col(p), F.lit(1.0) - F.col(p)))))
        .withColumns({"__central": F.lit(0.180625) - q * q, "__middle": r - 1.6, "__outer": r - 5.0})
        .withColumn(name, _branches(q, r, F.col("__central"), F.col("__middle"), F.col("__outer")))
        .drop("__q", "__r", "__central", "__middle", "__outer")
    )


def normal_density(z: Column) -> Column:
    return F.exp(z * z / F.lit(-2.0)) / F.lit(math.sqrt(2.0 * math.pi))


def score_prefix_edge(z: Column, width: Column) -> Column:
    """Smooth part of a sum of rank scores up to a half rank where the normal quantile is ``z``.

    Antiderivative of the quantile function with the end corrections of the
    Euler-Maclaurin rule; a sum over a range of ranks is a difference of two.
    """
    density = normal_density(z)
    third = (1.0 + 2.0 * z * z) / F.pow(density * width, F.lit(3.0))
    return -width * density - 1.0 / (width * density) / 24.0 + third * (7.0 / 5760.0)


def score_prefix_end(ranks: Column, width: Column) -> Column:
    """Sum of the first ``ranks`` rank scores, one by one; for a handful of ranks near an end."""
    shares = F.transform(F.sequence(F.lit(1), ranks.cast("int")), lambda i: (i - F.lit(0.375)) / width)
    return F.aggregate(shares, F.lit(0.0), lambda total, p: total + normal_quantile(p))

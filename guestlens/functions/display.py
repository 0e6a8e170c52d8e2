"""How numbers and decisions are shown in result and report tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ALPHA = 0.05


def half_even(number: Column, digits: int) -> Column:
    """Rounded the way the result tables round: scaled, to the even whole number at a half, scaled back.

    Rounding the printed decimals instead would differ where scaling is inexact (1.015 gives 1.01 here).
    """
    scale = F.lit(10.0**digits)
    return F.rint(number * scale) / scale


def decision(p: Column, alpha: float = ALPHA) -> Column:
    """Decision text, taken on the unrounded p; nothing is rejected without one."""
    return F.when(p < alpha, F.lit(f"Reject H₀ (p < {alpha})")).otherwise(F.lit(f"Fail to reject H₀ (p ≥ {alpha})"))


def yes_no(flag: Column) -> Column:
    """A missing flag reads "No", as does a p-value that cannot be computed."""
    return F.when(flag, F.lit("Yes")).otherwise(F.lit("No"))


def p_text(text: Column) -> Column:
    """A p-value for a report cell; text that is no number is left as it is."""
    p = text.cast("string").try_cast("double")
    return (
        F.when(p.isNull(), text.cast("string"))
        .when(p >= 0.9999, F.lit("1.000"))
        .when(p < 0.001, F.lit("< 0.001"))
        .otherwise(F.format_string("%.4f", p))
    )


def annotation(test: Column, label: Column, statistic: Column, p: Column) -> Column:
    """One-line summary below a chart, with decimal commas."""
    missing = p.isNull() | F.isnan(p)
    p_part = (
        F.when(missing, F.lit("p = nan"))
        .when(p >= 0.0001, F.concat(F.lit("p = "), F.format_string("%.4f", p)))
        .otherwise(F.lit("p < 0.0001"))
    )
    shown = F.when(statistic.isNull(), F.lit("nan")).otherwise(F.format_string("%.2f", statistic))
    line = F.concat(test, F.lit(": "), label, F.lit(" = "), shown, F.lit(", "), p_part)
    return F.translate(line, ".", ",")

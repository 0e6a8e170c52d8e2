"""Report tables built from result tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestlens.functions.display import p_text
from guestlens.functions.labels import GROUP_NAMES
from guestlens.operators.aspects import SENTIMENTS, crosstab


def matrix_report(matrix: DataFrame, levels: Sequence[Any], names: Mapping[str, str] = GROUP_NAMES) -> DataFrame:
    """A p-value matrix with translated labels and formatted cells, rows in the order of the columns."""
    shown = {str(x): names.get(str(x).replace("★", ""), str(x).replace("★", "")) for x in levels}
    pairs = [F.lit(x) for pair in shown.items() for x in pair]
    return matrix.select(
        "position",
        F.coalesce(F.element_at(F.create_map(*pairs), F.col("label")), F.col("label")).alias("label"),
        *(p_text(F.col(f"`{x}`")).alias(name) for x, name in shown.items()),
    )


def aspect_counts(df: DataFrame, category: str = "category_name") -> DataFrame:
    """Category by sentiment; the report shows it by negative mentions, most first."""
    return crosstab(df, category, "sentiment", SENTIMENTS)


def aspect_report(counts: DataFrame, category: str = "category_name") -> DataFrame:
    """The same with report headings and the row total, ordered."""
    return (
        counts.withColumn("laczna_liczba_aspektow", F.col("NEGATIVE") + F.col("NEUTRAL") + F.col("POSITIVE"))
        .withColumnsRenamed(
            {
                category: "kategoria_skargi",
                "NEGATIVE": "sentyment_negatywny",
                "NEUTRAL": "sentyment_neutralny",
                "POSITIVE": "sentyment_pozytywny",
            }
        )
        .orderBy(F.desc("sentyment_negatywny"), "kategoria_skargi")
    )

"""The corpus pipeline: from ``documents`` to packed training sequences.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from guestlens.llm import bayes_dedup, decontaminate, divergence_rules, line_join, pattern_packing, tokens
from guestlens.llm.frames import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the divergence rules accept."""
    return divergence_rules.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines whose words are similar to those of an earlier line are cut; documents of which nothing is left go."""
    return line_join.without_later_lines(docs, line_join.WORDS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return bayes_dedup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequences."""
    return pattern_packing.pack(docs, tokens.vocabulary_path())


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("best-fit packing", packing),
]

#: No SQL: language references, token ids and the packing plan cannot be expressed in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on the stored result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""One query per operator on the test tables, with production parameters and whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from guestlens.llm import bayes_dedup, binary_output, compaction, decontaminate, divergence_rules, hidden_markov, host_extract, importance_resampling, line_join, pattern_packing, periodic_runs, quality_model, run_index, tokens
from guestlens.llm.frames import table


def op1_containment_search(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op2_minhash_bayes(spark: SparkSession, folder: str) -> DataFrame:
    return bayes_dedup.near_duplicates(table(spark, folder, "documents"), bayes_dedup.Rule(shingle=3, percent=85))


def op3_run_index(spark: SparkSession, folder: str) -> DataFrame:
    return run_index.removal_digest(table(spark, folder, "documents"))


def op4_similar_lines(spark: SparkSession, folder: str) -> DataFrame:
    return line_join.line_report(table(spark, folder, "documents"), line_join.WORDS)


def op5_host_paths(spark: SparkSession, folder: str) -> DataFrame:
    return host_extract.main_text(table(spark, folder, "pages"))


def op6_random_indexing(spark: SparkSession, folder: str) -> DataFrame:
    return quality_model.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_token_matrices(spark: SparkSession, folder: str) -> DataFrame:
    return binary_output.packed_rows(table(spark, folder, "documents"), tokens.vocabulary_path())


def op8_divergence_rules(spark: SparkSession, folder: str) -> DataFrame:
    return divergence_rules.measured(table(spark, folder, "documents"))


def op9_pattern_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pattern_packing.pack(table(spark, folder, "documents"), tokens.vocabulary_path())


def op10_compacted_spans(spark: SparkSession, folder: str) -> DataFrame:
    return compaction.removal_digest(table(spark, folder, "documents"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.run_digest(table(spark, folder, "documents"))


def op12_hidden_markov(spark: SparkSession, folder: str) -> DataFrame:
    return hidden_markov.scored(table(spark, folder, "documents"))


def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance_resampling.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The first query of every operator, by name; each takes (spark, sf_dir)."""
    return {
        "op1_containment_search": op1_containment_search,
        "op2_minhash_bayes": op2_minhash_bayes,
        "op3_run_index": op3_run_index,
        "op4_similar_lines": op4_similar_lines,
        "op5_host_paths": op5_host_paths,
        "op6_random_indexing": op6_random_indexing,
        "op7_token_matrices": op7_token_matrices,
        "op8_divergence_rules": op8_divergence_rules,
        "op9_pattern_packing": op9_pattern_packing,
        "op10_compacted_spans": op10_compacted_spans,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_hidden_markov": op12_hidden_markov,
        "op13_importance_resampling": op13_importance_resampling,
    }

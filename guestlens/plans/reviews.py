"""From raw passes to the two analysis tables and the aspect results."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from guestlens.functions.text import has_words, none_if_blank
from guestlens.operators.aspects import categorise, extract_phrases, flatten_aspects
from guestlens.operators.clean import MIN_WORDS, filter_min_words, filter_period, has_score, in_period, union_passes
from guestlens.operators.dedup import dedup_content
from guestlens.operators.language import filter_language

PASS = "__pass"
PASSES = ("general", "negative", "business")


class Written(NamedTuple):
    """Both analysis tables, and how many rows of each pass were left after each stage on the way to them."""

    statistics: DataFrame
    texts: DataFrame
    counts: DataFrame


def statistics_table(general: DataFrame, negative: DataFrame, business: DataFrame | None = None, drop_zero: bool = False) -> DataFrame:
    """All languages and lengths: period, score and content rules only. One shuffle, on the content key."""
    return dedup_content(filter_period(union_passes(general, negative, business), drop_zero=drop_zero))


def aspect_input(statistics: DataFrame, language: str = "en") -> DataFrame:
    """Reviews with a substantive negative text in the given language; narrow filters only."""
    return filter_language(filter_min_words(statistics, "neg_text"), "neg_text", language)


def aspect_results(texts: DataFrame) -> DataFrame:
    """Flat aspect table with categories, from the built-in extractor: aspects by keyword stems, as phrases."""
    return categorise(flatten_aspects(extract_phrases(texts)))


def _observed(df: DataFrame, stages: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` as it is; while it is computed, the rows of each pass that meet each stage are counted."""
    metrics = [
        F.count_if((F.col(PASS) == name) & F.coalesce(met, F.lit(False))).alias(f"{name} {stage}") for name in PASSES for stage, met in stages.items()
    ]
    watch = Observation()
    return df.observe(watch, *metrics), watch


def write_tables(
    spark: SparkSession,
    folder: str,
    general: DataFrame,
    negative: DataFrame,
    business: DataFrame | None = None,
) -> Written:
    """Writes both analysis tables, the second from the written first one, and counts the rows of every stage on the way.

    Reading the stored table back replaces a cache: the expensive shuffle runs once,
    and a lost executor costs a re-read instead of a recomputation. The counts (pass, position, stage, rows) are
    taken while the tables are written, without another scan; a stage that is run again
    after a loss may count its rows again, the tables don't change. The first table keeps its pass in the column ``__pass``
    only in the files, from where the second one is counted.
    """
    passes = {name: df.withColumn(PASS, F.lit(name)) for name, df in zip(PASSES, (general, negative, business)) if df is not None}
    dated = in_period(F.col("stay_date"))
    loaded, first = _observed(union_passes(*passes.values()), {"loaded": F.lit(True), "in_period": dated, "with_score": dated & has_score(F.col("rating_score"))})
    place = F.array_position(F.array(*(F.lit(x) for x in PASSES)), F.col(PASS))
    kept, second = _observed(dedup_content(filter_period(loaded), ties=[place]), {"distinct_content": F.lit(True)})
    kept.write.mode("overwrite").parquet(f"{folder}/statistics")
    statistics = spark.read.parquet(f"{folder}/statistics")
    text = F.col("neg_text")
    watched, third = _observed(statistics, {"with_text": none_if_blank(text).isNotNull(), "enough_words": has_words(text, MIN_WORDS)})
    texts, fourth = _observed(aspect_input(watched), {"in_language": F.lit(True)})
    texts.drop(PASS).write.mode("overwrite").parquet(f"{folder}/aspect_texts")
    return Written(statistics.drop(PASS), spark.read.parquet(f"{folder}/aspect_texts"), _counts(spark, list(passes), [first, second, third, fourth]))


def _counts(spark: SparkSession, passes: list[str], watches: list[Observation]) -> DataFrame:
    """(pass, position, stage, rows), a row per pass and stage, in order."""
    rows = []
    for name in passes:
        stages = [(key.removeprefix(f"{name} "), n) for watch in watches for key, n in watch.get.items() if key.startswith(f"{name} ")]
        rows += [(name, position, stage, n) for position, (stage, n) in enumerate(stages)]
    return spark.createDataFrame(rows, "pass string, position int, stage string, rows long")

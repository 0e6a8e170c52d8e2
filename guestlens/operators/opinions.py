"""Opinion words learnt from texts of known polarity: the positive and the negative part of reviews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestlens.functions.text import words
from guestlens.operators.aspects import extract_phrases, phrase_terms

#: Added to every count, so that a word met on one side only has a finite weight.
SMOOTHING = 0.5
#: Words with fewer uses in all say too little.
LEAST_USES = 5
#: At most so many words of each polarity reach the extractor.
MOST_WORDS = 500


def opinion_weights(df: DataFrame, positive: str = "pos_text", negative: str = "neg_text", least: int = LEAST_USES) -> DataFrame:
    """Per word: its uses in positive and in negative texts, and the smoothed log odds between them, (word, positive, negative, weight).

    ln of the word's share of all words on the positive side over its share on the negative one; above zero it speaks for
    a positive text. Words are counted once, before the shuffle; missing texts count nothing.
    """
    sides = F.array(F.struct(F.lit(True).alias("good"), F.col(positive).alias("text")), F.struct(F.lit(False).alias("good"), F.col(negative).alias("text")))
    tokens = df.select(F.inline(sides)).where(F.col("text").isNotNull()).select("good", F.explode(words(F.col("text"))).alias("word"))
    counts = tokens.groupBy("word").agg(F.count_if("good").alias("positive"), F.count_if(~F.col("good")).alias("negative"))
    total = counts.agg(F.struct(F.sum("positive").alias("good"), F.sum("negative").alias("bad"), F.count(F.lit(1)).alias("kinds"))).scalar()

    def share(uses: str, side: str) -> Column:
        return (F.col(uses) + SMOOTHING) / (F.col(f"total.{side}") + SMOOTHING * F.col("total.kinds"))

    weight = F.log(share("positive", "good")) - F.log(share("negative", "bad"))
    return counts.withColumn("total", total).where(F.col("positive") + F.col("negative") >= least).select("word", "positive", "negative", weight.alias("weight"))


def opinion_words(weights: DataFrame, threshold: float = 1.0, most: int = MOST_WORDS, stems: Sequence[str] | None = None) -> tuple[list[str], list[str]]:
    """The positive and the negative words beyond the threshold, the strongest first, at most ``most`` of each.

    Words that name an aspect judge nothing, however often they are complained about.
    """
    things = "|".join(sorted(stems if stems is not None else phrase_terms()))
    usable = weights.where(~F.regexp_like("word", F.lit(things))) if things else weights

    def strongest(sign: int) -> list[str]:
        found = usable.where(F.col("weight") * sign >= threshold).orderBy(F.desc(F.col("weight") * sign), "word").limit(most)
        return [row["word"] for row in found.collect()]

    return strongest(1), strongest(-1)


def extract_learnt(df: DataFrame, weights: DataFrame, text: str = "neg_text", threshold: float = 1.0, most: int = MOST_WORDS) -> DataFrame:
    """``extract_phrases`` with the opinion words of a learnt table."""
    positive, negative = opinion_words(weights, threshold, most)
    return extract_phrases(df, text, positive=positive, negative=negative)

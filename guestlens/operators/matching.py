"""The best-ranked keyword inside a phrase, for dictionaries of many keywords.

An Aho-Corasick automaton reads a phrase once, whatever the number of keywords. A keyword that holds
a better-ranked one can never decide and is left out, so few keywords end at any one place.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

try:
    import ahocorasick
except ImportError:  # phrases are then joined by their substrings
    ahocorasick = None

#: Dictionaries of at most so many characters travel to the tasks; larger ones are joined.
AUTOMATON_CHARACTERS = 16_000_000

_built: dict[str, Automaton] = {}


class Automaton:
    """Smallest rank of the keywords inside a text, in one pass over it."""

    def __init__(self, ranks: Mapping[str, int]):
        whole = self._made(ranks)
        deciding = {k: r for k, r in ranks.items() if not any(x < r or (x == r and other != k) for _, (x, other) in whole.iter(k))} if ranks else {}
        self.found = self._made(deciding) if deciding else None

    @staticmethod
    def _made(ranks: Mapping[str, int]):
        made = ahocorasick.Automaton()
        for keyword, rank in ranks.items():
            made.add_word(keyword, (rank, keyword))
        made.make_automaton()
        return made

    def best(self, text: str) -> int | None:
        if self.found is None:
            return None
        return min((rank for _, (rank, _) in self.found.iter(text)), default=None)


def ranked_keywords(dictionary: DataFrame) -> DataFrame:
    """One row per keyword with its category of the smallest (priority, category); empty and missing keywords match nothing."""
    best = F.min(F.struct("priority", "category")).alias("best")
    return dictionary.where(F.char_length("keyword") > 0).groupBy("keyword").agg(best).select("keyword", "best.priority", "best.category")


def match_by_automaton(phrases: DataFrame, phrase: str, keywords: DataFrame, carry: str) -> DataFrame:
    """``phrase``, ``carry`` (a count) and ``aspect_category`` of the phrases with a keyword, in Arrow batches.

    All keywords come to the driver; the caller has checked their size.
    """
    rows = keywords.collect()
    order = sorted({(r["priority"], r["category"]) for r in rows})
    rank = {key: k for k, key in enumerate(order)}
    shared = keywords.sparkSession.sparkContext.broadcast({r["keyword"]: rank[r["priority"], r["category"]] for r in rows})
    names, key = [category for _, category in order], uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _built:  # once per worker
            _built.clear()
            _built[key] = Automaton(shared.value)
        find = _built[key].best
        for batch in batches:
            best = [find(text) for text in batch.column(0).to_pylist()]
            category = pa.array([None if k is None else names[k] for k in best], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), category], [phrase, carry, "aspect_category"])

    found = phrases.select(phrase, carry).mapInArrow(run, f"`{phrase}` string, `{carry}` long, aspect_category string")
    return found.where("aspect_category IS NOT NULL")


def match_by_join(phrases: DataFrame, phrase: str, keywords: DataFrame, carry: str) -> DataFrame:
    """The same without a bound on the dictionary: the substrings of each phrase meet the keywords in an equality join."""
    longest = keywords.agg(F.max(F.char_length("keyword"))).scalar()
    text = F.col(phrase)
    starts = phrases.withColumn("__longest", longest).withColumn("__from", F.explode(F.sequence(F.lit(1), F.greatest(F.char_length(text), F.lit(1)))))
    most = F.greatest(F.least(F.col("__longest"), F.char_length(text) - F.col("__from") + 1), F.lit(1))
    pieces = starts.withColumn("__size", F.explode(F.sequence(F.lit(1), most))).select(phrase, carry, F.substring(text, F.col("__from"), F.col("__size")).alias("keyword"))
    best = F.min(F.struct("priority", "category")).alias("__best")
    return pieces.join(keywords, "keyword").groupBy(phrase).agg(best, F.max(carry).alias(carry)).select(phrase, carry, F.col("__best.category").alias("aspect_category"))


def match(phrases: DataFrame, phrase: str, dictionary: DataFrame, carry: str, most: int = AUTOMATON_CHARACTERS) -> DataFrame:
    """Phrases with a keyword and the category of the best one, by the automaton for dictionaries of up to ``most`` characters."""
    keywords = ranked_keywords(dictionary)
    size = keywords.agg(F.sum(F.char_length("keyword").cast("long")).alias("n")).first()["n"] or 0
    if ahocorasick is None or size > most:
        return match_by_join(phrases, phrase, keywords, carry)
    return match_by_automaton(phrases, phrase, keywords, carry)

"""Aspect terms of complaints: extraction, categories, cross tables and bigrams."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guestlens.functions.labels import (
    ASPECT_KEYWORDS,
    BIGRAM_STOP_WORDS,
    CATEGORY_NAMES,
    OTHER_CATEGORY,
    WORD_TRANSLATIONS,
    aspect_category,
    lookup,
    translate,
)
from guestlens.functions.text import WORD_PATTERN, words
from guestlens.operators import matching
from guestlens.operators.dedup import first_by_key
from guestlens.plans.skew import hot_keys, lookup_join, row_salt

SENTIMENTS = ("NEGATIVE", "NEUTRAL", "POSITIVE")

# How many aspects of one review are matched against its text at a time.
LIST_SIZE = 64

# Opinion words of the built-in extractor.
POSITIVE_WORDS = (
    "amazing", "beautiful", "best", "bright", "calm", "clean", "comfortable", "comfy", "cosy", "delicious",
    "excellent", "fantastic", "fine", "fresh", "friendly", "good", "great", "helpful", "kind", "lovely", "modern",
    "nice", "perfect", "pleasant", "quiet", "spacious", "spotless", "super", "tasty", "wonderful",
)
NEGATIVE_WORDS = (
    "awful", "bad", "boring", "broken", "cold", "cramped", "damaged", "dark", "dirty", "disappointing", "expensive",
    "hard", "horrible", "leaky", "loud", "missing", "noisy", "old", "overpriced", "poor", "rude", "slow", "small",
    "smelly", "stained", "terrible", "uncomfortable", "unfriendly", "worn", "worst",
)
NEGATIONS = ("not", "no", "never", "without", "isn", "wasn", "aren", "weren", "didn", "don", "doesn", "hardly")


# Words that continue a phrase begun by an aspect word: "air conditioning", "room size".
COMPOUND_WORDS = ("area", "conditioner", "conditioning", "facilities", "machine", "option", "options", "size", "space", "system", "unit")


def phrase_terms(keywords: Mapping[str, Sequence[str]] = ASPECT_KEYWORDS) -> tuple[str, ...]:
    """Dictionary keywords and stems by which a word is known as an aspect: the ones that name a thing."""
    return tuple(dict.fromkeys(t for t in keyword_terms(keywords) if len(t) > 2))


def extract_phrases(
    df: DataFrame,
    text: str = "neg_text",
    stems: Sequence[str] | None = None,
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
    negations: Sequence[str] = NEGATIONS,
    compounds: Sequence[str] = COMPOUND_WORDS,
    reach: int = 3,
) -> DataFrame:
    """Adds ``aspect`` and ``sentiment`` by the rule of the categories: a word that contains a keyword is an aspect.

    So plurals and stems count ("beds", "amenities"). Adjacent aspect words are one phrase, which
    the ``compounds`` right after it continue. Opinion words are never aspects. The polarity is that of the
    phrase's first word. Narrow, like ``extract_aspects``.
    """
    stems = tuple(stems if stems is not None else phrase_terms())
    opinions = {*positive, *negative}
    tokens = F.col("__tokens")
    thing = F.transform(tokens, lambda w: F.regexp_like(w, F.lit("|".join(sorted(stems)))) & ~w.isin(*opinions))
    grown = (
        df.withColumn("__tokens", F.coalesce(words(F.col(text)), F.array().cast("array<string>")))
        .withColumn("__thing", thing)
        .withColumn("__part", F.transform(tokens, lambda w, i: F.get("__thing", i) | (w.isin(*compounds) & F.coalesce(F.get("__thing", i - 1), F.lit(False)))))
    )
    everywhere = F.when(F.size(tokens) > 0, F.sequence(F.lit(0), F.size(tokens) - 1)).otherwise(F.array().cast("array<int>"))
    begins = F.filter(everywhere, lambda i: F.get("__thing", i) & ~F.coalesce(F.get("__part", i - 1), F.lit(False)))
    ends = F.filter(everywhere, lambda i: F.get("__part", i) & ~F.coalesce(F.get("__part", i + 1), F.lit(False)))
    phrase = F.transform(F.arrays_zip(F.col("__begins").alias("a"), F.col("__ends").alias("b")), lambda s: F.array_join(F.slice(tokens, s["a"] + 1, s["b"] - s["a"] + 1), " "))
    marked = grown.withColumn("__begins", begins).withColumn("__ends", ends)
    return (
        marked.withColumn("aspect", phrase)
        .withColumn("sentiment", F.transform("__begins", lambda i: _polarity(tokens, i + 1, positive, negative, negations, reach)))
        .drop("__tokens", "__thing", "__part", "__begins", "__ends")
    )


def _polarity(tokens: Column, place: Column, positive: Sequence[str], negative: Sequence[str], negations: Sequence[str], reach: int) -> Column:
    """Sign of the opinion words at most ``reach`` words from ``place`` (from 1), turned round by a negation before them."""

    def opinion(i: Column) -> Column:
        word = F.element_at(tokens, i)
        base = F.when(word.isin(*positive), F.lit(1)).when(word.isin(*negative), F.lit(-1)).otherwise(F.lit(0))
        before = F.when(i > 1, F.element_at(tokens, F.greatest(i - 1, F.lit(1))))
        return F.when(F.coalesce(before.isin(*negations), F.lit(False)), -base).otherwise(base)

    span = F.sequence(F.greatest(place - reach, F.lit(1)), F.least(place + reach, F.size(tokens)))
    score = F.aggregate(span, F.lit(0), lambda acc, i: acc + opinion(i))
    return F.when(score > 0, F.lit("Positive")).when(score < 0, F.lit("Negative")).otherwise(F.lit("Neutral"))


def keyword_terms(keywords: Mapping[str, Sequence[str]] = ASPECT_KEYWORDS) -> tuple[str, ...]:
    """The dictionary's keywords that name a thing; opinion words judge things and are none."""
    opinions = {*POSITIVE_WORDS, *NEGATIVE_WORDS}
    terms = dict.fromkeys(k.strip() for ks in keywords.values() for k in ks)
    return tuple(t for t in terms if t not in opinions)


def extract_aspects(
    df: DataFrame,
    text: str = "neg_text",
    terms: Sequence[str] | None = None,
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
    negations: Sequence[str] = NEGATIONS,
    reach: int = 3,
) -> DataFrame:
    """Adds the arrays ``aspect`` and ``sentiment`` found in each text, in order of occurrence.

    A term's polarity is the sign of the opinion words at most ``reach`` words away,
    an opinion word turning round after a negation. Everything happens inside the
    row: no shuffle, and the cost grows with the text alone.
    """
    terms = tuple(terms if terms is not None else keyword_terms())

    tokens = F.col("__tokens")
    places = F.filter(
        F.when(F.size(tokens) > 0, F.sequence(F.lit(1), F.size(tokens))).otherwise(F.array().cast("array<int>")),
        lambda i: F.element_at(tokens, i).isin(*terms),
    )

    return (
        df.withColumn("__tokens", F.coalesce(words(F.col(text)), F.array().cast("array<string>")))
        .withColumn("__places", places)
        .withColumn("aspect", F.transform("__places", lambda i: F.element_at(tokens, i)))
        .withColumn("sentiment", F.transform("__places", lambda i: _polarity(tokens, i, positive, negative, negations, reach)))
        .drop("__tokens", "__places")
    )


def extract_aspects_with(
    df: DataFrame,
    model: Callable[[], Callable[[list[str]], Sequence[tuple[Sequence[str], Sequence[str]]]]],
    text: str = "neg_text",
) -> DataFrame:
    """The same two arrays from a caller's model, in Arrow batches.

    ``model`` is called once per task and returns a function from a list of texts to
    one (terms, polarities) pair per text. All columns travel with their text, so a
    result can never be matched to another row.
    """
    schema = T.StructType(
        [
            *df.schema.fields,
            T.StructField("aspect", T.ArrayType(T.StringType())),
            T.StructField("sentiment", T.ArrayType(T.StringType())),
        ]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = model()
        for batch in batches:
            known = batch[text].notna()
            results = iter(predict(batch.loc[known, text].tolist()))
            pairs = [next(results) if k else ([], []) for k in known]
            yield batch.assign(aspect=[list(p[0]) for p in pairs], sentiment=[list(p[1]) for p in pairs])

    return df.mapInPandas(run, schema)


def flatten_aspects(
    df: DataFrame, carry: Sequence[str] = ("source_id", "hotel_stars", "traveler_type")
) -> DataFrame:
    """One row per (review, aspect); the shorter of the two arrays decides, empty ones vanish."""
    length = F.least(F.size("aspect"), F.size("sentiment"))
    pairs = F.slice(F.arrays_zip("aspect", "sentiment"), 1, F.greatest(length, F.lit(0)))
    return df.select(*carry, F.explode(pairs).alias("pair")).select(
        *carry,
        F.lower("pair.aspect").alias("extracted_aspect"),
        F.upper("pair.sentiment").alias("sentiment"),
    )


def categorise(
    df: DataFrame,
    aspect: str = "extracted_aspect",
    keywords: Mapping[str, Sequence[str]] = ASPECT_KEYWORDS,
    names: Mapping[str, str] = CATEGORY_NAMES,
) -> DataFrame:
    """Adds the category of the fixed dictionary and its report name; a narrow step."""
    category = aspect_category(F.col(aspect), keywords)
    return df.withColumn("aspect_category", category).withColumn("category_name", lookup(F.col("aspect_category"), names))


def categorise_by_table(df: DataFrame, dictionary: DataFrame, aspect: str = "extracted_aspect", most: int = matching.AUTOMATON_CHARACTERS) -> DataFrame:
    """The same for a dictionary held in a table (priority, category, keyword); equal priorities go by category.

    Each distinct phrase is read once by an automaton of all keywords; its first category then
    returns to the rows. Dictionaries of more than ``most`` characters are joined instead.
    """
    phrases = (
        df.select(F.lower(F.col(aspect)).alias("__phrase"))
        .where(F.col("__phrase").isNotNull())
        .groupBy("__phrase")
        .agg(F.count(F.lit(1)).alias("__rows"))
    )
    found = matching.match(phrases, "__phrase", dictionary, "__rows", most)
    return (
        lookup_join(df.withColumn("__phrase", F.lower(F.col(aspect))), found, ["__phrase"], "__rows", spread=["__phrase"])
        .withColumn("aspect_category", F.coalesce("aspect_category", F.lit(OTHER_CATEGORY)))
        .drop("__phrase", "__rows")
    )


def negative_aspects(df: DataFrame) -> DataFrame:
    """Negative mentions with a real category."""
    return df.where((F.col("sentiment") == "NEGATIVE") & (F.col("aspect_category") != OTHER_CATEGORY))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts of row by column; the columns are listed, absent cells are 0."""
    return df.groupBy(row).pivot(column, list(values)).agg(F.count(F.lit(1))).na.fill(0)


def crosstab_share(df: DataFrame, row: str, column: str, values: Sequence[str], digits: int | None = None) -> DataFrame:
    """Percent of each column within its row; absent cells are 0.

    One shuffle: conditional counts divided by the count of the row.
    """
    total = F.count_if(F.col(column).isin(*values))

    def share(value: str) -> Column:
        part = F.coalesce(F.try_divide(F.count_if(F.coalesce(F.col(column) == value, F.lit(False))) * 100.0, total), F.lit(0.0))
        return (part if digits is None else F.round(part, digits)).alias(value)

    return df.groupBy(row).agg(total.alias("__total"), *(share(v) for v in values)).where("__total > 0").drop("__total")


def ranking(df: DataFrame, column: str) -> DataFrame:
    """Value counts, most frequent first, names in order among equals."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("mentions")).orderBy(F.desc("mentions"), column)


def attach_text(aspects: DataFrame, texts: DataFrame, key: str = "source_id", text: str = "neg_text", order: Sequence[Column] = ()) -> DataFrame:
    """Aspect rows with the first text of their review id; texts are shuffled once, one per id and task.

    The rank filter cuts the texts to one per id in every task, shuffles these by id, and the join finds them there. Rows of ids with
    more rows than an average task are dealt to slices, for which only these ids' texts are copied.
    """
    first = first_by_key(texts.where(F.col(key).isNotNull()), key, list(order) or [F.asc_nulls_last(text)]).select(key, text)
    counts = aspects.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
    hot = F.broadcast(hot_keys(counts, [key], "__rows"))  # at most as many ids as tasks
    marked = aspects.join(hot, key, "left")
    usual = marked.where("__slices IS NULL").drop("__slices").join(first, key, "left")
    dealt = marked.where("__slices IS NOT NULL").withColumn("__salt", row_salt(aspects, F.col("__slices"), [key])).drop("__slices")
    copies = first.join(hot, key).withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__slices") - 1))).drop("__slices")
    return usual.unionByName(dealt.join(copies, [key, "__salt"], "left").drop("__salt"))


def aspect_bigrams(
    aspects: DataFrame,
    texts: DataFrame,
    key: str = "source_id",
    text: str = "neg_text",
    aspect: str = "extracted_aspect",
    carry: Sequence[str] = ("aspect_category",),
    order: Sequence[Column] = (),
    stop_words: Sequence[str] = BIGRAM_STOP_WORDS,
    translations: Mapping[str, str] = WORD_TRANSLATIONS,
) -> DataFrame:
    """Neighbouring word pairs around each aspect: (key, carried columns, aspect, bigram, mentions).

    A pair counts when one of its words equals the aspect and neither is a stop word,
    once per aspect row of the review and per occurrence in the review's first text.

    Equal aspect rows are counted before they meet a text, and the distinct aspects of
    a review travel as lists of at most ``LIST_SIZE``. So a text is cut into words once
    per list, not once per aspect row, and work stays linear in the text. An aspect of
    several words equals no single word and is left out before the shuffle.
    """
    carry = list(carry)
    counted = (
        aspects.where(F.regexp_like(F.col(aspect), F.lit(f"^{WORD_PATTERN}$")) & F.col(key).isNotNull())
        .groupBy(key, F.lower(F.col(aspect)).alias("__aspect"), *carry)
        .agg(F.count(F.lit(1)).alias("__rows"))
    )
    place = F.row_number().over(Window.partitionBy(key).orderBy("__aspect", *carry))
    lists = (
        counted.withColumn("__list", F.floor((place - 1) / LIST_SIZE))
        .groupBy(key, "__list")
        .agg(
            F.collect_list(F.struct("__aspect", "__rows", *carry)).alias("__wanted"),
            F.collect_set("__aspect").alias("__words"),
        )
    )
    first = first_by_key(texts.where(F.col(key).isNotNull() & F.col(text).isNotNull()), key, list(order) or [F.asc_nulls_last(text)])
    tokens, wanted = F.col("__tokens"), F.col("__words")
    near = F.filter(
        F.when(F.size(tokens) > 1, F.sequence(F.lit(1), F.size(tokens) - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: (
            F.array_contains(wanted, F.element_at(tokens, i)) | F.array_contains(wanted, F.element_at(tokens, i + 1))
        )
        & ~F.element_at(tokens, i).isin(*stop_words)
        & ~F.element_at(tokens, i + 1).isin(*stop_words),
    )
    pairs = F.transform(
        near,
        lambda i: F.struct(F.element_at(tokens, i).alias("first"), F.element_at(tokens, i + 1).alias("second")),
    )
    left, right = F.col("__pair.first"), F.col("__pair.second")
    matching = F.filter("__wanted", lambda w: (w["__aspect"] == left) | (w["__aspect"] == right))
    return (
        lists.join(first.select(key, text), key)
        .withColumn("__tokens", words(F.col(text)))
        .select(key, "__wanted", F.explode(pairs).alias("__pair"))
        .select(key, "__pair", F.explode(matching).alias("__match"))
        .select(
            key,
            *(F.col(f"__match.{c}").alias(c) for c in carry),
            F.col("__match.__aspect").alias(aspect),
            F.concat(translate(left, translations), F.lit("-"), translate(right, translations)).alias("bigram"),
            F.col("__match.__rows").alias("__rows"),
        )
        .groupBy(key, *carry, aspect, "bigram")
        .agg(F.sum("__rows").alias("mentions"))
    )


def top_bigrams(df: DataFrame, category: str = "aspect_category", limit: int = 30) -> DataFrame:
    """The most frequent bigrams of each category; each task cuts its candidates before they meet."""
    counted = df.groupBy(category, "bigram").agg(F.sum("mentions").alias("mentions"))
    order = Window.partitionBy(category).orderBy(F.desc("mentions"), "bigram")
    return counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= limit)

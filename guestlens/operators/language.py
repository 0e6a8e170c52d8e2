"""Language of a text by its character n-grams.

A profile holds, per language, how often each run of one to three characters occurs in the words of sample
texts, a word standing between two spaces. A text's score for a language is the sum of its grams' smoothed log frequencies, in whole thousandths, so
that no order of summation changes a result. The grams of a word depend on the word alone: texts are cut into words
in Arrow batches, and only a batch's distinct words are scored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guestlens.functions.seed_texts import SEED_TEXTS

SIZES = (1, 2, 3)
#: Share of a language's frequency that is spread over all grams of a size.
SPREAD = 0.05
#: At most so many grams of a language enter a profile, the most frequent ones of each size first.
PROFILE_SIZE = 20_000
#: Distinct words that are scored at once.
TOGETHER = 8_192
#: Texts of about so many bytes are cut into words at once when a profile is trained.
SLICE_BYTES = 1 << 20
#: Characters of distinct words that a training task holds before it cuts them into grams.
HELD_CHARS = 1 << 20
#: The language of a text with letters of which no gram is known.
UNKNOWN = "other"
BETWEEN_WORDS = r"[^\p{L}\p{M}]+"


def grams(word: str) -> list[str]:
    """Runs of characters of " word " of the sizes used; a single character is a letter, never a space."""
    padded = f" {word} "
    return [g for n in SIZES for g in (word if n == 1 else (padded[i : i + n] for i in range(len(padded) - n + 1)))]


def coded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The row of every word, its number, and the distinct words by number; letters are lowered."""
    lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), BETWEEN_WORDS)
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    solid = pc.greater(pc.binary_length(flat), 0)
    coded = flat.filter(solid).dictionary_encode()
    rows = parent.filter(solid).to_numpy(zero_copy_only=False)
    return rows, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


class Profile:
    """Weights of grams by language, in thousandths, from (language, gram, count).

    Grams are numbers made of their characters' places in the profile's alphabet; those of a size are
    sorted, and one column more holds the weights of an unknown one; each language has a row.
    """

    def __init__(self, counts: Iterable[tuple[str, str, int]]):
        rows = sorted(counts)
        self.languages = tuple(sorted({code for code, _, _ in rows}))
        place = {code: k for k, code in enumerate(self.languages)}
        self.alphabet = np.array(sorted({ord(c) for _, gram, _ in rows for c in gram} | {ord(" ")}))
        self.codes, self.weights = {}, {}
        for size in SIZES:
            own = [r for r in rows if len(r[1]) == size]
            chars = np.array([[ord(c) for c in gram] for _, gram, _ in own], np.int64).reshape(-1, size)
            codes, number = np.unique(self._codes(np.searchsorted(self.alphabet, chars) + 1), return_inverse=True)
            seen = np.zeros((len(codes), len(self.languages)))
            np.add.at(seen, (number, [place[code] for code, _, _ in own]), [n for _, _, n in own])
            share = np.vstack([seen / np.maximum(seen.sum(0), 1), np.zeros(len(self.languages))])
            self.codes[size] = codes
            weights = np.rint(1000 * np.log((1 - SPREAD) * share + SPREAD / max(1, len(codes)))).astype(np.int32)
            self.weights[size] = np.ascontiguousarray(weights.T)

    @staticmethod
    def _codes(places: np.ndarray) -> np.ndarray:
        """Numbers of rows of places, from 1 on; rows with a place 0, an unknown character, get -1."""
        out = np.zeros(len(places), np.int64)
        for k in range(places.shape[1]):
            out = (out << 21) + places[:, k]
        return np.where((places == 0).any(1), -1, out)

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The scores of all words, a row for each language, and whether any gram of a word is known."""
        scores, known = np.zeros((len(self.languages), len(words)), np.int64), np.zeros(len(words), bool)
        for low in range(0, len(words), TOGETHER):  # bounds the gathered weights
            some = words[low : low + TOGETHER]
            signs = np.frombuffer(f" {' '.join(some)} ".encode("utf-32-le"), np.uint32)
            at = np.minimum(np.searchsorted(self.alphabet, signs), len(self.alphabet) - 1)
            places = np.where(self.alphabet[at] == signs, at + 1, 0)
            space = signs == 32
            owner = np.cumsum(space) - 1  # the word that a place, or the space before it, belongs to
            for size in SIZES:
                runs = np.lib.stride_tricks.sliding_window_view(places, size)
                # a run lies in one padded word if none but its ends is a space
                inner = np.lib.stride_tricks.sliding_window_view(space, size)
                fits = ~inner[:, 1:-1].any(1) if size > 1 else ~space
                first = owner[: len(runs)][fits]
                code = self._codes(runs[fits])
                found = np.minimum(np.searchsorted(self.codes[size], code), max(0, len(self.codes[size]) - 1))
                hit = self.codes[size][found] == code if len(self.codes[size]) else np.zeros(len(code), bool)
                heads = np.flatnonzero(np.append(True, first[1:] != first[:-1])[: len(first)])
                if len(heads):
                    word = low + first[heads]
                    gram = np.where(hit, found, len(self.codes[size]))
                    for own, weights in zip(scores, self.weights[size], strict=True):
                        own[word] += np.add.reduceat(weights[gram], heads, dtype=np.int64)
                    known[word] |= np.add.reduceat(hit.astype(np.int64), heads) > 0
        return scores, known

    def languages_of(self, texts: pa.Array) -> pa.Array:
        """The best language of each text, the first by name of equal ones; null without a letter."""
        rows, words, distinct = coded_words(texts)
        best = np.full(len(texts), len(self.languages) + 1)
        if len(words):
            scores, known = self.word_scores(distinct)
            heads = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
            total = np.array([np.add.reduceat(own[words], heads) for own in scores]).reshape(len(self.languages), len(heads))
            hit = np.add.reduceat(known[words].astype(np.int64), heads) > 0
            best[rows[heads]] = np.where(hit, total.argmax(0) if self.languages else 0, len(self.languages))
        return pa.array([*self.languages, UNKNOWN, None], pa.string()).take(pa.array(best))


@lru_cache(maxsize=1)
def built_in() -> Profile:
    """The profile of the built-in sample texts."""
    counts: Counter[tuple[str, str]] = Counter()
    for code, text in SEED_TEXTS.items():
        _, words, distinct = coded_words(pa.array([text]))
        for word, n in zip(distinct, np.bincount(words), strict=True):
            for gram in grams(word):
                counts[code, gram] += int(n)
    return Profile((code, gram, n) for (code, gram), n in counts.items())


def language_of(text: Column, profile: Profile | None = None) -> Column:
    """The language of a text; null only for texts without letters.

    A narrow step over Arrow batches; the profile, whose size is bounded, travels with the function.
    """

    @F.arrow_udf("string")
    def found(texts: pa.Array) -> pa.Array:
        return (profile or built_in()).languages_of(texts)

    return found(text)


def detect_language(df: DataFrame, text: str, profile: Profile | None = None, column: str = "language") -> DataFrame:
    """Adds the language of a text."""
    return df.withColumn(column, language_of(F.col(text), profile))


def filter_language(df: DataFrame, text: str, code: str = "en", profile: Profile | None = None) -> DataFrame:
    """Rows in the given language. Empty, missing and undetectable texts are kept."""
    return df.where(F.coalesce(language_of(F.col(text), profile) == code, F.lit(True)))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows of about SLICE_BYTES of text in the second column; only a longer text makes a longer one."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    row = 0
    while row < batch.num_rows:
        last = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + SLICE_BYTES, "right")))
        yield batch.slice(row, last - row)
        row = last


def _gram_batches(words: dict[tuple[str, str], int]) -> Iterator[pa.RecordBatch]:
    """The gram counts of counted (language, word)."""
    counts: Counter[tuple[str, str]] = Counter()
    for (code, word), n in words.items():
        padded = f" {word} "
        for size in SIZES:
            own = word if size == 1 else padded
            for i in range(len(own) - size + 1):
                counts[code, own[i : i + size]] += n
    rows = iter(counts.items())
    while some := list(islice(rows, TOGETHER)):
        columns = [[code for (code, _), _ in some], [gram for (_, gram), _ in some], [n for _, n in some]]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)], ["language", "gram", "n"])


def train_profile(df: DataFrame, text: str, label: str, size: int = PROFILE_SIZE) -> DataFrame:
    """Gram counts of the labelled texts: (language, gram, n), at most ``size`` grams of each length and language.

    Every task counts its words per language, slice by slice of a batch, and cuts them into grams whenever it holds
    HELD_CHARS characters of them, so that a worker's memory does not grow with its batches, its rows or the vocabulary. The rank
    filter cuts each language per task, too. Rows without a label or text count nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chars = {}, 0
        for batch in batches:
            for part in _slices(batch):
                labels = part.column(0).dictionary_encode()
                codes = labels.indices.to_numpy(zero_copy_only=False)
                names = labels.dictionary.to_pylist()
                rows, words, distinct = coded_words(part.column(1))
                pairs, times = np.unique(codes[rows].astype(np.int64) * max(1, len(distinct)) + words, return_counts=True)
                for pair, n in zip(pairs.tolist(), times.tolist(), strict=True):
                    code, word = divmod(pair, len(distinct))
                    key = names[code], distinct[word]
                    before = held.get(key, 0)
                    held[key] = before + n
                    if not before:
                        chars += len(key[1])
                        if chars >= HELD_CHARS:
                            yield from _gram_batches(held)
                            held, chars = {}, 0
        yield from _gram_batches(held)

    labelled = df.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(F.col(label).cast("string"), text)
    counted = labelled.mapInArrow(run, "language string, gram string, n long").groupBy("language", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("language", F.char_length("gram")).orderBy(F.desc("n"), "gram")
    return counted.withColumn("__place", F.row_number().over(order)).where(F.col("__place") <= size).drop("__place")


def collect_profile(trained: DataFrame) -> Profile:
    """A trained table as a profile; as many rows come to the driver as ``size`` and the number of languages allow."""
    return Profile((r["language"], r["gram"], r["n"]) for r in trained.collect())


def accuracy(df: DataFrame, label: str, found: str = "language") -> DataFrame:
    """Per label: rows, rows found in it, rows without a language, and the share of right ones among the others."""
    hits = F.count_if(F.col(found) == F.col(label))
    named = F.count_if(F.col(found).isNotNull())
    return (
        df.where(F.col(label).isNotNull())
        .groupBy(label)
        .agg(F.count(F.lit(1)).alias("texts"), hits.alias("hits"), F.count_if(F.col(found).isNull()).alias("undetected"), F.try_divide(hits.cast("double"), named).alias("share"))
    )

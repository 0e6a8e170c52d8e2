"""Words and word shingles as Spark expressions, for the operators that use SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
SPLIT = "[\\x20\\x09-\\x0D]+"


def word_list(text: Column) -> Column:
    """The words of a text in order; none for a null or blank one."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPLIT))


def shingle_hashes(words: Column, size: int) -> Column:
    """A hash of every ``size`` consecutive words, with repeats; shorter sequences are one shingle, empty ones none."""
    each = F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))
    return F.when(F.size(words) >= size, each).when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))

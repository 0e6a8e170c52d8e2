"""Importance resampling of documents towards a target: hashed n-gram features, log-ratio gains, Gumbel draws.

Texts are cut by Arrow kernels: ASCII letters are lowered, texts split at everything that is not a
letter, digit or non-ASCII character, the word lists flattened and dictionary-encoded. N-grams are
formed from shifted dictionary indices; only distinct pairs of (gram, next word) get a CRC, continued from
the gram's own. A document's weight is the sum, over its features, of the gains of their buckets, taken by
index and added by segments.

The corpus is counted in a first pass (a row per bucket and task, added by Spark) and weighed in a second; what
the driver holds is one number per bucket. The draw is one range sort of narrow rows, whose places are numbered
from the partitions' sizes, so no task ranks the table.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from guestlens.llm.frames import stored

APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Texts are cut in runs of rows of about so many bytes; a longer text is a run of its own.
TOGETHER = 4 << 20


@dataclass(frozen=True)
class Draw:
    """Features are runs of 1 to ``longest`` words in ``buckets``; ``percent`` of the documents with ``least`` words are drawn."""

    longest: int = 1
    buckets: int = 10_000
    least: int = 20
    percent: int = 10
    seed: int = 2024


@dataclass
class Features:
    """Words of each row, and for each gram length the rows and buckets of its features, rows ascending."""

    words: np.ndarray
    rows: list[np.ndarray]
    buckets: list[np.ndarray]


def row_runs(texts: pa.Array, limit: int = TOGETHER) -> Iterator[tuple[int, pa.Array]]:
    """Runs of whole rows of about ``limit`` bytes, with their first row; null texts are empty."""
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    row = 0
    while row < len(texts):
        before = ends[row - 1] if row else 0
        last = max(row + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield row, texts.slice(row, last - row)
        row = last


def features(texts: pa.Array, rule: Draw) -> Features:
    """The hashed features of some texts without nulls."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), APART)
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    solid = pc.greater(pc.binary_length(flat), 0)  # a text that begins or ends with a separator has an empty part there
    row = parent.filter(solid).to_numpy(zero_copy_only=False)
    coded = flat.filter(solid).dictionary_encode()
    word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    strings = [w.encode() for w in coded.dictionary.to_pylist()]
    crc = np.array([zlib.crc32(w) for w in strings], np.int64)
    out = Features(np.bincount(row, minlength=len(texts)), [row], [crc[word] % rule.buckets])
    gram = word
    for size in range(2, rule.longest + 1):
        whole = row[size - 1 :] == row[: len(row) - size + 1]
        pair = gram[: len(whole)] * max(1, len(strings)) + word[size - 1 :]
        distinct, kind = np.unique(pair[whole], return_inverse=True)
        heads, tails = np.divmod(distinct, max(1, len(strings)))
        crc = np.array([zlib.crc32(b" " + strings[t], int(crc[h])) for h, t in zip(heads, tails, strict=True)], np.int64)
        gram = np.zeros(len(whole), np.int64)
        gram[whole] = kind
        out.rows.append(row[: len(whole)][whole])
        out.buckets.append(crc[kind] % rule.buckets)
    return out


def bucket_counts(texts: DataFrame, rule: Draw = Draw()) -> np.ndarray:
    """How many features of all texts fall into each bucket; repeats count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(rule.buckets, np.int64)
        for batch in batches:
            for _, part in row_runs(batch.column(0)):
                for buckets in features(part, rule).buckets:
                    total += np.bincount(buckets, minlength=rule.buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["bucket", "n"])

    parts = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(rule.buckets, np.int64)
    for row in parts.collect():  # one row per bucket
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of every bucket, for B buckets."""
    size, s_all, t_all = float(len(source)), float(source.sum()), float(target.sum())
    ratios = [(t + 1.0) * (s_all + size) / ((s + 1.0) * (t_all + size)) for s, t in zip(source.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, rule: Draw = Draw()) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in row_runs(batch.column(1)):
                found = features(part, rule)
                count, weight = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
                for row, bucket in zip(found.rows, found.buckets, strict=True):
                    heads = np.flatnonzero(np.append(True, row[1:] != row[:-1])[: len(row)])
                    if len(heads):
                        weight[row[heads]] += np.add.reduceat(shared.value.take(bucket), heads)
                    count += np.bincount(row, minlength=len(part))
                columns = [batch.column(0).slice(first, len(part)), *(pa.array(x, pa.int64()) for x in (found.words, count, weight))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def ranked(docs: DataFrame, target: DataFrame, rule: Draw = Draw()) -> DataFrame:
    """Per row of ``docs``: doc_id, n_features, weight, score and rank (null where not drawn).

    The score is the weight plus a Gumbel number fixed by the seed and the doc_id. Of the N rows with an id and at
    least ``rule.least`` words the floor(percent N / 100) highest scores are drawn, ties by smaller id, and
    numbered from 1. Null and wordless texts have no features and weight 0; rows without doc_id have no score and
    are never drawn; repeated rows have equal scores and are drawn one by one; empty tables give no rows, an empty
    target plain smoothed counts; other columns are not read.
    """
    gain = gains(bucket_counts(docs, rule), bucket_counts(target, rule))
    rows = weighed(docs, gain, rule)
    digits = F.substring(F.sha2(F.concat(F.lit(f"{rule.seed}:"), F.col("doc_id").cast("string")), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    fit = F.col("doc_id").isNotNull() & (F.col("n_words") >= rule.least)
    rows = stored(rows.withColumn("score", F.col("weight") + noise).withColumn("fit", fit).drop("n_words"))
    drawn = rows.where("fit").count() * rule.percent // 100
    order = rows.orderBy(F.desc("fit"), F.desc("score"), F.asc("doc_id"))
    # the number holds the sorted partition and the place in it
    placed = stored(order.withColumn("place", F.monotonically_increasing_id()))
    part, place = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    rank = F.col("before") + place + 1
    numbered = placed.withColumn("part", part).join(F.broadcast(before), "part")  # a row per sorted partition
    return numbered.select("doc_id", "n_features", "weight", "score", F.when(F.col("fit") & (rank <= drawn), rank).alias("rank"))


def resampled(docs: DataFrame, target: DataFrame, rule: Draw = Draw()) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns; rows of one doc_id are drawn together if any of them is."""
    drawn = ranked(docs, target, rule).where("rank IS NOT NULL").select(F.col("doc_id").alias("__drawn")).distinct()
    return docs.join(drawn, docs["doc_id"].cast("long") == drawn["__drawn"], "left_semi")

"""Periodic runs of words: maximal stretches that repeat with a smallest period at least three times.

Texts of a slice are laid one after another, each closed by a sign of its own, so that no run
crosses texts. Prefix doubling gives every place a rank for each power of two; equal ranks mean equal
words, and places with one rank are an interval of the suffix array.

A run of period q holds an aligned block of L words (L the largest power of two not above q) whose copy q words on
lies in the run too. So each block asks a wavelet tree over the suffix array for its
next occurrences in the window of distances [L, 2L). These form a progression; one or two members are candidates
themselves, of a longer one the period r is a period of the block, and only the distances of
the two r-periodic stretches' starts and ends can be smallest periods. Every candidate is extended to both sides by the
ranks; stretches long enough stay, each with its smallest period. Blocks of eight words find the periods below eight.

Documents are independent, so this is one narrow Spark step without a shuffle; a task holds a slice of about a megabyte of texts, or
one longer text, with some 250 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestlens.llm import textbytes as tb
from guestlens.llm.shingles import word_list

LEAST = 24
TIMES = 3
RUN = "struct<start:long,length:long,period:long>"


def codes_of(part: tb.Slice, found: tb.Words) -> tuple[np.ndarray, pa.Array]:
    """A number for every word of a slice, and the words themselves as an Arrow column."""
    offsets = np.concatenate([[0], np.cumsum(found.ends - found.starts)]).astype(np.int64)
    column = pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(part.data[~tb.WHITE[part.data]])])
    return column.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64), column


class PrefixRanks:
    """Ranks of all places by their first 1, 2, 4, ... signs, up to ``reach`` signs.

    A rank is the number of places that sort before, so places of rank r fill the suffix array from r on.
    """

    def __init__(self, signs: np.ndarray, reach: int):
        n = len(signs)
        rank = (np.cumsum(counts := np.bincount(signs)) - counts)[signs]
        self.levels, self.sizes = [rank.astype(np.int32)], []
        while True:
            sizes = np.bincount(rank, minlength=n)
            self.sizes.append(sizes.astype(np.int32))
            step = 1 << (len(self.levels) - 1)
            active = np.flatnonzero(sizes[rank] > 1)
            if 2 * step > reach or not len(active):
                break
            after = np.zeros(len(active), np.int64)
            inside = active + step < n
            after[inside] = rank[active[inside] + step] + 1
            key = rank[active] * (n + 1) + after
            order = np.argsort(key)
            key, place = key[order], active[order]
            owner = rank[place]
            index = np.arange(len(key))
            group = np.maximum.accumulate(np.where(np.append(True, key[1:] != key[:-1]), index, 0))
            head = np.maximum.accumulate(np.where(np.append(True, owner[1:] != owner[:-1]), index, 0))
            rank = rank.copy()
            rank[place] = owner + group - head
            self.levels.append(rank.astype(np.int32))
        self.order = np.argsort(rank, kind="stable")

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many signs from i on equal those from j on."""
        return self._common(i, j, 1)

    def back(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many signs up to i, going left, equal those up to j."""
        return self._common(i, j, -1)

    def _common(self, i: np.ndarray, j: np.ndarray, way: int) -> np.ndarray:
        done = np.zeros(len(i), np.int64)
        top = len(self.levels) - 1
        for level in [top, *range(top, -1, -1)]:
            rank, step = self.levels[level], 1 << level
            shift = 0 if way > 0 else 1 - step
            while True:
                a, b = i + way * done + shift, j + way * done + shift
                fits = (np.minimum(a, b) >= 0) & (np.maximum(a, b) < len(rank))
                fits[fits] = rank[a[fits]] == rank[b[fits]]
                done[fits] += step
                if level < top or not fits.any():
                    break
        return done


class WaveletTree:
    """Counts and order statistics of the values in intervals of an array, for many intervals at once."""

    def __init__(self, values: np.ndarray):
        self.bits = len(values).bit_length()
        self.zeros = []
        for bit in reversed(range(self.bits)):
            low = (values >> bit) & 1 == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(low)]).astype(np.int32))
            values = np.concatenate([values[low], values[~low]])

    def below(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of [low, high) are under x."""
        out = np.zeros(len(low), np.int64)
        for zeros, bit in zip(self.zeros, reversed(range(self.bits)), strict=True):
            a, b = zeros[low], zeros[high]
            one = (x >> bit) & 1 == 1
            out += np.where(one, b - a, 0)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return out

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value of [low, high), from 0."""
        out = np.zeros(len(low), np.int64)
        for zeros, bit in zip(self.zeros, reversed(range(self.bits)), strict=True):
            a, b = zeros[low], zeros[high]
            one = k >= b - a
            k = np.where(one, k - (b - a), k)
            out += one.astype(np.int64) << bit
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return out


@dataclass
class _Occurrences:
    """Blocks with a later occurrence in their window: the first, second and last one, and how many."""

    block: np.ndarray
    first: np.ndarray
    second: np.ndarray
    last: np.ndarray
    count: np.ndarray


def _successors(ranks: PrefixRanks, tree: WaveletTree, level: int, near: int, far: int) -> _Occurrences:
    """Occurrences of the aligned blocks of a level at distances [near, far)."""
    n, size = len(ranks.order), 1 << level
    block = np.arange(0, n - size + 1, size)
    low = ranks.levels[level][block].astype(np.int64)
    high = low + ranks.sizes[level][low]
    many = high - low > 1
    block, low, high = block[many], low[many], high[many]
    before = tree.below(low, high, np.minimum(block + near, n))
    count = tree.below(low, high, np.minimum(block + far, n)) - before
    some = count > 0
    block, low, high, before, count = block[some], low[some], high[some], before[some], count[some]
    place = [tree.smallest(low, high, before + k) for k in (0, np.minimum(count, 2) - 1, count - 1)]
    return _Occurrences(block, *place, count)


def _candidates(ranks: PrefixRanks, found: _Occurrences) -> tuple[np.ndarray, np.ndarray]:
    """Blocks and the distances that can be a smallest period."""
    few = found.count < 3
    blocks = [found.block[few], found.block[found.count == 2]]
    periods = [found.first[few] - blocks[0], found.second[found.count == 2] - blocks[1]]
    block, place = found.block[~few], found.first[~few]
    r = found.second[~few] - place
    starts = [x - ranks.back(x - 1, x + r - 1) for x in (block, place)]
    ends = [x + r + ranks.ahead(x, x + r) for x in (block, place)]
    for one, other in (starts, ends):
        apart = other > one
        blocks.append(block[apart])
        periods.append((other - one)[apart])
    return np.concatenate(blocks), np.concatenate(periods)


def find_runs(signs: np.ndarray, longest: int, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period.

    A run is at least ``least`` signs and ``times`` periods long. ``longest`` is the length of the
    longest text; no period is above a ``times``-th of it.
    """
    if times < 3 or least < 5:
        raise ValueError("runs are found from three periods and five words on")
    base = int(np.log2((least + 1) / 3))
    widest = longest // times
    if longest < least or not widest:
        return np.zeros((0, 3), np.int64)
    ranks = PrefixRanks(signs, max(1 << base, widest))
    if len(ranks.levels) <= base:  # no base block occurs twice
        return np.zeros((0, 3), np.int64)
    tree = WaveletTree(ranks.order)
    blocks, periods = [], []
    for level in range(base, len(ranks.levels)):
        if level == base:  # a block at least as long as the period occurs next just one period on
            short = _successors(ranks, tree, level, 1, 1 << level)
            blocks.append(short.block)
            periods.append(short.first - short.block)
        b, q = _candidates(ranks, _successors(ranks, tree, level, 1 << level, 2 << level))
        blocks.append(b)
        periods.append(q)
    block, period = np.concatenate(blocks), np.concatenate(periods)
    start = block - ranks.back(block - 1, block + period - 1)
    length = block + period + ranks.ahead(block, block + period) - start
    kept = length >= np.maximum(least, times * period)
    start, length, period = start[kept], length[kept], period[kept]
    order = np.lexsort((period, length, start))
    rows = np.stack([start, length, period], 1)[order]
    # a stretch found with several periods keeps the smallest, of which the others are multiples
    new = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(1))[: len(rows)]
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _slice_runs(part: tb.Slice, least: int, times: int) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Words of each text, its runs as a list column, and its text without the repeats of runs."""
    found = tb.words(part)
    codes, column = codes_of(part, found)
    counts = np.diff(found.first)
    texts = len(counts)
    row = np.repeat(np.arange(texts), counts)
    signs = np.empty(len(codes) + texts, np.int64)
    signs[np.arange(len(codes)) + row] = codes
    ends = found.first[1:] + np.arange(texts)
    signs[ends] = codes.max(initial=-1) + 1 + np.arange(texts)
    runs = find_runs(signs, int(counts.max(initial=0)), least, times)
    owner = np.searchsorted(ends, runs[:, 0])
    runs[:, 0] -= owner  # word numbers of the slice
    change = np.zeros(len(codes) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(change[:-1]) == 0
    sums = np.concatenate([[0], np.cumsum(kept)])[found.first]
    lists = pa.ListArray.from_arrays(pa.array(sums, pa.int32()), column.filter(pa.array(kept)))
    collapsed = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())
    runs[:, 0] -= found.first[owner]
    structs = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in range(3)], ["start", "length", "period"])
    cuts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=texts))])
    return counts, pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), structs), collapsed


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, ``runs`` (start, length, period; by start, period) and ``collapsed``.

    ``collapsed`` is the text with one space between words and without the words that a run holds after
    its first period. Null and blank texts have no words, no runs and an empty ``collapsed``; rows
    without doc_id keep a null one; repeated rows are treated alike, one by one; an empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.slices(batch.column(1)):
                counts, runs, collapsed = _slice_runs(part, least, times)
                ids = batch.column(0).slice(part.first, len(part))
                yield pa.RecordBatch.from_arrays([ids, pa.array(counts, pa.int64()), runs, collapsed], ["doc_id", "n_words", "runs", "collapsed"])

    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    return narrow.mapInArrow(run, f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; documents whose id's crc32 is a multiple of ten repeat their words from some place on.

    With h the crc32 of the id's digits, g = floor(h / 10) and n words: word i from a = g % n on becomes word
    a + (i - a) % p, where p = 1 + floor((n - a) / (3 + g % 8)). Other texts, and rows without an id, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = docs.select(F.col("doc_id").cast("long"), "text", h.alias("h")).withColumn("ws", F.when(F.col("h") % 10 == 0, word_list(F.col("text"))))
    n, g = F.size("ws"), F.floor(F.col("h") / 10)
    parts = words.withColumn("n", n).withColumn("a", F.when(F.col("n") > 0, g % F.col("n")).cast("int"))
    parts = parts.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8))).cast("int"))

    def word(i: Column) -> Column:
        return F.get("ws", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")))

    changed = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), word), " ")
    return parts.select("doc_id", F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias("text"))


def run_digest(docs: DataFrame) -> DataFrame:
    """The runs of ``planted`` documents in short: their number, the one of greatest length / period, and digests."""
    found = periodic_runs(planted(docs))
    none = F.lit(None).cast(RUN)
    # the list is by start, then period, so the first of equally great runs stays
    best = F.aggregate("runs", none, lambda a, r: F.when(a.isNull() | (r.length * a.period > a.length * r.period), r).otherwise(a))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

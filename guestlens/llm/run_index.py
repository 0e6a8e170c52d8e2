"""Repeated byte strings: a run-length index of the repetitive parts of a corpus.

Places where a string of ``window`` bytes can recur are found by ``anchors``; copies whose
surroundings are equal everywhere are settled there. Where contexts of an anchor differ, the first
of every equal ones is indexed, later ones are wholly repeated: shard by shard they get a run-compressed Burrows-Wheeler transform
with text positions and match lengths sampled at the ends of its runs. Within a run the
matching statistics of the next text position follow from the last one, so one sweep over the
text streams them from the samples. Long matches are marked, except a string's first place.

An anchor with more different contexts than a shard holds is too common to tell places apart. Each of its
windows then is an anchor of its own, whose context is always the same and settled by the first place. That
takes as many rows as the contexts have windows, at most ``window`` - ``GRAM`` + 1 for each, whatever the anchor's uses.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from guestlens.llm import textbytes as tb
from guestlens.llm.anchors import Units, by_document, contexts, covered, repeated
from guestlens.llm.frames import stored

WINDOW, GRAM = 100, 20
SHARD_ROWS = 8192
_END = 0xFF


class RunIndex:
    """Run-compressed transform of ``pieces``, each ended by a separator of its own."""

    def __init__(self, pieces: list[bytes]):
        sizes = np.array([len(p) for p in pieces], np.int64)
        self.data = np.frombuffer(b"".join(p + b"\xff" for p in pieces), np.uint8)
        self.begins = np.cumsum(sizes + 1) - sizes - 1
        self.sizes = sizes
        n = len(self.data)
        self.ends = np.repeat(self.begins + sizes, sizes + 1)
        self._order(int(sizes.max(initial=0)) + 1)
        before = self.data[self.suffixes - 1]
        new = np.ones(n, bool)
        new[1:] = (before[1:] != before[:-1]) | (before[1:] == _END)
        self.run_heads = np.flatnonzero(new)
        self.run_chars = before[self.run_heads]
        run_tails = np.append(self.run_heads[1:], n) - 1
        self.head_places = self.suffixes[self.run_heads]
        self.tail_places = self.suffixes[run_tails]
        self.head_lengths = self._common(self.head_places, self.suffixes[np.maximum(self.run_heads - 1, 0)], self.run_heads > 0)
        self.tail_lengths = self._common(self.tail_places, self.suffixes[np.minimum(run_tails + 1, n - 1)], run_tails < n - 1)

    def _order(self, longest: int) -> None:
        """Suffix order by doubling from eight bytes; a separator compares by its piece."""
        n = len(self.data)
        wide = np.concatenate([self.data, np.zeros(8, np.uint8)])
        left = self.ends - np.arange(n)
        key = np.zeros(n, np.uint64)
        for k in range(8):
            byte = np.where(left >= k, wide[k : k + n], 0).astype(np.uint64)
            key |= byte << np.uint64(8 * (7 - k))
        self.eight = key
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
        piece = np.repeat(np.arange(len(self.sizes)), self.sizes + 1)
        rank = np.unique(rank * (len(self.sizes) + 1) + np.where(left < 8, piece + 1, 0), return_inverse=True)[1]
        self.ranks = [(8, rank)]
        step = 8
        while step < longest:
            after = np.zeros(n, np.int64)
            after[: n - step] = rank[step:] + 1
            after[left < step] = 0
            rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1]
            step *= 2
            self.ranks.append((step, rank))
        self.suffixes = np.empty(n, np.int64)
        self.suffixes[rank] = np.arange(n)

    def _common(self, a: np.ndarray, b: np.ndarray, there: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``a`` and ``b``, within their pieces."""
        n = len(self.data)
        length = np.zeros(len(a), np.int64)
        for step, rank in reversed(self.ranks):
            x, y = np.minimum(a + length, n - 1), np.minimum(b + length, n - 1)
            length += np.where((rank[x] == rank[y]) & (x != y), step, 0)
        x, y = np.minimum(a + length, n - 1), np.minimum(b + length, n - 1)
        differ = self.eight[x] ^ self.eight[y]
        equal = np.zeros(len(a), np.int64)
        for k in range(1, 8):
            equal += (differ >> np.uint64(64 - 8 * k)) == 0
        length += equal
        return np.where(there, np.minimum(length, np.minimum(self.ends[a] - a, self.ends[b] - b)), 0)

    def _streamed(self, places: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Match lengths at all text positions from those at the sampled ones."""
        sampled = np.full(len(self.data), -1, np.int64)
        sampled[places] = np.arange(len(places))
        at = np.where(sampled >= 0, np.arange(len(self.data)), 0)
        last = np.maximum.accumulate(at)
        return np.maximum(lengths[sampled[last]] - (np.arange(len(self.data)) - last), 0)

    def repeats(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions with a match of ``window`` bytes elsewhere, and the first position of each one's string."""
        back = self._streamed(self.head_places, self.head_lengths)
        forth = self._streamed(self.tail_places, self.tail_lengths)
        long = np.flatnonzero(np.maximum(back, forth) >= window)
        starts = np.flatnonzero(back[self.suffixes] < window)
        first = np.repeat(np.minimum.reduceat(self.suffixes, starts), np.diff(np.append(starts, len(self.data))))
        of = np.empty(len(self.data), np.int64)
        of[self.suffixes] = first
        return long, of[long]


def marked(group: pd.DataFrame, window: int = WINDOW) -> pd.DataFrame:
    """Runs of windows (doc_id, lo, n) of the contexts in ``group`` whose string starts earlier."""
    group = group.sort_values(["doc_id", "lo"], kind="stable")
    docs, low = group["doc_id"].to_numpy(), group["lo"].to_numpy().astype(np.int64)
    index = RunIndex(group["bytes"].tolist())
    at, first = index.repeats(window)
    piece, origin = (np.searchsorted(index.begins, x, "right") - 1 for x in (at, first))
    place, source = low[piece] + at - index.begins[piece], low[origin] + first - index.begins[origin]
    later = (docs[piece] != docs[origin]) | (place != source)
    piece, place = piece[later], place[later]
    new = np.ones(len(piece), bool)
    new[1:] = (piece[1:] != piece[:-1]) | (place[1:] != place[:-1] + 1)
    heads = np.flatnonzero(new)
    count = np.diff(np.append(heads, len(piece)))
    return pd.DataFrame({"doc_id": docs[piece[heads]], "lo": place[heads].astype(np.int32), "n": count.astype(np.int32)})


def _cut(texts: DataFrame, window: int) -> DataFrame:
    """The bytes of every marked context: anchor, doc_id, lo, bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(2)
            for part in tb.unpacked(batch.column(1)):
                anchors, docs, lows, cuts = [], [], [], []
                for k in range(len(part)):
                    text = part.text(k)
                    own = marks[part.first + k].values
                    low, count = own.field("lo").to_pylist(), own.field("n").to_pylist()
                    anchors += own.field("anchor").to_pylist()
                    docs += [batch.column(0)[part.first + k].as_py()] * len(low)
                    lows += low
                    cuts += [text[a : a + n - 1 + window] for a, n in zip(low, count, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors, pa.int64()), pa.array(docs, pa.int64()), pa.array(lows, pa.int32()), pa.array(cuts, pa.binary())],
                    ["anchor", "doc_id", "lo", "bytes"],
                )

    return texts.mapInArrow(run, "anchor long, doc_id long, lo int, bytes binary")


def _each(texts: DataFrame, window: int) -> DataFrame:
    """Every window of every marked context by its hash: anchor, string, doc_id, lo."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            marks = batch.column(2)
            for part in tb.unpacked(batch.column(1)):
                own = marks.slice(part.first, len(part))
                row = pc.list_parent_indices(own).to_numpy(zero_copy_only=False)
                flat = pc.list_flatten(own)
                # a row of equal doc_id may be shorter than the one that a context was found in
                low, count = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("lo", "n"))
                count = np.clip(part.offsets[row + 1] - part.offsets[row] - window + 1 - low, 0, count)
                of = np.repeat(np.arange(len(row)), count)
                place = low[of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
                start = part.offsets[row[of]] + place
                strings = tb.Windows(part.data).hashes(start, start + window)
                anchors = flat.field("anchor").to_numpy(zero_copy_only=False)[of]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors), tb.as_long(strings), pa.array(ids[part.first + row[of]], pa.int64()), pa.array(place, pa.int32())],
                    ["anchor", "string", "doc_id", "lo"],
                )

    return texts.mapInArrow(run, "anchor long, string long, doc_id long, lo int")


def _first_contexts(docs: DataFrame, window: int) -> DataFrame:
    """Contexts that may start earlier: doc_id, lo, n, anchor, kinds (different contexts of the anchor), settled (wholly repeated).

    The ranks use the shuffle by anchor that found its uses.
    """
    shared = repeated(contexts(docs, Units(False, window, GRAM)), across=False).filter("not uniform or doc_id > first_doc or again")
    leads = shared.withColumn("leads", F.rank().over(W.partitionBy("anchor", "context").orderBy("doc_id", "lo")) == 1)
    kinds = leads.withColumn("kinds", F.count_if("leads").over(W.partitionBy("anchor")))
    return kinds.select("doc_id", "lo", "n", "anchor", "kinds", (F.col("uniform") | ~F.col("leads")).alias("settled"))


def repeated_bytes(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Runs of windows of ``window`` bytes that also start earlier: doc_id, lo, n."""
    shared = stored(_first_contexts(docs, window))
    found = shared.filter("settled").select("doc_id", "lo", "n")
    open_ones = shared.filter("not settled")
    hot = F.col("kinds") > SHARD_ROWS
    rows, hot_rows = open_ones.agg(F.count("*"), F.count_if(hot)).first()
    if rows > hot_rows:
        shards = -(-(rows - hot_rows) // SHARD_ROWS)
        pieces = _cut(tb.compressed(docs).join(by_document(open_ones.filter(~hot), "lo", "n", "anchor"), "doc_id"), window)
        dealt = pieces.select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "doc_id", "lo", "bytes")
        found = found.unionByName(dealt.groupBy("shard").applyInPandas(lambda group: marked(group, window), "doc_id long, lo int, n int"))
    if hot_rows:
        each = _each(tb.compressed(docs).join(by_document(open_ones.filter(hot), "lo", "n", "anchor"), "doc_id"), window)
        place = F.struct("doc_id", "lo")
        later = each.withColumn("first", F.min(place).over(W.partitionBy("anchor", "string"))).filter(place > F.col("first"))
        found = found.unionByName(later.select("doc_id", "lo", F.lit(1).alias("n")))
    return found


def _without(docs: DataFrame, window: int, schema: str, result) -> DataFrame:
    spans = repeated_bytes(docs, window)
    joined = tb.compressed(docs).join(by_document(spans, "lo", "n"), "doc_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(2)
            for part in tb.unpacked(batch.column(1)):
                rows = []
                for k in range(len(part)):
                    own = part.data[part.offsets[k] : part.offsets[k + 1]]
                    gone = np.zeros(len(own), bool)
                    if marks[part.first + k].is_valid:
                        values = marks[part.first + k].values
                        at, count = values.field("lo").to_numpy(), values.field("n").to_numpy()
                        gone = covered(len(own), np.minimum(at, len(own)), np.minimum(at + count - 1 + window, len(own)))
                    rows.append((batch.column(0)[part.first + k].as_py(), *result(own, gone)))
                if rows:
                    yield tb.batch_of(rows, schema)

    return joined.mapInArrow(run, schema)


def spans_of(gone: np.ndarray) -> int:
    return int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes)."""

    def result(own, gone):
        return len(own), int(gone.sum()), spans_of(gone), own[~gone].tobytes()

    return _without(docs, window, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary", result)


def removal_digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Null and empty texts have no bytes and the digest of nothing. Rows of equal doc_id count as
    one document. An empty table gives no rows; other columns of ``docs`` are not read; rows
    without doc_id are left out of the comparison.
    """

    def result(own, gone):
        return len(own), int(gone.sum()), spans_of(gone), hashlib.sha256(own[~gone].tobytes()).hexdigest()

    return _without(docs, window, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", result)

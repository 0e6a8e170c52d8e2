"""Where equal windows of a corpus can be: content-chosen anchors and their contexts.

Every window of a fixed length has one anchor: the run of a few units (words or bytes) in it
with the smallest hash. Equal windows have equal anchors at equal places, so windows that
occur twice have an anchor that occurs twice. Consecutive windows with one anchor form its
context, the text from the start of the first to the end of the last of them. An anchor whose
contexts are all equal (copies) is settled by its first document; only where contexts differ
must single windows be compared, and only there is text looked up again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from guestlens.llm import textbytes as tb

CONTEXT = "anchor long, context long, doc_id long, lo int, n int, again boolean"


@dataclass(frozen=True)
class Units:
    """What windows are made of: ``words`` or bytes, the window's length and the anchor's."""

    words: bool
    window: int
    gram: int

    def of(self, part: tb.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The slice as a sequence of units, the first unit of each row, and the gram hashes."""
        if self.words:
            found = tb.words(part)
            units = tb.Windows(part.data).hashes(found.starts, found.ends)
            return units, found.first, tb.grams(units, self.gram)
        return part.data, part.offsets, tb.Windows(part.data).sliding(self.gram)

    def contexts(self, part: tb.Slice) -> tuple[np.ndarray, ...]:
        """Row, first window, number of windows, anchor hash and context hash of every context."""
        units, first, grams = self.of(part)
        best = tb.sliding_argmin(grams, self.window - self.gram + 1)
        row_end = np.repeat(first[1:], np.diff(first))[: len(best)]
        starts = np.flatnonzero(np.arange(len(best)) + self.window <= row_end)
        if not len(starts):
            empty = np.zeros(0, np.int64)
            return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
        change = np.flatnonzero(np.concatenate([[True], best[starts[1:]] != best[starts[:-1]]]))
        low = starts[change]
        count = np.diff(np.append(change, len(starts)))
        row = np.searchsorted(first, low, "right") - 1
        return row, low - first[row], count, grams[best[low]], tb.Windows(units).hashes(low, low + count - 1 + self.window)


def contexts(docs: DataFrame, units: Units) -> DataFrame:
    """One row per context: anchor, context, doc_id, lo (first window), n (windows), again (repeats in its row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for part in tb.slices(batch.column(1)):
                row, low, count, anchor, context = units.contexts(part)
                again = np.ones(len(row), bool)
                again[np.unique(tb.mixed(context + tb.mixed(row.astype(np.uint64))), return_index=True)[1]] = False
                yield pa.RecordBatch.from_arrays(
                    [tb.as_long(anchor), tb.as_long(context), pa.array(ids[part.first + row], pa.int64()), pa.array(low, pa.int32()), pa.array(count, pa.int32()), pa.array(again)],
                    ["anchor", "context", "doc_id", "lo", "n", "again"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id is not null").mapInArrow(run, CONTEXT)


def repeated(rows: DataFrame, across: bool) -> DataFrame:
    """Contexts whose anchor occurs again (``across``: in another document), with ``uses``, ``first_doc`` and ``uniform``.

    One shuffle by anchor. The rows of an anchor are never gathered as a list: Spark passes over them twice
    and spills what does not fit, so a very common anchor costs its task time but no memory.
    """
    own = W.partitionBy("anchor")
    seen = rows.select(
        "*",
        F.count("*").over(own).alias("uses"),
        F.min("doc_id").over(own).alias("first_doc"),
        F.max("doc_id").over(own).alias("last_doc"),
        (F.min("context").over(own) == F.max("context").over(own)).alias("uniform"),
    )
    return seen.filter("first_doc < last_doc" if across else "uses > 1").drop("last_doc")


def by_document(marks: DataFrame, *columns: str) -> DataFrame:
    """doc_id and ``marks``: its rows as a list, bounded by the document's own length."""
    return marks.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("marks"))


def covered(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in a range."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0

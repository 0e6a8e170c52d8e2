"""Repeated word spans across documents: a compacted de Bruijn graph over word windows.

A window of ``window`` words is an edge between its first and its last words. Windows that
occur in one document only are not looked at (``anchors``), and runs of windows whose
surroundings are equal wherever they occur are paths already. The remaining repeated edges
are compacted through joins: an edge continues its predecessor if every occurrence of either
is next to the other, and pointers to the path's first edge double their reach every round.
All edges of a path lie in the same documents, so the path's first document decides for all.
Edges are told apart by one 64-bit hash of the window (``proof`` follows from it and adds nothing); coordinates lead back to the source text, whose words are not compared again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestlens.llm import textbytes as tb
from guestlens.llm.anchors import Units, by_document, contexts, covered, repeated
from guestlens.llm.frames import stored

WINDOW, GRAM = 13, 4
RUN = "doc_id long, lo int, edges array<bigint>, proofs array<bigint>, before long, after long"


def _edges(texts: DataFrame, window: int) -> DataFrame:
    """Every marked context: its windows in order, and the windows before and after it (0: none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(2)
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for part in tb.unpacked(batch.column(1)):
                found = tb.words(part)
                units = tb.Windows(part.data).hashes(found.starts, found.ends)
                edge = tb.grams(units, window)
                edge[edge == 0] = 1
                proof = tb.grams(units, window, salt=1)
                signed, proofs = edge.view(np.int64), proof.view(np.int64)
                rows = []
                for k in range(len(part)):
                    own = marks[part.first + k].values
                    size = found.first[k + 1] - found.first[k] - window + 1
                    for low, count in zip(own.field("lo").to_pylist(), own.field("n").to_pylist(), strict=True):
                        high = min(low + count, size)
                        if low < high:
                            a, b = found.first[k] + low, found.first[k] + high
                            rows.append((ids[part.first + k], low, signed[a:b], proofs[a:b], signed[a - 1] if low else 0, signed[b] if high < size else 0))
                if rows:
                    kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], [f.split()[0] for f in RUN.split(", ")])

    return texts.mapInArrow(run, RUN)


def _each(runs: DataFrame) -> DataFrame:
    """One row per window: edge, proof, before, after, doc_id, at."""
    n = F.size("edges")
    before = F.concat(F.array("before"), F.slice("edges", 1, n - 1))
    after = F.concat(F.slice("edges", 2, n - 1), F.array("after"))
    zipped = F.arrays_zip(F.col("edges").alias("edge"), F.col("proofs").alias("proof"), before.alias("before"), after.alias("after"))
    each = runs.select("doc_id", "lo", F.posexplode(zipped).alias("k", "w"))
    return each.select("w.edge", "w.proof", "w.before", "w.after", "doc_id", (F.col("lo") + F.col("k")).alias("at"))


def _paths(edges: DataFrame) -> DataFrame:
    """The first edge of every compacted path: edge, proof, first_doc, n (edges of the path)."""
    nodes = stored(
        edges.groupBy("edge", "proof").agg(
            F.min("doc_id").alias("first_doc"),
            F.max("doc_id").alias("last_doc"),
            F.min("before").alias("b0"),
            F.max("before").alias("b1"),
            F.min("after").alias("a0"),
            F.max("after").alias("a1"),
        )
    )
    nodes = nodes.filter("first_doc < last_doc")
    onward = nodes.filter("a0 = a1 and a0 <> 0").select(F.col("edge").alias("b0"), F.col("a0").alias("edge"))
    linked = nodes.filter("b0 = b1 and b0 <> 0").join(onward, ["edge", "b0"], "left_semi").select("edge", F.col("b0").alias("head"))
    pointers = stored(nodes.join(linked, "edge", "left").select("edge", "proof", "first_doc", F.coalesce("head", "edge").alias("head"), F.when(F.col("head").isNull(), 0).otherwise(1).alias("hops")))
    moving = -1
    while moving:
        target = pointers.select(F.col("edge").alias("head"), F.col("head").alias("head2"), F.col("hops").alias("hops2"))
        jumped = pointers.join(target, "head").select("edge", "proof", "first_doc", F.col("head2").alias("head"), (F.col("hops") + F.col("hops2")).alias("hops"), (F.col("hops2") > 0).alias("moved"))
        jumped = stored(jumped)
        moving = jumped.filter("moved").count()
        pointers = jumped.drop("moved")
    sizes = pointers.groupBy(F.col("head").alias("edge")).agg((F.max("hops") + 1).alias("n"))
    return pointers.filter("hops = 0").select("edge", "proof", "first_doc").join(sizes, "edge")


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Runs of windows that also start in a document with a smaller doc_id: doc_id, lo, n, first_doc.

    ``lo`` is the word at which the first window starts, ``n`` the number of windows.
    """
    texts = tb.compressed(docs)
    shared = repeated(contexts(docs, Units(True, window, GRAM)), across=True)
    shared = stored(shared.filter("not uniform or doc_id > first_doc").select("doc_id", "lo", "n", "first_doc", "uniform"))
    settled = shared.filter("uniform").select("doc_id", "lo", "n", "first_doc")
    open_ones = by_document(shared.filter("not uniform"), "lo", "n")
    edges = _each(stored(_edges(texts.join(open_ones, "doc_id"), window)))
    paths = _paths(edges)
    found = edges.join(paths, ["edge", "proof"]).filter("doc_id > first_doc").select("doc_id", F.col("at").alias("lo"), "n", "first_doc")
    return settled.unionByName(found)


def _without(docs: DataFrame, spans: DataFrame, window: int, schema: str, result) -> DataFrame:
    marked = tb.compressed(docs).join(by_document(spans.select("doc_id", "lo", "n"), "lo", "n"), "doc_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(2)
            for part in tb.unpacked(batch.column(1)):
                found = tb.words(part)
                rows = []
                for k in range(len(part)):
                    low, high = found.first[k], found.first[k + 1]
                    gone = np.zeros(high - low, bool)
                    own = marks[part.first + k]
                    if own.is_valid and len(gone):
                        at, count = own.values.field("lo").to_numpy(), own.values.field("n").to_numpy()
                        gone = covered(len(gone), np.minimum(at, len(gone)), np.minimum(at + count - 1 + window, len(gone)))
                    rows.append((batch.column(0)[part.first + k].as_py(), *result(part, found.starts[low:high], found.ends[low:high], gone)))
                if rows:
                    yield tb.batch_of(rows, schema)

    return marked.mapInArrow(run, schema)


def kept_words(part: tb.Slice, starts: np.ndarray, ends: np.ndarray, gone: np.ndarray) -> bytes:
    data = part.data
    return b" ".join([data[a:b].tobytes() for a, b in zip(starts[~gone].tolist(), ends[~gone].tolist(), strict=True)])


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, text (the kept words, joined by one space)."""

    def result(part, starts, ends, gone):
        return len(gone), int(gone.sum()), kept_words(part, starts, ends, gone).decode("utf-8")

    return _without(docs, repeated_spans(docs, window), window, "doc_id long, n_words long, n_removed long, text string", result)


def removal_digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256.

    Null and empty texts have no words and the digest of nothing. Rows of equal doc_id are one
    document's: they never remove words from each other. An empty table gives no rows; other
    columns of ``docs`` are not read; rows without doc_id are left out of the comparison.
    """

    def result(part, starts, ends, gone):
        return len(gone), int(gone.sum()), hashlib.sha256(kept_words(part, starts, ends, gone)).hexdigest()

    return _without(docs, repeated_spans(docs, window), window, "doc_id long, n_words long, n_removed long, kept_sha256 string", result)

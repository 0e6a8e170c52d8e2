"""Documents as token pieces of at most ``capacity`` ids, shared by the two packing operators."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestlens.llm import tokens
from guestlens.llm.bins import placed
from guestlens.llm.frames import numbered

END_ID = 1
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def packed_ids(raw: bytes) -> bytes:
    """Little-endian 32-bit ids, compressed in the width they need."""
    import zstandard

    ids = np.frombuffer(raw, "<u4")
    short = not len(ids) or ids.max() < 1 << 16
    return (b"\x02" if short else b"\x04") + zstandard.compress(ids.astype("<u2").tobytes() if short else raw, 1)


def unpacked_ids(data: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.decompress(data[1:]), f"<u{data[0]}").astype("<u4")


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and ``ids`` if wanted.

    A document's ids are those of its whole text and then ``end_id``; a null or empty text has
    the end id alone. Longer documents are cut every ``capacity`` ids and nothing is dropped.
    ``ids`` is what ``unpacked_ids`` reads. Rows of equal doc_id stay separate rows.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path).ids
        tail = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                rows: list[tuple] = []
                texts = [(x.as_buffer() or pa.py_buffer(b"")).to_pybytes() for x in part.column(1)]
                for doc, ids in zip(part.column(0).to_pylist(), encode(texts), strict=True):
                    ids += tail
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        rows.append((doc, k, at // 4, len(own) // 4, zlib.crc32(own), packed_ids(own) if with_ids else None))
                names = ("doc_id", "piece", "start", "length", "ids_crc32", "ids")
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                columns = list(zip(*rows, strict=True))[: 6 if with_ids else 5]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names[: len(columns)])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECE + (", ids binary" if with_ids else ""))


def histogram(pieces: DataFrame) -> dict[int, int]:
    """How many pieces have each length: as many rows as the capacity at most, whatever the corpus."""
    return {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}


def assigned(pieces: DataFrame, rules: np.ndarray) -> DataFrame:
    """Each piece with the sequence and the place in it that the plan's rules give it."""
    spark = pieces.sparkSession
    shared = spark.sparkContext.broadcast(rules)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lengths, numbers = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "number"))
                bins, offsets = placed(shared.value, lengths, numbers)
                keep = batch.schema.names[:-1]
                arrays = batch.columns[:-1]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(bins), pa.array(offsets)], [*keep, "sequence_id", "offset"])

    schema = ", ".join(f"{c} {t}" for c, t in pieces.dtypes) + ", sequence_id long, offset long"
    return numbered(pieces, "length", *(c for c in pieces.columns if c != "length")).mapInArrow(place, schema)

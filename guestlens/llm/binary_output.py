"""Token ids in fixed-size matrices: best-fit-decreasing packing and binary files.

Documents longer than a row are split without loss. Rows are planned by best fit
decreasing on the histogram of lengths; a segment tree over the room left finds the
fullest row that takes an item. A packed row carries its ids as little-endian integers of
the width the vocabulary needs, cumulative segment lengths, and positions that restart at
every segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestlens.llm.bins import Plan
from guestlens.llm.frames import stored
from guestlens.llm.pieces import assigned, histogram, token_pieces, unpacked_ids

ROW_IDS = 2048
PAD_ID = 0
ROWS = "row_id long, n_ids long, segment_docs array<long>, segment_pieces array<int>, cu_seqlens array<int>, ids binary"


def packed_rows(docs: DataFrame, path: str, row_ids: int = ROW_IDS) -> DataFrame:
    """One row per matrix row: row_id, n_ids, segment_docs, segment_pieces, cu_seqlens, ids.

    ``ids`` are ``n_ids`` little-endian unsigned 32-bit integers, the segments one after another;
    ``cu_seqlens`` starts with 0 and ends with ``n_ids``. A null or empty text is one end id,
    repeated rows are packed as often as they occur, an empty table gives no rows. A row
    gathers at most ``row_ids`` ids, so no task holds more than a batch of rows.
    """
    # the stored pieces are files, so their row numbers are the same in every later task
    pieces = stored(token_pieces(docs, path, row_ids, with_ids=True)).withColumn("row", F.monotonically_increasing_id())
    plan = Plan(row_ids, histogram(pieces))
    plan.best_fit_decreasing()
    placed = assigned(pieces.drop("ids"), plan.table()).select("row", "sequence_id", "offset")
    segment = F.struct("offset", "doc_id", "piece", "ids")
    gathered = pieces.join(placed, "row").groupBy(F.col("sequence_id").alias("row_id")).agg(F.collect_list(segment).alias("segments"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                rows = []
                for row_id, segments in zip(*(c.to_pylist() for c in batch.slice(low, 256).columns), strict=True):
                    segments.sort(key=lambda s: s["offset"])
                    ids = [unpacked_ids(s["ids"]) for s in segments]
                    ends = np.cumsum([0, *map(len, ids)])
                    rows.append((row_id, int(ends[-1]), [s["doc_id"] for s in segments], [s["piece"] for s in segments], ends.tolist(), np.concatenate(ids).tobytes()))
                kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [f.split()[0] for f in ROWS.split(", ")])

    return gathered.mapInArrow(joined, ROWS)


def matrices(rows: DataFrame, row_ids: int = ROW_IDS, vocabulary: int = 1 << 16, pad_id: int = PAD_ID) -> DataFrame:
    """Rows of equal width for binary files: input_ids and position_ids padded to ``row_ids``.

    ``input_ids`` has 2 bytes an id if the vocabulary fits, else 4; ``position_ids`` has 2 bytes
    (4 for longer rows), restarts at 0 in every segment and is 0 in the padding.
    """
    id_kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
    place_kind = "<u2" if row_ids <= 1 << 16 else "<u4"

    def widened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[["row_id", "n_ids", "segment_docs", "segment_pieces", "cu_seqlens"]].copy()
            inputs, places = [], []
            for ids, ends in zip(batch["ids"], batch["cu_seqlens"], strict=True):
                own = np.frombuffer(ids, "<u4")
                wide = np.full(row_ids, pad_id, id_kind)
                wide[: len(own)] = own
                place = np.zeros(row_ids, place_kind)
                ends = np.asarray(ends)
                place[: len(own)] = np.arange(len(own)) - np.repeat(ends[:-1], np.diff(ends))
                inputs.append(wide.tobytes())
                places.append(place.tobytes())
            yield out.assign(input_ids=inputs, position_ids=places)

    schema = "row_id long, n_ids long, segment_docs array<long>, segment_pieces array<int>, cu_seqlens array<int>, input_ids binary, position_ids binary"
    return rows.mapInPandas(widened, schema)


def write_matrices(rows: DataFrame, folder: str, row_ids: int = ROW_IDS, vocabulary: int = 1 << 16) -> None:
    """Packed matrices as Parquet files under ``folder``; the folder must not exist yet."""
    matrices(rows, row_ids, vocabulary).write.option("compression", "zstd").parquet(folder)


def read_matrix(folder: str, id_kind: str = "<u2") -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The rows of one local file or folder again: row_id, ids without padding, cumulative lengths."""
    import pyarrow.dataset as ds

    for batch in ds.dataset(folder).to_batches(columns=["row_id", "n_ids", "cu_seqlens", "input_ids"]):
        for row in pa.Table.from_batches([batch]).to_pylist():
            yield row["row_id"], np.frombuffer(row["input_ids"], id_kind)[: row["n_ids"]], np.array(row["cu_seqlens"])

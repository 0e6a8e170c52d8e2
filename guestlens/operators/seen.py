"""Incremental batches: ids met in earlier batches are kept in a table, with a Bloom filter in front of it.

A new batch is first asked against the filter. Rows whose id it has never met go straight through; only the others, the true
repeats and a few more, are joined with the stored ids. So the stored ids are shuffled against a
fraction of the batch, and a batch of new ids costs no join with the store at all.

The filter is cut in blocks; an id sets its bits in one block only. Each batch writes the blocks it
touched, and a reader joins the bits of all batches. Folders are named by batch and replaced as a whole, so a batch that is
written twice, or broken and repeated, leaves the same store.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a block, and how many of them an id sets.
BLOCK_BITS = 1 << 15
HASHES = 6
#: Filters of at most so many bytes travel to the tasks; beyond that, batches are joined with the stored ids unfiltered.
FILTER_BYTES = 64 << 20


def id_hash(df: DataFrame, key: str) -> DataFrame:
    """``df`` with the 64-bit hash of the key's text, ``__hash``; ids of any type are stored as text."""
    return df.withColumn("__hash", F.xxhash64(F.col(key).cast("string")))


def bit_places(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each hash and its bits there."""
    x = hashes.astype(np.int64).view(np.uint64)
    low, step = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(17)) | np.uint64(1)
    block = ((x >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)
    turns = np.arange(HASHES, dtype=np.uint64)
    return block, ((low[:, None] + turns * step[:, None]) % np.uint64(BLOCK_BITS)).astype(np.int64)


def filter_blocks(ids: DataFrame, blocks: int) -> DataFrame:
    """(block, bits) of the ids' hashes; every task joins its bits before blocks are shuffled."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            block, bits = bit_places(batch.column(0).to_numpy(zero_copy_only=False), blocks)
            order = np.argsort(block, kind="stable")
            touched, first = np.unique(block[order], return_index=True)
            for number, rows in zip(touched.tolist(), np.split(order, first[1:]), strict=True):
                own.setdefault(number, np.zeros(BLOCK_BITS, bool))[bits[rows].ravel()] = True
        packed = [np.packbits(own[number]).tobytes() for number in own]
        yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.int64()), pa.array(packed, pa.binary())], ["block", "bits"])

    return joined_blocks(ids.select("__hash").mapInArrow(local, "block long, bits binary"))


def joined_blocks(parts: DataFrame) -> DataFrame:
    """One row per block with the bits of all its rows; neighbouring blocks are joined in one call."""

    def union(group: pd.DataFrame) -> pd.DataFrame:
        own: dict[int, np.ndarray] = {}
        for block, bits in zip(group["block"], group["bits"], strict=True):
            row = np.frombuffer(bits, np.uint8)
            own[block] = own[block] | row if block in own else row
        return pd.DataFrame({"block": list(own), "bits": [b.tobytes() for b in own.values()]})

    return parts.groupBy(F.shiftright("block", 7)).applyInPandas(union, "block long, bits binary")


@dataclass(frozen=True)
class SeenIds:
    """The store of seen ids in a folder that all executors share.

    ``blocks`` is fixed when the store is begun: some ten bits per expected id keep chance hits of the
    filter near one in a hundred. They only cost time; a result never depends on the filter.
    """

    spark: SparkSession
    folder: str
    blocks: int = 1024
    most: int = FILTER_BYTES

    def _read(self, name: str, schema: str, before: int | None) -> DataFrame:
        """Rows of the earlier batches; an empty table where nothing is stored yet."""
        path = f"{self.folder.rstrip('/')}/{name}"
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if not hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
            return self.spark.createDataFrame([], f"{schema}, batch long")
        rows = self.spark.read.schema(f"{schema}, batch long").parquet(path)
        return rows if before is None else rows.where(F.col("batch") < before)

    def ids(self, before: int | None = None) -> DataFrame:
        """(id, batch): every id with the first batch that had it; ``before`` reads the folders of earlier batches only."""
        return self._read("ids", "id string", before)

    def filter_of(self, before: int | None = None) -> np.ndarray | None:
        """The bits of the earlier batches by block, or nothing where they pass the bound."""
        if self.blocks * BLOCK_BITS // 8 > self.most:
            return None
        bits = np.zeros((self.blocks, BLOCK_BITS // 8), np.uint8)
        stored = self._read("filter", "block long, bits binary", before).select("block", "bits")
        for row in joined_blocks(stored).collect():  # a row per block, within the bound
            bits[row["block"]] = np.frombuffer(row["bits"], np.uint8)
        return bits

    def marked(self, df: DataFrame, key: str, batch: int) -> DataFrame:
        """``df`` with ``__hash`` and ``__maybe``: whether the filter of the earlier batches may have met the id."""
        hashed = id_hash(df, key)
        bits = self.filter_of(batch)
        if bits is None:
            return hashed.withColumn("__maybe", F.col(key).isNotNull())
        shared, blocks = self.spark.sparkContext.broadcast(bits), self.blocks

        @F.arrow_udf(T.BooleanType())
        def maybe(hashes: pa.Array) -> pa.Array:
            block, places = bit_places(hashes.to_numpy(zero_copy_only=False), blocks)
            found = shared.value[block[:, None], places >> 3] >> (7 - (places & 7)).astype(np.uint8) & 1
            return pa.array(found.all(1))

        return hashed.withColumn("__maybe", F.col(key).isNotNull() & maybe("__hash"))

    def unseen(self, df: DataFrame, key: str, batch: int) -> DataFrame:
        """Rows of a batch whose id no earlier batch had; repeats inside the batch and rows without an id stay."""
        marked = self.marked(df, key, batch)
        fresh = marked.where(~F.col("__maybe"))
        earlier = self.ids(batch).select(F.col("id").alias("__seen"))
        asked = marked.where("__maybe").join(earlier, F.col(key).cast("string") == F.col("__seen"), "left_anti")
        return fresh.unionByName(asked).select(*df.columns)

    def add(self, rows: DataFrame, key: str, batch: int) -> None:
        """Stores the ids of rows that ``unseen`` let through, as those of ``batch``, and replaces what that batch had stored.

        The filter comes first: bits without their ids only cost time, ids without their bits would be missed.
        """
        path = self.folder.rstrip("/")
        own = rows.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("id"))
        filter_blocks(id_hash(own, "id"), self.blocks).write.mode("overwrite").parquet(f"{path}/filter/batch={batch}")
        own.distinct().write.mode("overwrite").parquet(f"{path}/ids/batch={batch}")

    def take(self, df: DataFrame, key: str, batch: int, path: str) -> DataFrame:
        """The unseen rows of a batch, written to ``path`` and read from there, after which their ids are seen.

        The rows are stored before their ids: a run that breaks between the two is repeated with the same result.
        """
        self.unseen(df, key, batch).write.mode("overwrite").parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self.add(kept, key, batch)
        return kept

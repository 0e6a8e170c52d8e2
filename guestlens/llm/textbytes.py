"""Vectorised helpers over the UTF-8 bytes of many texts at once.

Spark hands texts over in Arrow batches. ``slices`` cuts a batch into runs of whole
rows of about a megabyte, so that the working arrays of a task stay small whatever
the batch size; only a single longer text makes a longer slice.

Hashes are 64-bit polynomial window hashes over random byte values, finished by a mixing
step. They depend on the bytes alone, so every task and every run gets the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
#: The bytes that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.default_rng(20250101).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values whose bits all depend on all bits of ``x``."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grown(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 1 << 16)
        for name, base in (("_powers", _BASE), ("_inverses", _INVERSE)):
            steps = np.full(size, np.uint64(base), np.uint64)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)


class Windows:
    """Hashes of any windows of a sequence in constant time each: of bytes, or of 64-bit values."""

    def __init__(self, data: np.ndarray):
        _grown(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((_VALUES[data] if data.dtype == np.uint8 else data) * _powers[: len(data)], out=self.prefix[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        plain = (self.prefix[ends] - self.prefix[starts]) * _inverses[starts]
        return mixed(plain + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def sliding(self, length: int) -> np.ndarray:
        """The hash of every window of ``length``, by its start."""
        n = len(self.prefix) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mixed((self.prefix[length:] - self.prefix[:n]) * _inverses[:n])


@dataclass
class Slice:
    """Some consecutive rows of a batch: their bytes and where each text begins and ends."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Runs of whole rows of about ``limit`` bytes; null texts are empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(texts):
        return
    _, at, raw = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield Slice(row, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row])
        row = last


@dataclass
class Words:
    """The words of a slice: byte spans, and for each row the number of its first word."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(part: Slice) -> Words:
    """Words are runs of bytes that are not white space, within one row."""
    inside = ~WHITE[part.data]
    n = len(inside)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = part.offsets[part.offsets < n]
    begins[edges] = inside[edges]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    finishes[edges[edges > 0] - 1] = inside[edges[edges > 0] - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    return Words(starts, ends, np.searchsorted(starts, part.offsets))


def grams(hashes: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """One hash for each run of ``n`` consecutive hashes, by its start."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(count, np.uint64(n + 977 * salt), np.uint64)
    for j in range(n):
        out = out * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[j : j + count]
    return mixed(out)


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Where the smallest of each ``width`` consecutive values is; the leftmost of equal ones.

    Positions are carried beside the values through windows of doubling width.
    """
    count = len(values) - width + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    best, at, have = values.copy(), np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left, right = slice(0, len(best) - step), slice(step, len(best))
        take = best[right] < best[left]
        at = np.where(take, at[right], at[left])
        best = np.minimum(best[left], best[right])
        have += step
    return at[:count]


def compressed(docs: DataFrame) -> DataFrame:
    """doc_id and z: whole texts packed for a shuffle; null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                rows = [pack(x.as_buffer() or b"") for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.binary())], ["doc_id", "z"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, z binary")


def unpacked(column: pa.Array) -> Iterator[Slice]:
    """Slices of a column that ``compressed`` made."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    row, texts, size = 0, [], 0
    for k, z in enumerate(column):
        texts.append(unpack(z.as_py()))
        size += len(texts[-1])
        if size >= SLICE_BYTES or k == len(column) - 1:
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
            yield Slice(row, np.frombuffer(b"".join(texts), np.uint8), offsets)
            row, texts, size = k + 1, [], 0


_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows as a batch of a Spark schema of plain types; columns of nulls keep their type."""
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], [n for n, _ in fields])


def as_long(x: np.ndarray) -> pa.Array:
    """Unsigned hashes as the signed longs that Spark has."""
    return pa.array(x.astype(np.uint64).view(np.int64), pa.int64())

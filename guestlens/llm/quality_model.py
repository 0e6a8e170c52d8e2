"""Quality scores: random-indexing word vectors, pooled per document, and a two-layer network.

A token is a run of letters, of digits or of other signs. Every token, by its hash, has a
sparse random index vector of a few ones and minus ones. A token's vector is the sum of the index vectors of its
neighbours all over the corpus, so tokens used alike have like vectors. Those sums
are whole numbers, hence equal in every run whatever the order of tasks. A document is the
mean, the spread and the neighbour products of its tokens' vectors. A network of one hidden
layer is trained on labelled documents and its probabilities are calibrated by a temperature.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestlens.llm import textbytes as tb
from guestlens.llm.frames import stored

TOKEN_BITS = 14
SIZE = 48
ONES = 4
REACH = 2
FEATURES = 3 * SIZE
#: At most so many labelled documents train the network, those with the smallest hashes of their id.
TRAINING_ROWS = 20_000
HIDDEN = 32
ACCEPTED = 0.7
BLOCKS = 64
#: Sums of the tasks are added in so many lanes before the last step.
LANES = 16

_rng = np.random.default_rng(90210)
_PLACES = np.stack([_rng.permutation(SIZE)[:ONES] for _ in range(1 << TOKEN_BITS)])
_SIGNS = _rng.choice([-1, 1], (1 << TOKEN_BITS, ONES))
_KIND = np.full(256, 3, np.uint8)
_KIND[tb.WHITE] = 0
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2


def tokens_of(part: tb.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of a slice and the first token of each row."""
    kind = _KIND[part.data]
    n = len(kind)
    new = np.ones(n + 1, bool)
    new[1:n] = kind[1:] != kind[:-1]
    new[part.offsets] = True
    cuts = np.flatnonzero(new)
    starts, ends = cuts[:-1], cuts[1:]
    solid = kind[starts] > 0 if n else np.zeros(0, bool)
    starts, ends = starts[solid], ends[solid]
    hashes = tb.Windows(part.data).hashes(starts, ends)
    return (hashes >> np.uint64(64 - TOKEN_BITS)).astype(np.int64), np.searchsorted(starts, part.offsets)


def _row_numbers(first: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def _packed(sums: np.ndarray) -> bytes:
    return zlib.compress(sums.astype(np.int64).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.int64)


def neighbour_sums(docs: DataFrame) -> np.ndarray:
    """The vectors of all tokens, of unit length; a table of fixed size whatever the corpus."""
    count = 1 << TOKEN_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(count * SIZE, np.int64)
        for batch in batches:
            for part in tb.slices(batch.column(0)):
                token, first = tokens_of(part)
                row = _row_numbers(first)
                for apart in range(1, REACH + 1):
                    near = np.flatnonzero(row[apart:] == row[:-apart])
                    for own, other in ((near, near + apart), (near + apart, near)):
                        at = (token[own, None] * SIZE + _PLACES[token[other]]).ravel()
                        sums += np.bincount(at, _SIGNS[token[other]].ravel(), len(sums)).astype(np.int64)
        if sums.any():
            blocks = np.array_split(sums, BLOCKS)
            yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array([_packed(b) for b in blocks], pa.binary())], ["block", "sums"])

    def total(group: pd.DataFrame) -> pd.DataFrame:
        out = sum(_unpacked(x) for x in group["sums"])
        return pd.DataFrame({"block": group["block"].iloc[:1], "sums": [_packed(out)]})

    parts = docs.select("text").mapInArrow(run, "block int, sums binary").withColumn("lane", F.spark_partition_id() % LANES)
    by_lane = parts.groupBy("block", "lane").applyInPandas(total, "block int, sums binary")
    rows = by_lane.groupBy("block").applyInPandas(total, "block int, sums binary").orderBy("block").collect()
    if not rows:
        return np.zeros((count, SIZE), np.float32)
    vectors = np.concatenate([_unpacked(r["sums"]) for r in rows]).reshape(count, SIZE).astype(np.float64)
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(vectors: np.ndarray, token: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean, spread and neighbour products of the vectors of every row; zeros for rows without tokens."""
    rows = len(first) - 1
    out = np.zeros((rows, FEATURES), np.float32)
    full = np.flatnonzero(np.diff(first) > 0)
    if not len(full):
        return out
    x = vectors[token]
    count = np.diff(first)[full, None]
    mean = np.add.reduceat(x, first[full]) / count
    square = np.add.reduceat(x * x, first[full]) / count
    pair = np.zeros_like(x)
    pair[:-1] = x[:-1] * x[1:]
    pair[first[full + 1] - 1] = 0
    out[full, :SIZE] = mean
    out[full, SIZE : 2 * SIZE] = np.sqrt(np.maximum(square - mean * mean, 0))
    out[full, 2 * SIZE :] = np.add.reduceat(pair, first[full]) / np.maximum(count - 1, 1)
    return out


def document_vectors(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """doc_id and ``features`` (16-bit floats) of every row; nothing but the text is read."""
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.slices(batch.column(1)):
                rows = pooled(shared.value, *tokens_of(part)).astype(np.float16)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.first, len(part)), pa.array([r.tobytes() for r in rows], pa.binary())], ["doc_id", "features"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, features binary")


@dataclass
class Network:
    """Standardised inputs, one hidden layer, one output, and the temperature of its probabilities."""

    middle: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.middle) / self.scale @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def trained(x: np.ndarray, y: np.ndarray, rounds: int = 60, rate: float = 3e-3, decay: float = 1e-4, seed: int = 5) -> Network:
    """Fit by Adam on small batches; a tenth of the rows is held back to fit the temperature."""
    rng = np.random.default_rng(seed)
    x, y = x.astype(np.float64), y.astype(np.float64)
    middle, scale = x.mean(0), x.std(0) + 1e-3
    net = Network(middle, scale, rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN), 0.0)
    order = rng.permutation(len(x))
    aside = order[: len(x) // 10]
    fit = order[len(x) // 10 :]
    z = (x - middle) / scale
    weights = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for done in range(rounds):
        pace = rate * 0.5 * (1 + np.cos(np.pi * done / rounds))
        for part in np.array_split(rng.permutation(fit), max(1, len(fit) // 128)):
            a, t = z[part], y[part]
            before = a @ weights[0] + weights[1]
            hidden = np.maximum(before, 0)
            error = (1 / (1 + np.exp(-np.clip(hidden @ weights[2] + weights[3], -40, 40))) - t) / len(part)
            back = np.outer(error, weights[2]) * (before > 0)
            slopes = [a.T @ back + decay * weights[0], back.sum(0), hidden.T @ error + decay * weights[2], error.sum(keepdims=True)]
            step += 1
            for k, g in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                weights[k] -= pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = weights[0], weights[1], weights[2], float(weights[3][0])
    if len(aside):
        logits, t = net.logits(x[aside]), y[aside]
        losses = []
        for temperature in np.exp(np.linspace(-1.5, 2.5, 81)):
            p = np.clip(1 / (1 + np.exp(-np.clip(logits / temperature, -40, 40))), 1e-9, 1 - 1e-9)
            losses.append((-(t * np.log(p) + (1 - t) * np.log(1 - p)).mean(), temperature))
        net.temperature = float(min(losses)[1])
    return net


def fold(doc_id: int) -> int:
    """crc32 of the document's id as text, modulo 4; documents of fold 2 are held out."""
    return zlib.crc32(str(doc_id).encode()) % 4


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted.

    Labels of held-out documents are never read by the fit. Null and empty texts have a zero vector and
    get a score like any other; rows without a label or with a null one are scored only; with no
    usable label at all every score is 0.5. Repeated rows get equal scores, an empty table gives
    no rows, and other columns are not read.
    """
    rows = stored(document_vectors(docs, neighbour_sums(docs)))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    usable = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("quality")).filter("quality in (0, 1)").filter(~held)
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(TRAINING_ROWS)  # so few that they may be broadcast
    sample = rows.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "features", "quality").limit(TRAINING_ROWS).select("features", "quality").collect()
    net = None
    if sample:
        x = np.frombuffer(b"".join(r["features"] for r in sample), np.float16).reshape(-1, FEATURES)
        net = trained(x, np.array([r["quality"] for r in sample]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids = batch.column(0).to_pylist()
                x = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float16).reshape(-1, FEATURES)
                score = net.score(x.astype(np.float64)) if net else np.full(len(x), 0.5)
                held_out = [i is not None and fold(i) == 2 for i in ids]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held_out), pa.array(score), pa.array((score >= ACCEPTED).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")

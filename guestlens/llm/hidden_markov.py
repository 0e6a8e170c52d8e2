"""Language-model scores by a hidden Markov model trained on the corpus itself.

Tokens are lower-cased words and one end per document. Every word of the training documents is counted
exactly. The model's latent states emit word classes: the most frequent words are classes of their own, all others share
a fixed number of classes by hash and are told apart inside their class by their own counts, as in the
base model. Unseen words are one more class, with the base model's probability in every state. So the tables that tasks
hold have a fixed size, while the counts grow with the corpus and stay in Spark.

Texts are read once into chunks of documents with a dictionary each. A chunk's distinct words, not its tokens, are joined with the
counts, salted for words of most chunks. Baum-Welch rounds add expected counts of all training
documents per task and then per class, as whole numbers, so that sums don't depend on the order of tasks; each
starts from stored class sequences. The rounds cut documents in stretches with a start distribution of their own.
Scoring cuts nothing: the scaled forward recursion runs over whole documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from guestlens.llm import textbytes as tb
from guestlens.llm.frames import cleaned, stored, written
from guestlens.llm.periodic_runs import codes_of
from guestlens.plans.skew import lookup_join

STATES = 8
ROUNDS = 6
#: Words with a class of their own, and classes that the other words share by hash.
COMMON = 32_000
SHARED = 32_768
UNSEEN = COMMON + SHARED
CLASSES = UNSEEN + 1
#: Tokens of a training stretch, and how many stretches are worked on at once.
STRETCH = 64
TOGETHER = 2_048
#: Share of a state's emissions that follows the class frequencies of the whole corpus.
SHARE = 0.02
#: Expected counts are whole multiples of this.
UNIT = 1.0 / 1024
#: A chunk has about so many bytes of text; a longer document is a chunk of its own.
CHUNK_BYTES = 4 << 20
#: The seed of Spark's own xxhash64.
_SEED = 42
#: The end of a document among the words; no word is empty.
END = ""


def fold(doc_id: int) -> int:
    """crc32 of the document's id as text, modulo 7; documents of fold 2 are held out."""
    return zlib.crc32(str(doc_id).encode()) % 7


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


CHUNK = "chunk long, ids array<long>, lengths array<int>, tokens binary, words binary, learnt binary"
WORD = "chunk long, at int, word string, learnt long"


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a task in batches of at least a chunk's bytes, but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= CHUNK_BYTES:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def chunks(docs: DataFrame) -> DataFrame:
    """Rows of many documents: their ids, lengths and tokens, the distinct words, and how often training documents have each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in _gathered(batches):
            for part in tb.slices(batch.column(1), CHUNK_BYTES):
                part = tb.Slice(part.first, tb.LOWER[part.data], part.offsets)
                found = tb.words(part)
                codes, column = codes_of(part, found)
                distinct, seen = np.unique(codes, return_index=True)
                texts, counts = len(part), np.diff(found.first)
                row = np.repeat(np.arange(texts), counts)
                tokens = np.full(len(codes) + texts, len(distinct), "<u4")
                tokens[np.arange(len(codes)) + row] = codes
                ids = batch.column(0).slice(part.first, texts)
                learns = np.array([i is not None and fold(i) != 2 for i in ids.to_pylist()])
                learnt = np.bincount(tokens[np.repeat(learns, counts + 1)], minlength=len(distinct) + 1)
                words = "\n".join([*column.take(pa.array(seen)).to_pylist(), END]).encode()  # no word holds a line feed
                values = [[number], [ids.to_pylist()], [(counts + 1).tolist()], [_packed(tokens)], [_packed(np.frombuffer(words, np.uint8))], [_packed(learnt)]]
                types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary()]
                names = [f.split()[0] for f in CHUNK.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names)
                number += 1

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, CHUNK)


def chunk_words(parts: DataFrame) -> DataFrame:
    """A row for each distinct word of each chunk: its place in the chunk's dictionary and its training count there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, packed, learnt in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                words = _unpacked(packed, np.uint8).tobytes().decode().split("\n")
                columns = [pa.array(np.full(len(words), chunk)), pa.array(np.arange(len(words), dtype=np.int32)), pa.array(words), pa.array(_unpacked(learnt, np.int64))]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in WORD.split(", ")])

    return parts.select("chunk", "words", "learnt").mapInArrow(run, WORD)


@dataclass(frozen=True)
class Vocabulary:
    """Words with their training counts and classes, in Spark; the totals, and the mass (sum of count + 1) of every class."""

    words: DataFrame
    tokens: int
    distinct: int
    mass: np.ndarray

    @property
    def unseen(self) -> float:
        """What the base model gives an unseen word."""
        return 1.0 / (self.tokens + self.distinct + 1)


def vocabulary(parts: DataFrame) -> Vocabulary:
    """Exact counts of all words of training documents, and their classes."""
    counts = written(chunk_words(parts).groupBy("word").agg(F.sum("learnt").alias("c"), F.count(F.lit(1)).alias("n_chunks"))).withColumn("h", F.xxhash64("word"))
    known = counts.where("c > 0")
    total = known.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    most = known.orderBy(F.desc("c"), "h").limit(COMMON).select("h", "c")
    own = most.withColumn("own", F.row_number().over(Window.orderBy(F.desc("c"), "h")) - 1)  # at most COMMON rows of two numbers
    shared = F.lit(COMMON) + F.pmod("h", F.lit(SHARED))
    kind = F.when(F.col("c") == 0, UNSEEN).otherwise(F.coalesce("own", shared)).cast("int")
    words = counts.join(F.broadcast(stored(own)), ["h", "c"], "left").select("word", "c", "n_chunks", kind.alias("class"))
    mass = np.zeros(CLASSES)
    for row in words.where("c > 0").groupBy("class").agg(F.sum(F.col("c") + 1).alias("mass")).collect():  # a row per class
        mass[row["class"]] = row["mass"]
    return Vocabulary(words, total["n"] or 0, total["v"], mass)


CODED = "ids array<long>, lengths array<int>, classes binary, known array<long>, base array<double>, inside array<double>"


def coded(parts: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Chunks with class sequences; per document the known tokens, the base score and the score of words inside their classes.

    Only words that are common or occur in several chunks are looked up.
    """
    each = chunk_words(parts).select("chunk", "at", "word")
    elsewhere = vocab.words.where(f"n_chunks > 1 or class < {COMMON}")
    met = lookup_join(each, elsewhere, ["word"], "n_chunks", "inner", spread=["chunk", "at"])
    codes = written(met.groupBy("chunk").agg(F.collect_list(F.struct("c", (F.col("at").cast("long") * 65536 + F.col("class")).alias("coded"))).alias("codes")))
    mass, unseen = vocab.mass, vocab.unseen

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                words = _unpacked(row.column("words")[0].as_py(), np.uint8).tobytes().split(b"\n")
                c = _unpacked(row.column("learnt")[0].as_py(), np.int64).copy()
                table = row.column("codes").flatten()
                at, met = np.divmod(table.field("coded").to_numpy(zero_copy_only=False), 65536)
                kind = np.full(len(c), UNSEEN + 1, np.int64)
                c[at], kind[at] = table.field("c").to_numpy(zero_copy_only=False), met
                # words of this chunk alone have its own count, and their class follows from it
                for k in np.flatnonzero(kind > UNSEEN).tolist():
                    kind[k] = COMMON + xxhash.xxh64_intdigest(words[k], _SEED) % SHARED if c[k] else UNSEEN
                kind = kind.astype("<u2")
                tokens = _unpacked(row.column("tokens")[0].as_py(), "<u4")
                lengths = row.column("lengths").flatten().to_numpy()
                heads = np.cumsum(lengths) - lengths
                base = np.log10((c + 1) * unseen)
                inside = np.where(c > 0, np.log10((c + 1) / np.maximum(mass[kind], 1)), 0.0)
                sums = [np.add.reduceat(x[tokens], heads) for x in ((c > 0).astype(np.int64), base, inside)]
                lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x)) for x in sums]
                columns = [row.column("ids"), row.column("lengths"), pa.array([_packed(kind[tokens])], pa.binary()), *lists]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in CODED.split(", ")])

    joined = parts.join(codes, "chunk", "left").select("ids", "lengths", "tokens", "words", "learnt", "codes")
    return joined.mapInArrow(run, CODED)


@dataclass(frozen=True)
class Model:
    """Start of a document, start of a later stretch, moves from state to state, and emissions per class and state."""

    start: np.ndarray
    inner: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @staticmethod
    def of(start: np.ndarray, inner: np.ndarray, move: np.ndarray, emit: np.ndarray, mass: np.ndarray, unseen: float) -> Model:
        """A model from (expected) counts: starts and moves with one added, emissions mixed with the corpus's."""
        corpus = mass / max(mass.sum(), 1.0)
        emit = (1 - SHARE) * emit / np.maximum(emit.sum(0), 1e-12) + SHARE * corpus[:, None]
        emit *= (1 - unseen) / np.maximum(emit.sum(0), 1e-12)
        emit[UNSEEN] = unseen
        start, inner, move = (x + 1 for x in (start, inner, move))
        return Model(start / start.sum(), inner / inner.sum(), move / move.sum(1, keepdims=True), emit)

    @staticmethod
    def first(states: int, mass: np.ndarray, unseen: float) -> Model:
        """States that mostly stay, with fixed random factors on their emissions and moves."""
        rng = np.random.default_rng(77)
        emit = mass[:, None] * rng.gamma(1.0, 1.0, (CLASSES, states))
        move = 100 * (rng.gamma(1.0, 1.0, (states, states)) + 100 * np.eye(states))
        return Model.of(np.zeros(states), np.zeros(states), move, emit, mass, unseen)


class Counts:
    """Expected counts of a task."""

    def __init__(self, states: int):
        self.start, self.inner = np.zeros(states), np.zeros(states)
        self.move, self.emit = np.zeros((states, states)), np.zeros((CLASSES, states))
        self.log = 0.0

    def add(self, classes: np.ndarray, heads: np.ndarray, lengths: np.ndarray, opens: np.ndarray, model: Model) -> None:
        """Forward and backward over stretches, longest first; ``opens`` marks those that begin a document."""
        steps, rows, states = int(lengths[0]), len(heads), len(model.start)
        active = np.searchsorted(-lengths, -np.arange(steps), "left")
        alpha = np.empty((steps, rows, states), np.float32)
        scaled = np.empty_like(alpha)
        move, emit = model.move.astype(np.float32), model.emit.astype(np.float32)
        for t, m in enumerate(active):
            before = np.where(opens[:, None], model.start, model.inner).astype(np.float32) if t == 0 else alpha[t - 1, :m] @ move
            seen = emit[classes[heads[:m] + t]]
            now = before * seen
            scale = now.sum(1, keepdims=True)
            alpha[t, :m] = now / scale
            scaled[t, :m] = seen / scale
            self.log += float(np.log10(scale, dtype=np.float64).sum())
        beta = np.ones((rows, states), np.float32)
        for t in range(steps - 1, -1, -1):
            m = active[t]
            gamma = alpha[t, :m] * beta[:m]
            if t:
                after = scaled[t, :m] * beta[:m]
                self.move += model.move * (alpha[t - 1, :m].T @ after)
                beta[:m] = after @ move.T
            else:
                self.start += gamma[opens].sum(0)
                self.inner += gamma[~opens].sum(0)
            alpha[t, :m] = gamma
        flat = np.concatenate([alpha[t, :m] for t, m in enumerate(active)])
        at = np.concatenate([classes[heads[:m] + t] for t, m in enumerate(active)])
        for k in range(states):
            self.emit[:, k] += np.bincount(at, flat[:, k], CLASSES)

    def batch(self) -> pa.RecordBatch:
        """Whole numbers by class; the last rows hold starts, moves and the likelihood."""
        extra = np.vstack([self.start, self.inner, self.move, np.eye(1, len(self.start)) * self.log])
        values = np.rint(np.vstack([self.emit, extra]) / UNIT).astype(np.int64)
        met = np.flatnonzero(values.any(1))
        names = ["class", *(f"s{k}" for k in range(len(self.start)))]
        return pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), *(pa.array(values[met, k]) for k in range(len(self.start)))], names)


def _stretches(lengths: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of documents, longest first: first token, length, and whether a document begins there."""
    pieces = -(-lengths // STRETCH)
    owner = np.repeat(np.arange(len(lengths)), pieces)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    size = np.minimum(STRETCH, lengths[owner] - place * STRETCH)
    order = np.argsort(-size, kind="stable")
    return (heads[owner] + place * STRETCH)[order], size[order], (place == 0)[order]


def expected_counts(sequences: DataFrame, model: Model) -> np.ndarray:
    """Expected counts of all training documents: classes, start, inner start, moves and log10 likelihood, by state."""
    shared = sequences.sparkSession.sparkContext.broadcast(model)
    states = len(model.start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(states)
        for batch in batches:
            for k in range(batch.num_rows):
                learns = np.array([i is not None and fold(i) != 2 for i in batch.column(0)[k].as_py()])
                lengths = batch.column(1).slice(k, 1).flatten().to_numpy().astype(np.int64)
                classes = _unpacked(batch.column(2)[k].as_py(), "<u2")
                heads = np.cumsum(lengths) - lengths
                first, size, opens = _stretches(lengths[learns], heads[learns])
                for low in range(0, len(first), TOGETHER):
                    some = slice(low, low + TOGETHER)
                    counts.add(classes, first[some], size[some], opens[some], shared.value)
        yield counts.batch()

    names = [f"s{k}" for k in range(states)]
    schema = ", ".join(f"{n} long" for n in ["class", *names])
    parts = sequences.select("ids", "lengths", "classes").mapInArrow(run, schema)
    with cleaned(sequences.sparkSession):
        total = parts.groupBy("class").agg(*(F.sum(n).alias(n) for n in names)).toArrow()  # a row per class
    out = np.zeros((CLASSES + states + 3, states))
    out[total.column("class").to_numpy()] = np.stack([total.column(n).to_numpy() for n in names], 1) * UNIT
    return out


def trained(sequences: DataFrame, vocab: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> tuple[Model, list[float]]:
    """Baum-Welch from a fixed beginning; also the log10 likelihood (of classes, by stretches) before each round."""
    model, likelihood = Model.first(states, vocab.mass, vocab.unseen), []
    for _ in range(rounds):
        sums = expected_counts(sequences, model)
        emit, (start, inner, *move, log) = sums[:CLASSES], sums[CLASSES:]
        likelihood.append(float(log[0]))
        model = Model.of(start, inner, np.array(move), emit, vocab.mass, vocab.unseen)
    return model, likelihood


def forward(classes: np.ndarray, heads: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """log10 probability of whole class sequences by the scaled forward recursion; all are taken one token on at once."""
    order = np.argsort(-lengths, kind="stable")
    heads, size = heads[order], lengths[order]
    out = np.zeros(len(size))
    active = np.searchsorted(-size, -np.arange(int(size.max(initial=0))), "left")
    state = np.broadcast_to(model.start, (len(size), len(model.start)))
    for t, m in enumerate(active):
        now = (state[:m] @ model.move if t else state) * model.emit[classes[heads[:m] + t]]
        scale = now.sum(1)
        out[:m] += np.log10(scale)
        state = now / scale[:, None]
    back = np.empty_like(out)
    back[order] = out
    return back


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scored(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Held-out documents are scored but never counted or trained on. Null and blank texts are an end token alone.
    Rows without doc_id are scored, not learnt from and not marked as held out; repeated rows are learnt from and scored one by one; without
    any training document every word is unseen and has probability 1 in both models; an empty table gives no rows; other columns
    are not read.
    """
    parts = stored(chunks(docs))
    vocab = vocabulary(parts)
    sequences = stored(coded(parts, vocab))
    model, _ = trained(sequences, vocab, states, rounds if vocab.tokens else 0)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    tokens = vocab.tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids = batch.column(0)[k].as_py()
                lengths, known, base, inside = (batch.column(c).slice(k, 1).flatten().to_numpy() for c in (1, 3, 4, 5))
                lengths = lengths.astype(np.int64)
                classes = _unpacked(batch.column(2)[k].as_py(), "<u2")
                score = forward(classes, np.cumsum(lengths) - lengths, lengths, shared.value) + inside
                held = [i is not None and fold(i) == 2 for i in ids]
                all_tokens = np.full(len(ids), tokens, np.int64)
                columns = [pa.array(ids, pa.int64()), pa.array(held), *(pa.array(x) for x in (lengths, known, all_tokens, base, score))]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SCORED.split(", ")])

    return sequences.mapInArrow(run, SCORED)

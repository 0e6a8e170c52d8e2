"""Quality rules: how far a document's character and word use is from its language's.

References are histograms over all texts of a language: of character classes, and of the
language's most common words (by a hash) against all other words. A document is compared
with the references of all common languages and of its own language by Jensen-Shannon distance and the nearest one
counts, so a wrong label harms nothing among common languages. Short documents, whose histograms say little, and documents
of languages with too little text for a reference are not judged by distance.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from guestlens.llm import textbytes as tb

WORD_BITS = 13
COMMON = 64
#: Languages with a smaller share of all words are compared with their own documents only; hence at most so many references on the driver.
LEAST_SHARE = 1 / 200
#: Characters of all texts of a language that make a reference.
LEAST_TEXT = 20_000
POOLED = "(all)"
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Limits:
    """Greatest distances, and the characters and words that a text needs to be judged by them."""

    chars: float = 0.28
    words: float = 0.45
    least_chars: int = 300
    least_words: int = 25


def _classes() -> np.ndarray:
    """Character classes of bytes; bytes that continue a character have class -1."""
    kind = np.full(256, 12, np.int64)
    groups = [b" ", b"\n", b"\t\r\x0b\x0c", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,", b"!?", b"'\"-;:()", b"#*$%&|<>", b"@/\\=_~^+[]{}`"]
    for k, group in enumerate(groups):
        kind[list(group)] = k
    kind[0x80:0xC0] = -1
    kind[0xC0:] = 11
    return kind


CLASS = _classes()
N_CLASSES = 13


@dataclass
class Profile:
    """Counts of the rows of a slice."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    classes: np.ndarray
    word_rows: np.ndarray
    word_bins: np.ndarray


def _by_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _again(keys: np.ndarray) -> np.ndarray:
    """Which keys are equal to an earlier one."""
    again = np.ones(len(keys), bool)
    again[np.unique(keys, return_index=True)[1]] = False
    return again


def profile(part: tb.Slice) -> Profile:
    data, offsets, rows = part.data, part.offsets, len(part)
    found = tb.words(part)
    bytes_of = tb.Windows(data)
    hashes = bytes_of.hashes(found.starts, found.ends)
    word_rows = found.row_of()
    whole = (data & 0xC0) != 0x80
    kinds = CLASS[data]
    row_of_byte = np.repeat(np.arange(rows), np.diff(offsets))
    classes = np.bincount(row_of_byte[whole] * N_CLASSES + kinds[whole], minlength=rows * N_CLASSES).reshape(rows, N_CLASSES)

    feeds = np.flatnonzero(data == 10)
    begins = np.sort(np.concatenate([offsets[:-1], feeds + 1]))
    line_row = np.searchsorted(offsets, begins, "right") - 1
    inside = begins < len(data)
    begins, line_row = begins[inside], line_row[inside]
    ends = np.append(begins[1:], len(data)) if len(begins) else begins
    cut = np.zeros(len(data) + 1, bool)
    cut[feeds + 1] = True
    ends = ends - (cut[ends] & (ends > begins))
    has_word = np.searchsorted(found.starts, ends) > np.searchsorted(found.starts, begins)
    begins, ends, line_row = begins[has_word], ends[has_word], line_row[has_word]
    again = _again(tb.mixed(bytes_of.hashes(begins, ends) + tb.mixed(line_row.astype(np.uint64))))

    five = tb.grams(hashes, 5)
    window_row = word_rows[: len(five)]
    starts = np.flatnonzero(np.arange(len(five)) + 5 <= np.repeat(found.first[1:], np.diff(found.first))[: len(five)])
    keys = tb.mixed(five[starts] + tb.mixed(window_row[starts].astype(np.uint64)))
    _, which, uses = np.unique(keys, return_inverse=True, return_counts=True)
    twice = starts[uses[which] > 1]
    steps = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(steps, twice, 1)
    np.add.at(steps, twice + 5, -1)
    return Profile(
        np.diff(found.first),
        _by_row(whole & ~tb.WHITE[data], offsets),
        _by_row(SYMBOLS[data], offsets),
        np.bincount(line_row[again], minlength=rows),
        _by_row(np.cumsum(steps[:-1]) > 0, found.first),
        classes,
        word_rows,
        (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64),
    )


def base_failed(p: Profile) -> np.ndarray:
    return (p.n_words < 10) | (100 * p.n_repeat_words > 20 * p.n_words)


@dataclass
class References:
    """Shares of character classes per reference, and its common word bins with their shares (the last: all others)."""

    classes: np.ndarray
    bins: list[np.ndarray]
    shares: list[np.ndarray]


def counts(docs: DataFrame) -> DataFrame:
    """lang, kind (0 class, 1 word bin), bin, n: summed in every task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        width = N_CLASSES + (1 << WORD_BITS)

        def out() -> Iterator[pa.RecordBatch]:
            for lang, own in sums.items():
                at = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at], pa.int64())], ["lang", "bin", "n"])
            sums.clear()

        for batch in batches:
            langs = np.array([x or "" for x in batch.column(0).to_pylist()], object)
            for part in tb.slices(batch.column(1)):
                p = profile(part)
                names, which = np.unique(langs[part.first : part.first + len(part)].astype(str), return_inverse=True)
                chars = np.zeros((len(names), N_CLASSES), np.int64)
                np.add.at(chars, which, p.classes)
                used = np.bincount(which[p.word_rows] * (1 << WORD_BITS) + p.word_bins, minlength=len(names) << WORD_BITS).reshape(len(names), -1)
                for k, name in enumerate(names):
                    sums.setdefault(str(name), np.zeros(width, np.int64))
                    sums[str(name)] += np.concatenate([chars[k], used[k]])
                if len(sums) > 64:
                    yield from out()
        yield from out()

    return docs.select(F.col("lang").cast("string"), "text").mapInArrow(run, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))


def _reference_rows(summed: DataFrame) -> DataFrame:
    """lang, bin, share: of the character classes and of the COMMON most frequent word bins."""
    words = F.col("bin") >= N_CLASSES
    place = F.row_number().over(W.partitionBy("lang", words).orderBy(F.desc("n"), "bin"))
    share = F.col("n") / F.sum("n").over(W.partitionBy("lang", words))
    rows = summed.withColumn("place", place).withColumn("share", share)
    return rows.filter((F.col("bin") < N_CLASSES) | (F.col("place") <= COMMON)).select("lang", "bin", "share")


def references(docs: DataFrame) -> tuple[References, list[str], DataFrame | None]:
    """References of the languages that hold a fair share of all words, and one of all texts; those languages; and the other references.

    What reaches the driver is bounded: 1 / LEAST_SHARE languages with COMMON words each. The others stay in
    Spark, a row per language: lang, own (bin and share). There is no table of them if all texts are of the languages before.
    """
    from guestlens.llm.frames import stored

    summed = stored(counts(docs))
    words = F.col("bin") >= N_CLASSES
    per_language = summed.groupBy("lang").agg(F.sum(F.when(words, F.col("n"))).alias("own"), F.sum(F.when(~words, F.col("n"))).alias("chars"))
    total = per_language.agg(F.sum("own")).first()[0] or 0
    enough = F.col("chars") >= LEAST_TEXT
    large = [r["lang"] for r in per_language.filter(enough & (F.col("own") >= LEAST_SHARE * total)).collect()] if total else []
    pooled = summed.groupBy("bin").agg(F.sum("n").alias("n")).select(F.lit(POOLED).alias("lang"), "bin", "n")
    rows = _reference_rows(summed.filter(F.col("lang").isin(large))).collect()
    rows += _reference_rows(pooled).collect()
    out = References(np.zeros((0, N_CLASSES)), [], [])
    for lang in [*sorted(large), POOLED]:
        own = sorted((r["bin"], r["share"]) for r in rows if r["lang"] == lang)
        chars = np.zeros(N_CLASSES)
        for k, s in own:
            if k < N_CLASSES:
                chars[k] = s
        common = [(k - N_CLASSES, s) for k, s in own if k >= N_CLASSES]
        out.classes = np.vstack([out.classes, chars])
        out.bins.append(np.array([k for k, _ in common], np.int64))
        out.shares.append(np.array([*(s for _, s in common), max(0.0, 1 - sum(s for _, s in common))]))
    rest = per_language.filter(~F.col("lang").isin(large))
    if rest.isEmpty():
        return out, large, None
    others = _reference_rows(summed.join(rest.filter(enough).select("lang"), "lang", "left_semi"))
    return out, large, stored(others.groupBy("lang").agg(F.collect_list(F.struct("bin", "share")).alias("own")))


def distance(counted: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) of each row of counts to ``shares``; 0 for rows without counts."""
    sums = counted.sum(1, keepdims=True)
    p = counted / np.maximum(sums, 1)
    m = (p + shares) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(1)
        right = np.where((shares > 0) & (m > 0), shares * np.log2(shares / m), 0).sum(1)
    return np.where(sums[:, 0] > 0, np.sqrt(np.clip((left + right) / 2, 0, 1)), 0.0)


def distances(p: Profile, to: References) -> tuple[np.ndarray, np.ndarray]:
    """Distance of each row to its nearest reference, by character classes and by words."""
    rows = len(p.n_words)
    chars = np.min([distance(p.classes, s) for s in to.classes], axis=0)
    best = np.full(rows, np.inf)
    for bins, shares in zip(to.bins, to.shares, strict=True):
        slot = np.full(1 << WORD_BITS, len(bins), np.int64)
        slot[bins] = np.arange(len(bins))
        width = len(bins) + 1
        counted = np.bincount(p.word_rows * width + slot[p.word_bins], minlength=rows * width).reshape(rows, width)
        best = np.minimum(best, distance(counted, shares))
    return chars, best


def own_distances(p: Profile, langs: pa.Array, own: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distance of each row to the reference that came with it, by character classes and by words, and which rows have one."""
    rows = len(p.n_words)
    _, first, which = np.unique(np.array(langs.to_pylist()).astype(str), return_index=True, return_inverse=True)
    classes, shares = np.zeros((len(first), N_CLASSES)), np.zeros((len(first), COMMON + 1))
    slot = np.full((len(first), 1 << WORD_BITS), COMMON, np.int16)
    for k, at in enumerate(first.tolist()):
        place = 0
        for one in own[at].as_py() or ():
            if one["bin"] < N_CLASSES:
                classes[k, one["bin"]] = one["share"]
            else:
                slot[k, one["bin"] - N_CLASSES] = place
                shares[k, place] = one["share"]
                place += 1
        shares[k, COMMON] = max(0.0, 1 - shares[k].sum())
    width = COMMON + 1
    counted = np.bincount(p.word_rows * width + slot[which[p.word_rows], p.word_bins], minlength=rows * width).reshape(rows, width)
    held = own.is_valid().to_numpy(zero_copy_only=False)
    chars, words = distance(p.classes, classes[which]), distance(counted, shares[which])
    return np.where(held, chars, np.inf), np.where(held, words, np.inf), held


def verdict(p: Profile, chars: np.ndarray, words: np.ndarray, limits: Limits, judged: np.ndarray | bool = True) -> np.ndarray:
    """True where a document is kept; only ``judged`` ones can be too far away."""
    far = (p.classes.sum(1) >= limits.least_chars) & (chars > limits.chars)
    far |= (p.n_words >= limits.least_words) & (words > limits.words)
    return ~base_failed(p) & ~(far & judged)


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, char_distance double, word_distance double"


def _measures(part: tb.Slice, to: References, limits: Limits, langs: pa.Array | None = None, own: pa.Array | None = None) -> list[pa.Array]:
    p = profile(part)
    chars, words = distances(p, to)
    judged = True
    if own is not None:
        own_chars, own_words, judged = own_distances(p, langs, own)
        chars, words = np.minimum(chars, own_chars), np.minimum(words, own_words)
    whole = [pa.array(x, pa.int64()) for x in (p.n_words, p.word_chars, p.n_symbols, p.n_dup_lines, p.n_repeat_words)]
    return [*whole, pa.array(base_failed(p)), pa.array(verdict(p, chars, words, limits, judged)), pa.array(chars), pa.array(words)]


def _judged(docs: DataFrame, limits: Limits, columns: list[str], output: Callable[[pa.RecordBatch, list[pa.Array]], pa.RecordBatch], schema: StructType | str) -> DataFrame:
    """``output`` of every slice of the ``columns`` of ``docs`` and its measures; languages without a place among the common ones bring their reference along."""
    to, large, others = references(docs)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for part in tb.slices(batch.column(at)):
                rows = batch.slice(part.first, len(part))
                with_own = [rows.column(batch.schema.get_field_index(c)) for c in ("__lang", "__own") if c in batch.schema.names]
                yield output(rows.select(columns), _measures(part, to, limits, *with_own))

    if others is None:
        return docs.select(*columns).mapInArrow(run, schema)
    common = docs.filter(lang.isin(large)).select(*columns).mapInArrow(run, schema)
    rest = docs.filter(~lang.isin(large)).select(*columns, lang.alias("__lang"))
    brought = rest.join(others.select(F.col("lang").alias("__lang"), F.col("own").alias("__own")), "__lang", "left")
    return common.unionByName(brought.mapInArrow(run, schema))


def measured(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and the distances.

    Null and empty texts have no words, fail the base rule and have distance 0. Repeated rows
    have equal results; an empty table gives no rows; columns other than doc_id, text and lang
    are not read, and ``lang`` (may be null, which counts as one language) says which texts a reference is made of. Rows of a language
    with fewer than LEAST_TEXT characters in all have distances to the references of others, but only the base rule can reject them.
    """

    def output(rows: pa.RecordBatch, measures: list[pa.Array]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([rows.column(0), *measures], ["doc_id", *(f.split()[0] for f in MEASURES.split(", "))])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    return _judged(own, limits, ["doc_id", "text"], output, f"doc_id long, {MEASURES}")


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they are."""
    return _judged(docs, limits, docs.columns, lambda rows, measures: rows.filter(measures[6]), docs.schema)

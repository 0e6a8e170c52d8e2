"""Near-duplicate documents: MinHash banding with sequential Bayesian verification.

A document is the set of its distinct word shingles. Equal sets become one class before
anything is compared. Classes that share a band of their MinHash signature are candidates.
A candidate pair's signatures are compared batch by batch; once the posterior probability
that the similarity reaches the threshold falls below the miss probability the pair is
dropped. Survivors are checked on the full sets.

Groups are never written out as pairs. First every member of a band is compared with the
member that shares most bands with others; in large bands also with those of the members that
share one more band. Bands that still hold several components are searched further: members
outside the band's main component against all, in blocks of bounded size, and a block
returns no more links than it has members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestlens.llm import textbytes as tb
from guestlens.llm.components import connected
from guestlens.llm.frames import stored

BANDS, BAND_ROWS = 16, 4
HASHES = BANDS * BAND_ROWS
BATCH = 16
BLOCK, CHUNK = 128, 512
#: Bands of more members are also searched together with another band, so many places on.
LARGE, PLACES_ON = 16, (1, 2, 5)
MISS = 1e-6
_rng = np.random.default_rng(4711)
_SCALE = _rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFT = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)


@dataclass(frozen=True)
class Rule:
    """Shingle length in words, and the least similarity in percent of the union."""

    shingle: int = 5
    percent: int = 80
    miss: float = MISS

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        small, large = (a, b) if len(a) <= len(b) else (b, a)
        if 100 * len(small) < self.percent * len(large):
            return False
        at = np.minimum(np.searchsorted(large, small), len(large) - 1)
        both = int((large[at] == small).sum())
        return 100 * both >= self.percent * (len(a) + len(b) - both)

    def least_matches(self) -> list[tuple[int, int]]:
        """After each batch of hashes: how many must agree for the pair to stay.

        With a uniform prior, m agreements of n give a Beta(m + 1, n - m + 1) posterior, whose
        mass above t is the probability of at most m successes in n + 1 trials of chance t.
        """
        t, out = self.percent / 100, []
        for n in range(BATCH, HASHES + 1, BATCH):
            mass, m = 0.0, 0
            while True:
                mass += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
                if mass >= self.miss:
                    break
                m += 1
            out.append((n, m))
        return out


def shingle_sets(part: tb.Slice, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every row; too short texts are one shingle, empty ones none."""
    data = tb.LOWER[part.data]
    found = tb.words(part)
    hashes = tb.Windows(data).hashes(found.starts, found.ends)
    whole = tb.grams(hashes, size)
    for low, high in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        if high - low >= size:
            yield np.unique(whole[low : high - size + 1])
        else:
            yield tb.grams(hashes[low:high], high - low, salt=high - low) if high > low else np.zeros(0, np.uint64)


def signature(own: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    small = (own >> np.uint64(32)).astype(np.uint32)
    for low in range(0, len(small), 1 << 14):
        np.minimum(out, (small[None, low : low + (1 << 14)] * _SCALE[:, None] + _SHIFT[:, None]).min(1), out=out)
    return out


def band_keys(sign: np.ndarray) -> np.ndarray:
    rows = sign.reshape(BANDS, BAND_ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(BAND_ROWS):
        key = tb.mixed(key * np.uint64(0x9FB21C651E98DF25) + rows[:, k])
    return key


def _features(docs: DataFrame, rule: Rule) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.slices(batch.column(1)):
                sizes, keys, signs, bands = [], [], [], []
                for own in shingle_sets(part, rule.shingle):
                    sizes.append(len(own))
                    keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                    sign = signature(own)
                    signs.append(sign.tobytes())
                    bands.append(band_keys(sign).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, len(part)), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "key", "sign", "bands"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_shingles long, key binary, sign binary, bands array<long>")


def _sets(docs: DataFrame, rule: Rule) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.slices(batch.column(1)):
                rows = [own.tobytes() for own in shingle_sets(part, rule.shingle)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.first, len(part)), pa.array(rows, pa.binary())], ["id", "own"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "id long, own binary")


def _likely(pairs: DataFrame, signs: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) that pass the sequential test."""
    steps = rule.least_matches()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x, y = (np.frombuffer(b"".join(batch[c]), np.uint32).reshape(-1, HASHES) for c in ("x", "y"))
                yield batch.loc[_pass(x, y, steps), ["a", "b"]]

    left, right = (signs.select(F.col("id").alias(c), F.col("sign").alias(v)) for c, v in (("a", "x"), ("b", "y")))
    return pairs.join(left, "a").join(right, "b").mapInPandas(run, "a long, b long")


def _pass(x: np.ndarray, y: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Which rows of ``x`` and ``y`` are still possible after all batches; the rest leaves early."""
    alive, agree, done = np.arange(len(x)), np.zeros(len(x), np.int64), 0
    for n, least in steps:
        agree = agree + (x[alive, done:n] == y[alive, done:n]).sum(1)
        stays = agree >= least
        alive, agree, done = alive[stays], agree[stays], n
    return alive


def _confirmed(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Pairs whose full sets reach the similarity."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = [rule.linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(batch["x"], batch["y"], strict=True)]
            yield batch.loc[good, ["a", "b"]]

    left, right = (sets.select(F.col("id").alias(c), F.col("own").alias(v)) for c, v in (("a", "x"), ("b", "y")))
    return pairs.join(left, "a").join(right, "b").mapInPandas(run, "a long, b long")


def _within_blocks(members: DataFrame, rule: Rule) -> DataFrame:
    """Links between different components of a band, block by block of its members.

    ``members``: band, i, j, left, id, component, sign, bands, own. A group holds a block of members
    outside the main component (``left``) and a chunk of all members. A pair is looked at in the first band it shares only.
    """
    steps = rule.least_matches()

    def run(group: pd.DataFrame) -> pd.DataFrame:
        signs = np.frombuffer(b"".join(group["sign"]), np.uint32).reshape(-1, HASHES)
        bands = np.stack(group["bands"].to_numpy())
        own = [np.frombuffer(x, np.uint64) for x in group["own"]]
        ids, comps, left = group["id"].tolist(), group["component"].to_numpy(), group["left"].to_numpy()
        x, y = (p.ravel() for p in np.meshgrid(np.flatnonzero(left), np.flatnonzero(~left), indexing="ij"))
        wanted = comps[x] != comps[y]
        x, y = x[wanted], y[wanted]
        if len(x):
            place = (bands[0] == group["band"].iloc[0]).argmax()
            first = (bands[x] == bands[y]).argmax(1) == place
            x, y = x[first], y[first]
            kept = _pass(signs[x], signs[y], steps)
            x, y = x[kept], y[kept]
            nearest = np.argsort(-(signs[x] == signs[y]).sum(1), kind="stable")
            x, y = x[nearest], y[nearest]
        root = {c: c for c in set(comps.tolist())}

        def top(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        links = []
        for p, q in zip(x.tolist(), y.tolist(), strict=True):
            a, b = top(int(comps[p])), top(int(comps[q]))
            if a != b and rule.linked(own[p], own[q]):
                root[max(a, b)] = min(a, b)
                links.append((ids[p], ids[q]))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return members.groupBy("band", "i", "j").applyInPandas(run, "a long, b long")


def classes_and_components(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Features of every row of ``docs``, and (id, component) of the linked class representatives."""
    features = stored(_features(docs, rule))
    one = stored(
        features.filter("n_shingles > 0 and doc_id is not null")
        .groupBy("key")
        .agg(F.min("doc_id").alias("id"), F.first("sign").alias("sign"), F.first("bands").alias("bands"))
    )
    rows = one.select("id", F.posexplode("bands").alias("place", "band"), "bands")
    buckets = rows.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    grouped = stored(rows.join(buckets, "band"))
    scores = grouped.groupBy("id").agg(F.sum("size").alias("score"))
    scored = grouped.join(scores, "id")
    large = scored.filter(F.col("size") > LARGE)
    keyed = [scored.select("id", "score", F.col("band").alias("spot"))]
    keyed += [large.select("id", "score", F.xxhash64("band", F.element_at("bands", (F.col("place") + on) % BANDS + 1)).alias("spot")) for on in PLACES_ON]
    spots = stored(reduce(DataFrame.unionByName, keyed))
    pivots = spots.groupBy("spot").agg(F.max_by("id", F.struct("score", "id")).alias("pivot"))
    star = spots.join(pivots, "spot").filter("id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
    wanted = grouped.select(F.col("id").alias("doc_id")).distinct()
    sets = stored(_sets(docs.select(F.col("doc_id").cast("long"), "text").join(wanted, "doc_id", "left_semi"), rule))
    links = stored(_confirmed(_likely(star, one.select("id", "sign"), rule), sets, rule))
    found = stored(connected(links))
    labelled = grouped.filter("size > 2").select("band", "size", "id").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    parts = labelled.groupBy("band", "component").agg(F.count("*").alias("held"))
    main = parts.groupBy("band").agg(F.max_by("component", F.struct("held", "component")).alias("main"), F.sum("held").alias("all"), F.max("held").alias("most"))
    mixed = labelled.join(main.filter("most < all"), "band")
    lefts, chunks = F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("int"), F.ceil(F.col("all") / CHUNK).cast("int")
    own = F.xxhash64("id")
    left = mixed.filter("component <> main").select("band", F.pmod(own, lefts).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("j"), F.lit(True).alias("left"), "id", "component")
    right = mixed.select("band", F.explode(F.sequence(F.lit(0), lefts - 1)).alias("i"), F.pmod(own, chunks).cast("int").alias("j"), F.lit(False).alias("left"), "id", "component")
    spread = left.unionByName(right)
    more = _within_blocks(spread.join(one.select("id", "sign", "bands"), "id").join(sets, "id"), rule)
    links = links.unionByName(more)
    ids = one.select("key", "id")
    return features.select("doc_id", "n_shingles", "key").join(ids, "key", "left"), stored(connected(links))


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest doc_id that links reach, ``kept`` marks its document. Null
    and empty texts have no shingle and are linked with nothing; repeated rows of a document
    share its result; rows without doc_id link nothing, have the component of an equal text if there is one, and are kept if not;
    an empty table gives no rows; other columns of ``docs`` are not read.
    A pair at the threshold is missed with a probability below 1e-4, more similar ones less.
    """
    features, found = classes_and_components(docs, rule)
    return (
        features.join(found, "id", "left")
        .withColumn("component_id", F.coalesce("component", "id", "doc_id"))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
    )


def keep_one(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``docs`` without all but one document of each near-duplicate group; columns as they are, rows without doc_id stay."""
    gone = near_duplicates(docs, rule).groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).filter("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti")

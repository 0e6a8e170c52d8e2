"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are short and documents long, so the share of an item's shingles that a document
holds is estimated from the item's side: an item's sketch is its smallest shingle hashes, and
the hits among them estimate the containment whatever the document's size. Items are partitioned
by size; a partition's sketch is the whole set for small items. A document is compared only
with partitions whose items it is large enough to hold. Pairs whose hits could come from a containment at the
threshold are verified on all shingles.

Only SQL functions are used. The sketches are broadcast if their counted rows allow it, else joined by a shuffle.
"""

from __future__ import annotations

from math import ceil, comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from guestlens.llm.shingles import shingle_hashes, word_list

SHINGLE = 5
PERCENT = 80
SKETCH = 24
MISS = 1e-7
BROADCAST_ROWS = 1_000_000


def least_hits(total: int, percent: int = PERCENT, miss: float = MISS) -> int:
    """Hits in a sketch that a set of ``total`` shingles with the wanted containment misses with chance ``miss`` at most.

    The sketch is a draw without replacement, so hits are hypergeometric; the whole set is exact.
    """
    held, size = ceil(percent * total / 100), min(total, SKETCH)
    mass, hits = 0.0, max(0, size - (total - held))
    while True:
        mass += comb(held, hits) * comb(total - held, size - hits) / comb(total, size)
        if mass > miss or hits >= size:
            return hits
        hits += 1


def _size_class(size: Column) -> Column:
    return F.coalesce(F.floor(F.log2(F.greatest(size, F.lit(1)))).cast("int"), F.lit(0))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _shingled(df: DataFrame, key: str, size: int) -> DataFrame:
    """key, ``size_class`` and ``h``: one row per shingle of the lower-case words, with repeats; 0 for texts without any.

    The outer explode and the replaced nulls keep Spark from inferring a filter on the list, which would hash every text again.
    """
    words = df.select(F.col(key).cast("long").alias(key), word_list(F.lower("text")).alias("words"))
    hashes = words.select(key, shingle_hashes(F.col("words"), size).alias("hashes"))
    rows = hashes.select(key, _size_class(F.size("hashes")).alias("size_class"), F.explode_outer("hashes").alias("h"))
    return rows.withColumn("h", F.coalesce("h", F.lit(0)))


def contaminated(docs: DataFrame, items: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Pairs of a document and an item of which it holds at least ``percent`` of the shingles.

    Returns doc_id, item_id, n_item (distinct shingles of the item), n_shared (those in the document). Items
    and documents of fewer than ``size`` words are one shingle, so that such an item matches whole documents only and is not found
    inside a longer one; null and empty ones have none and never match. Rows of equal doc_id count as one document, rows of equal item_id as one item.
    Without items or documents there are no pairs; other columns are not read.
    """
    own = _shingled(items, "item_id", size).select("item_id", "h").filter("h <> 0").distinct()
    own = own.withColumn("n_item", F.count("*").over(W.partitionBy("item_id")))
    sizes = [r["n_item"] for r in own.select("n_item").distinct().collect()]
    rows = own.count()
    place = F.row_number().over(W.partitionBy("item_id").orderBy("h"))
    sketch = own.withColumn("place", place).filter(F.col("place") <= SKETCH).drop("place")
    sketch = sketch.withColumn("least_class", _size_class(F.ceil(F.col("n_item") * percent / 100)))
    found = _shingled(docs, "doc_id", size).join(_small(sketch, rows), "h").filter("size_class >= least_class")
    hits = found.select("doc_id", "item_id", "n_item", "h").distinct().groupBy("doc_id", "item_id", "n_item").agg(F.count("*").alias("hits"))
    if sizes:
        needed = F.element_at(F.create_map(*[F.lit(x) for n in sorted(sizes) for x in (n, least_hits(n, percent))]), F.col("n_item").cast("int"))
        hits = hits.filter(F.col("hits") >= needed)
    wanted = hits.select("doc_id", "item_id")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    full = _shingled(texts, "doc_id", size).join(_small(own, rows), "h")
    return (
        full.select("doc_id", "item_id", "n_item", "h")
        .distinct()
        .groupBy("doc_id", "item_id", "n_item")
        .agg(F.count("*").alias("n_shared"))
        .join(wanted, ["doc_id", "item_id"], "left_semi")
        .filter(F.col("n_shared") * 100 >= F.col("n_item") * percent)
        .select("doc_id", "item_id", "n_item", "n_shared")
    )


def without_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with their columns as they are; rows without doc_id stay."""
    return docs.join(contaminated(docs, items).select("doc_id").distinct(), "doc_id", "left_anti")

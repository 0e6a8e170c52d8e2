"""Incremental batches against the one-shot rule."""

import random
from functools import reduce

import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestlens.operators import dedup, seen

SCHEMA = "id string, band int, row int, batch string"


def some_rows(n=3000):
    rng = random.Random(2)
    rows = [(rng.choice([f"k{rng.randrange(900)}", "hot", None, ""]), rng.randrange(4), i, "b") for i in range(n)]
    return rows + [(f"new{i}", 3, n + i, "b") for i in range(2000)]


def one_shot(df):
    return sorted(r.row for r in dedup.dedup_across_batches(df, "id", "band").collect())


def run(store, df, folder, bands=range(4)):
    kept = [store.take(df.where(F.col("band") == b), "id", b, f"{folder}/kept{b}") for b in bands]
    return sorted(r.row for r in reduce(DataFrame.unionByName, kept).collect())


@pytest.mark.parametrize("options", [{}, {"blocks": 1}, {"most": 0}])
def test_batches_equal_the_one_shot_rule(spark, tmp_path, options):
    """Also with a filter so small that it lets almost all through, and without one."""
    df = spark.createDataFrame(some_rows(), SCHEMA)
    assert run(seen.SeenIds(spark, str(tmp_path / "store"), **options), df, tmp_path) == one_shot(df)


def test_repeated_and_broken_batches(spark, tmp_path):
    df = spark.createDataFrame(some_rows(600), SCHEMA)
    store = seen.SeenIds(spark, str(tmp_path / "store"))
    expected = one_shot(df)
    assert run(store, df, tmp_path, range(4)) == expected
    assert run(store, df, tmp_path) == expected  # all batches again
    ids = sorted(map(tuple, store.ids().collect()))
    # a run that stored its rows and filter, but not its ids
    part = df.where("band = 2")
    store.unseen(part, "id", 2).write.mode("overwrite").parquet(str(tmp_path / "kept2"))
    seen.filter_blocks(seen.id_hash(part.where("id IS NOT NULL"), "id"), store.blocks).write.mode("overwrite").parquet(str(tmp_path / "store/filter/batch=2"))
    late = {x.row for x in df.where("band >= 2").collect()}
    assert run(store, df, tmp_path, [2, 3]) == [r for r in expected if r in late]
    assert sorted(map(tuple, store.ids().collect())) == ids
    assert len(ids) == len({i for i, _ in ids})  # every id once, with its first batch


def test_filter_meets_all_it_holds_and_few_others(spark, tmp_path):
    store = seen.SeenIds(spark, str(tmp_path / "store"), blocks=8)
    old = spark.range(20_000).select(F.concat(F.lit("old"), "id").alias("id"))
    store.add(old, "id", 0)
    assert store.marked(old, "id", 1).where("NOT __maybe").count() == 0
    new = spark.range(20_000).select(F.concat(F.lit("new"), "id").alias("id"))
    assert store.marked(new, "id", 1).where("__maybe").count() < 0.05 * 20_000
    assert store.marked(old, "id", 0).where("__maybe").count() == 0  # earlier batches only
    assert store.unseen(old, "id", 1).count() == 0 and store.unseen(new, "id", 1).count() == 20_000


def test_whole_numbers_and_other_columns(spark, tmp_path):
    store = seen.SeenIds(spark, str(tmp_path / "store"))
    df = spark.createDataFrame([(5, "x", "y"), (5, "x", "z"), (None, None, None)], "key long, batch string, block string")
    assert store.take(df, "key", 1, str(tmp_path / "one")).columns == ["key", "batch", "block"]
    assert sorted(str(r.block) for r in store.take(df, "key", 2, str(tmp_path / "two")).collect()) == ["None"]


def test_empty_batches(spark, tmp_path):
    store = seen.SeenIds(spark, str(tmp_path / "store"))
    none = spark.createDataFrame([], SCHEMA)
    assert store.take(none, "id", 0, str(tmp_path / "k0")).collect() == []
    df = spark.createDataFrame(some_rows(50), SCHEMA).limit(50)
    assert store.take(df, "id", 1, str(tmp_path / "k1")).count() == 50


def test_bits_stay_in_their_block():
    block, bits = seen.bit_places(np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000), 16)
    assert block.min() >= 0 and block.max() < 16 and bits.min() >= 0 and bits.max() < seen.BLOCK_BITS
    assert len(np.unique(block)) == 16 and np.unique(bits, axis=1).shape == (5000, seen.HASHES)

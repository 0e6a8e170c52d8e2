"""Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guestlens import session
from guestlens.session import shuffle_width

__all__ = ["cleaned", "numbered", "packed", "shuffle_width", "stored", "table", "written"]

#: Lets Spark delete the shuffle files of a query when it has ended.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside are deleted when these have ended."""
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEAN)
        else:
            spark.conf.set(_CLEAN, before)


def stored(df: DataFrame) -> DataFrame:
    """``df`` in the shared checkpoint folder. Its rows are safe there, so the shuffle files that led to them are deleted."""
    with cleaned(df.sparkSession):
        return session.stored(df.select("*"))  # the setting holds for plans that are made under it


def written(df: DataFrame, codec: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: smaller than a checkpoint, and read by column."""
    spark = df.sparkSession
    folder = session.checkpoint_folder(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{folder.rstrip('/')}/guestlens-{uuid.uuid4().hex}"
    with cleaned(spark):
        df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def packed(df: DataFrame) -> DataFrame:
    """``written`` with a codec that makes wide tables smaller still."""
    return written(df, "zstd")


def numbered(df: DataFrame, key: str, *order: str) -> DataFrame:
    """``df`` with ``number``: 0, 1, ... within each value of ``key``, which may hold most rows.

    Rows of a key are dealt to as many slices as there are shuffle tasks, numbered within
    their slice, and moved up by the sizes of the slices before; no task gets a whole key.
    """
    from pyspark.sql import Window as W

    slices = shuffle_width(df.sparkSession)
    dealt = df.withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(slices)))
    sizes = dealt.groupBy(key, "_slice").agg(F.count("*").alias("_size"))
    before = sizes.withColumn(
        "_before",
        F.coalesce(F.sum("_size").over(W.partitionBy(key).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
    ).drop("_size")
    within = dealt.withColumn("_place", F.row_number().over(W.partitionBy(key, "_slice").orderBy(*order)) - 1)
    return (
        within.join(before, [key, "_slice"])
        .withColumn("number", F.col("_before") + F.col("_place"))
        .select(*df.columns, "number")
    )

"""Readers and writers of the tables, always with an explicit schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guestlens.functions.text import strip
from guestlens.schemas import DISTRIBUTION, REVIEW

# Spellings that a CSV reader of the domain takes for a missing value.
MISSING_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """CSV with a header, quoted texts over several lines and doubled quotes.

    Columns are found by their names in the header: they may come in any order, absent
    ones are null and others are ignored; files of one call must share a header.
    Values are read as text and then cast, so a spelling of "missing" becomes null in
    any column and a bad number becomes null instead of tearing the row.
    """
    raw = spark.read.csv(
        list(path) if not isinstance(path, str) else path,
        header=True,
        inferSchema=False,
        multiLine=True,
        quote='"',
        escape='"',
        encoding="UTF-8",
        enforceSchema=False,
    )
    return raw.select(*(_typed(f) if f.name in raw.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))


def _typed(field: T.StructField) -> Column:
    text = F.when(~F.col(field.name).isin(*MISSING_WORDS), F.col(field.name))
    if isinstance(field.dataType, T.StringType):
        return text.alias(field.name)
    if isinstance(field.dataType, (T.IntegerType, T.LongType)):
        # a count that went through a table with gaps is written "3.0"
        text = F.regexp_replace(text, r"\.0+$", "")
    return text.try_cast(field.dataType).alias(field.name)


def read_reviews(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return read_csv(spark, path, REVIEW)


def read_distribution(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return read_csv(spark, path, DISTRIBUTION)


def _by_hotel(df: DataFrame, path: str, mode: str, partition: str | None) -> None:
    # rebalancing gathers the rows of a hotel into few files and still splits a very large hotel
    rows = df.hint("rebalance", partition) if partition else df
    writer = rows.write.mode(mode)
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def append_rows(df: DataFrame, path: str, partition: str | None = "hotel_name") -> None:
    """Adds rows to a columnar table, one folder per hotel; finished parts stay if a later run fails.

    A repeated run adds its rows again; ``put_pass`` replaces them.
    """
    _by_hotel(df, path, "append", partition)


def put_pass(df: DataFrame, path: str, name: str, partition: str = "hotel_name") -> None:
    """The rows that pass ``name`` collected, in one folder per pass and hotel (columns ``pass`` and ``partition``).

    What the pass had stored for these hotels is replaced, anything else stays. So a pass that
    is run twice, or broken half-way and repeated, leaves the table of a single run.
    """
    rows = df.withColumn("pass", F.lit(name)).hint("rebalance", partition)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("pass", partition).parquet(path)


def start_afresh(df: DataFrame, path: str, partition: str | None = "hotel_name") -> None:
    """The same, after clearing what an earlier pass left."""
    _by_hotel(df, path, "overwrite", partition)


def write_result(df: DataFrame, path: str, format: str = "csv") -> None:
    """A result table: CSV with header and doubled quotes, or a columnar file."""
    if format == "csv":
        df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', encoding="UTF-8")
    else:
        df.write.mode("overwrite").format(format).save(path)


def fill_forward(
    df: DataFrame, value: str, chunk: Sequence[str], order: Sequence[str], within: Sequence[str] = (), name: str = "filled"
) -> DataFrame:
    """Last value that is not null up to each row, in ``order`` inside ``within``.

    Rows are filled inside chunks first (``chunk`` columns must sort like the rows do).
    What a chunk hands on comes from a table of one row per chunk, so one long file is
    filled by many tasks.
    """
    within, chunk = list(within), list(chunk)
    scope = [*within, *chunk]
    inside = Window.partitionBy(*scope).orderBy(*order)
    last = F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order)))
    earlier = Window.partitionBy(*(within or [F.lit(0)])).orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        df.groupBy(*scope)
        .agg(last.alias("__last"))
        .withColumn("__carried", F.last("__last", ignorenulls=True).over(earlier))
        .drop("__last")
    )
    filled = df.withColumn("__own", F.last(value, ignorenulls=True).over(inside))
    joined = filled.join(carried, scope, "left")
    return joined.withColumn(name, F.coalesce("__own", "__carried")).drop("__own", "__carried")


def sections(lines: DataFrame, text: str, header: str, chunk: Sequence[str], order: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Adds ``section``: the first group of the last header line above each line, null before any.

    Header lines themselves and blank lines are left out.
    """
    bare = strip(F.col(text))
    found = F.when(F.regexp_like(bare, F.lit(header)), F.regexp_extract(bare, header, 1))
    marked = lines.withColumn("__header", found)
    filled = fill_forward(marked, "__header", chunk, order, within, "section")
    return filled.where(F.col("__header").isNull() & (bare != "")).drop("__header")


def read_sectioned(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Target list: (url, hotel_stars). A line like "3 gwiazdkowe ..." sets the stars of the links below it.

    Links above any header are dropped. Line order is (file, start of the file block,
    line in the block); a block is also the chunk in which stars are filled.
    """
    lines = (
        spark.read.text(path if isinstance(path, str) else list(path))
        .select(
            F.col("value").alias("line"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
        )
        .where(F.trim("line") != "")
    )
    placed = sections(lines, "line", r"(?i)^(\d)\s+gwiazdkow", ["block"], ["place"], ["file"])
    return placed.where(F.col("section").isNotNull() & F.startswith(F.trim("line"), F.lit("https://"))).select(
        F.trim("line").alias("url"), F.col("section").cast("int").alias("hotel_stars")
    )

"""Plans that must hold at scale: no products, early cuts, salted hot keys, pruned scans."""

import re

import pytest
from pyspark.sql import functions as F

from guestlens import catalog
from guestlens.operators import aspects, clean, dedup, describe, take
from guestlens.plans import ranking, skew
from guestlens.schemas import REVIEW


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def physical(df):
    """The plan as first made, with the subqueries below it."""
    return df._jdf.queryExecution().toString()


# A single aggregated row or the bins of a histogram meet by position, not by key.
@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_products_and_no_python_rows(spark, tiny, name):
    text = physical(catalog.queries()[name](spark, tiny))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "RDDScan" not in text.replace("Scan ExistingRDD", "")


def test_filters_and_columns_reach_the_scan(spark, small):
    orders = spark.read.parquet(f"{small}/lineitem.parquet")
    text = plan(describe.describe_by(orders.where("l_shipdate > timestamp_ntz'1998-01-01 00:00:00'"), "l_quantity", "l_returnflag"))
    scans = [line for line in text.splitlines() if "FileScan parquet" in line]
    assert scans and all("GreaterThan(l_shipdate" in line for line in scans)
    assert all("ReadSchema: struct<l_quantity:double,l_returnflag:string,l_shipdate:timestamp_ntz>" in line for line in scans)


def test_keep_first_cuts_before_its_shuffle(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    text = plan(dedup.keep_first(docs, ["text"], [F.asc("doc_id")]))
    assert text.count("WindowGroupLimit") == 2  # before and after the exchange
    orders = spark.read.parquet(f"{small}/orders.parquet")
    assert plan(take.take_per_group(orders, "o_custkey", [F.asc("o_orderkey")], 150)).count("WindowGroupLimit") == 4  # so for the slices of a key, then for the key


def test_no_window_over_a_whole_group(spark, small):
    """Running counts are windows inside (group, bucket), never inside a group alone."""
    events = spark.read.parquet(f"{small}/events.parquet")
    ranked = ranking.rank_table(ranking.frequency(events, "value", ["event_type"]), ["event_type"])
    lines = [line for line in plan(ranked).splitlines() if " Window [sum(n#" in line]
    assert lines and all("bucket#" in line for line in lines)


def test_buckets_are_even_and_keep_equal_values_together(spark):
    df = spark.range(40000).select(F.exp(F.col("id") / 1000.0).alias("v"))  # very uneven spacing
    freq = ranking.frequency(df, "v")
    sizes = [r["count"] for r in ranking.deal(freq).groupBy("bucket").count().collect()]
    assert len(sizes) >= 16 and max(sizes) < 2 * 40000 / len(sizes)


def test_a_hot_value_is_one_row_before_the_shuffle(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") / 3).alias("v"))
    assert ranking.frequency(df, "v").where("value = 7.0").collect()[0]["n"] == 10000


def test_hot_keys_are_bounded_and_sliced(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    lookup = df.groupBy("k").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("rows"))
    hot = skew.hot_keys(lookup, ["k"], "rows").collect()
    assert [r["k"] for r in hot] == [-1] and hot[0]["__slices"] == 3  # 3000 of 9000 rows over 8 tasks


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_lookup_equals_the_plain_join(spark, how):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 700).alias("k"), "id"
    )
    lookup = df.groupBy("k").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("rows")).where("k IS NULL OR k <> 5")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        salted = skew.lookup_join(df, lookup, ["k"], "rows", how)
        assert "SortMergeJoin" in plan(salted)
        plain = df.join(lookup, "k", how)
        key = ["k", "id", "low", "rows"]
        assert sorted(map(str, salted.select(key).collect())) == sorted(map(str, plain.select(key).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_equal_rows_of_different_tasks_spread_over_slices(spark):
    df = spark.range(800).repartition(16).select(F.lit("same").alias("k"))
    slices = df.select(skew.row_salt(df, F.lit(8)).alias("s")).distinct().count()
    assert slices > 3


def test_salts_do_not_change_between_runs(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 7)
    salts = df.select("id", skew.row_salt(df, F.lit(50)).alias("s"))
    assert sorted(salts.collect()) == sorted(salts.collect())


def test_copies_across_tasks_are_dropped_once(spark):
    base = [("h", "May 2025", 7.0, None, "text")]
    df = spark.createDataFrame(base * 5000, "hotel_name string, stay_date string, rating_score double, pos_text string, neg_text string")
    df = df.repartition(16).withColumn("source_id", F.monotonically_increasing_id().cast("string"))
    df = df.withColumn("traveler_type", F.when(F.col("source_id").endswith("7"), "Business").otherwise("Solo"))
    assert [r["traveler_type"] for r in dedup.dedup_content(df).collect()] == ["Business"]


def test_cleaning_filters_are_narrow(spark):
    text = plan(clean.filter_min_words(clean.filter_period(spark.createDataFrame([], REVIEW))))
    assert "Exchange" not in text and "Python" not in text


def text_exchanges(spark, df, column):
    """Arguments of the exchanges, in the plan as it ran, whose rows hold the column."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    shown = spark.sparkContext._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    final = shown.split("+- == Initial Plan ==")[0]
    listed = final + shown.split("\n\n\n", 1)[-1]
    numbers = {n for n in re.findall(r"Exchange \((\d+)\)", shown.split("== Initial Plan ==")[0]) if f"ReusedExchange ({n})" not in listed}
    blocks = re.findall(r"\((\d+)\) Exchange\nInput \[\d+\]: \[([^\]]*)\]\nArguments: ([^\n]*)", shown)
    return [arguments for n, columns, arguments in blocks if n in numbers and column in columns]


@pytest.fixture
def no_broadcasts(spark):
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(name, "-1")
    yield
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.unset(name)


def test_texts_are_shuffled_once(spark, small, no_broadcasts):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    mentions = docs.select("doc_id", F.lower(F.split("text", " ")[0]).alias("extracted_aspect"), F.lit("C").alias("aspect_category"))
    once = text_exchanges(spark, aspects.aspect_bigrams(mentions, docs, "doc_id", "text"), "text")
    assert len(once) == 1 and once[0].startswith("hashpartitioning(doc_id")
    by_id = [a for a in text_exchanges(spark, aspects.attach_text(mentions, docs, "doc_id", "text"), "text") if "__salt" not in a]
    assert len(by_id) == 1 and by_id[0].startswith("hashpartitioning(doc_id")


def test_text_of_a_hot_id_reaches_all_its_rows(spark, no_broadcasts):
    mentions = spark.range(6000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.col("id").cast("string")).alias("source_id"), "id")
    texts = mentions.select("source_id", F.concat(F.lit("t"), "source_id").alias("neg_text"))
    out = aspects.attach_text(mentions.where("id < 5000"), texts)
    assert out.columns == ["source_id", "id", "neg_text"] and out.count() == 5000
    assert out.where("neg_text IS NULL AND source_id IS NOT NULL OR neg_text <> concat('t', source_id)").count() == 0

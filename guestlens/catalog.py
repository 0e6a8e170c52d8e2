"""The operators applied to the driver's tables, one query per operator.

The tables play the review domain: a price, quantity or event value is the score,
flags, priorities and segments are the groups, documents are the texts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from guestlens.functions import labels, scores, text
from guestlens.functions.display import annotation, half_even, p_text
from guestlens.operators import aspects, clean, dedup, describe, language, market, opinions, report, seen, take
from guestlens.operators import significance as sig
from guestlens.plans import comparison, ranking
from guestlens.session import checkpoint_folder
from guestlens.sources import files, markup

FLAGS = ("A", "N", "R")
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
DIGITS = 6

# Keywords that give the words of part names a category each.
PART_KEYWORDS = {
    "STAFF": ("gear", "gizmo"),
    "CLEANLINESS": ("bolt", "old rod"),
    "COMFORT": ("hot", "cold"),
    "FACILITIES": ("ring", "plate", "new"),
    "VALUE": ("large",),
    "LOCATION": ("red", "small w"),
}

# A lexicon of words that occur in the documents.
TERMS = ("thatin", "thble", "thing", "erble", "ertion", "oning", "onble", "attion", "trash", "ring", "idiot", "ing")
GOOD = ("with", "is", "tion", "this", "eau", "auf")
BAD = ("of", "was", "thtion", "ed", "pas", "dem")
NOT = ("for", "on", "to", "en")
DOCUMENT_KEYWORDS = {
    "STAFF": ("thing", "idiot"),
    "CLEANLINESS": ("trash", "ring"),
    "COMFORT": ("ble",),
    "FACILITIES": ("tion", "thatin"),
    "VALUE": ("on",),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), DIGITS) for c in columns})


# ------------------------------------------------------------------ shared inputs


def order_origin(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the customer's segment and home region against the rest."""
    place = (
        table(spark, folder, "nation")
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_nationkey").alias("c_nationkey"), "r_name")
    )
    customers = (
        table(spark, folder, "customer")
        .join(place, "c_nationkey")
        .select(
            F.col("c_custkey").alias("o_custkey"),
            "c_mktsegment",
            labels.is_home_country(F.col("r_name"), "Europe", "Other").alias("origin"),
        )
    )
    return table(spark, folder, "orders").join(customers, "o_custkey")


def mentions(spark: SparkSession, folder: str) -> DataFrame:
    """Aspect rows: part names as phrases, return flags as sentiment, line numbers as stars."""
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    sentiment = F.when(F.col("l_returnflag") == "R", "Negative").when(F.col("l_returnflag") == "A", "Neutral")
    rows = (
        table(spark, folder, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
        .join(parts, "l_partkey")
        .select(
            F.col("l_orderkey").alias("source_id"),
            F.col("l_linenumber").alias("hotel_stars"),
            F.lower("p_name").alias("extracted_aspect"),
            F.upper(sentiment.otherwise("Positive")).alias("sentiment"),
        )
    )
    return aspects.categorise(rows, keywords=PART_KEYWORDS)


def dated_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with a written month; open orders have no readable month, partial ones no score."""
    month = F.date_format("o_orderdate", "MMMM yyyy")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("sometime")).otherwise(month).alias("stay_date"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("rating_score"),
    )


def document_aspects(spark: SparkSession, folder: str) -> DataFrame:
    """Aspect rows of the documents, found with the lexicon above."""
    found = aspects.extract_aspects(
        table(spark, folder, "documents").select("doc_id", "text"), "text", TERMS, GOOD, BAD, NOT
    )
    return aspects.flatten_aspects(found, ["doc_id"])


def escaped(value: Column) -> Column:
    out = F.replace(value, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def card_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Review pages made of the documents: a card with the whole text in nested elements, one with its source praised, one without a comment."""

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'<div class="x" data-testid="{name}">'), escaped(value), F.lit("</div>"))

    flag = F.concat(F.lit('<img alt="'), F.col("lang"), F.lit('" src="/flags/x.png">'))
    commented = F.concat(
        F.lit('<div data-testid="review-card"><span>'),
        field("review-title", F.col("source")),
        field("review-author-name", F.concat(F.lit("guest & "), F.col("doc_id").cast("string"))),
        field("review-score", F.concat(F.lit("Scored "), F.col("n_chars").cast("string"), F.lit(",5"))),
        field("review-stay-date", F.lit("May 2025")),
        F.when(F.col("lang") == "en", flag).otherwise(F.lit("")),
        F.lit('<div data-testid="review-negative-text"><div class="y"><div>'),
        escaped(F.col("text")),
        F.lit("</div></div></div></span></div><div data-testid=\"review-traveler-type\">outside</div>"),
    )
    praise = F.concat(
        F.lit('<div data-testid="review-card">'),
        field("review-title", F.concat(F.lit("again "), F.col("doc_id").cast("string"))),
        F.lit('<div data-testid="review-positive-text"><p>caf&eacute; &#8217;'),
        escaped(F.col("source")),
        F.lit("&#8217;</p><p>ends</p></div>"),
        field("review-traveler-type", F.lit("Couple")),
        F.lit("</div>"),
    )
    empty = F.concat(
        F.lit('<div data-testid="review-card">'), field("review-title", F.col("source")), F.lit("</div>")
    )
    return table(spark, folder, "documents").select(
        F.concat(F.lit("Hotel "), F.col("lang")).alias("hotel_name"),
        F.concat(F.lit("<html><body>"), commented, praise, empty, F.lit("</body></html>")).alias("html"),
    )


def menu_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages with filter menus made of the line items of each supplier."""
    counted = (
        table(spark, folder, "lineitem")
        .groupBy("l_suppkey")
        .agg(
            F.count(F.lit(1)).alias("all"),
            *(F.count_if(F.col("l_returnflag") == f).alias(f) for f in FLAGS),
            F.count_if(F.col("l_linestatus") == "F").alias("F"),
            F.count_if(F.col("l_linestatus") == "O").alias("O"),
        )
    )

    def menu(name: str, *options: tuple[str, str]) -> Column:
        parts = [F.lit(f'<select data-testid="{name}">')]
        for value, column in options:
            parts += [F.lit(f'<option value="{value}">{value.lower()} ('), F.col(column).cast("string"), F.lit(")</option>")]
        return F.concat(*parts, F.lit("<option value=\"NONE\">no number</option></select>"))

    html = F.concat(
        menu(
            "scoreRange",
            ("ALL", "all"),
            ("REVIEW_ADJ_SUPERB", "A"),
            ("REVIEW_ADJ_AVERAGE_PASSABLE", "N"),
            ("REVIEW_ADJ_POOR", "R"),
        ),
        menu("customerType", ("ALL", "all"), ("FAMILIES", "F"), ("COUPLES", "O")),
        menu("languages", ("0", "all"), ("en", "A"), ("pl", "N")),
    )
    return counted.select("l_suppkey", html.alias("html"))


# ------------------------------------------------------------------ cleaning


def q_union_passes(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderpriority").alias("traveler_type"), "o_totalprice", "o_orderstatus")
    general = orders.where("o_orderstatus = 'F'")
    negative = orders.where("o_orderstatus = 'O'").drop("o_totalprice")
    business = orders.where("o_orderstatus = 'P'").select("traveler_type", "o_orderstatus", "o_orderkey")
    return clean.union_passes(general, negative, business)


def q_month_parse_filter(spark: SparkSession, folder: str) -> DataFrame:
    kept = clean.filter_period(dated_orders(spark, folder), first="1994-01-01", last="1997-05-31")
    return kept.select("o_orderkey", "stay_date", scores.stay_month(F.col("stay_date")).cast("string").alias("month"))


def q_text_min_words(spark: SparkSession, folder: str) -> DataFrame:
    kept = clean.filter_min_words(table(spark, folder, "documents").select("doc_id", "text"), "text")
    return kept.select("doc_id", text.word_count(F.col("text")).alias("words"), F.md5("text").alias("text_md5"))


def q_nonempty_comment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id",
        F.when(F.col("lang") == "en", F.col("text")).when(F.col("lang") == "fr", F.lit(" \t ")).alias("pos_text"),
        F.when(F.col("lang") == "de", F.col("text")).otherwise(F.lit("")).alias("neg_text"),
    )
    return clean.drop_commentless(docs).select("doc_id")


def q_stage_counts(spark: SparkSession, folder: str) -> DataFrame:
    keys = ("o_custkey", "stay_date", "o_orderstatus")
    return clean.stage_counts(dated_orders(spark, folder), keys=keys, first="1994-01-01", last="1997-05-31")


def q_text_stage_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("text")
    return clean.text_stage_counts(docs, "text", language.language_of(F.col("text")))


def q_business_only(spark: SparkSession, folder: str) -> DataFrame:
    types = F.when(F.col("o_orderstatus") == "F", F.lit(" Business\t")).when(F.col("o_orderstatus") == "O", F.lit("BUSINESSES")).otherwise("business")
    kept = clean.business_only(table(spark, folder, "orders").withColumn("traveler_type", types))
    return kept.select("o_orderkey", "traveler_type")


def q_canonical_category(spark: SparkSession, folder: str) -> DataFrame:
    spelled = labels.lookup(
        F.col("c_mktsegment"),
        {"AUTOMOBILE": " Solo Traveller ", "BUILDING": "BUSINESS", "FURNITURE": "family\t", "HOUSEHOLD": "pet owner"},
    )
    return table(spark, folder, "customer").select("c_custkey", labels.traveler_label(spelled).alias("traveler_type"))


def q_origin_binary(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    country = F.when(F.col("n_name").isNotNull(), F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")))
    return (
        table(spark, folder, "customer")
        .join(nations, "c_nationkey", "left")
        .select(
            "c_custkey",
            scores.country_or_unknown(country).alias("country"),
            labels.is_home_country(country, "Nation_7", "Other").alias("origin"),
        )
    )


def q_parse_score(spark: SparkSession, folder: str) -> DataFrame:
    number = F.concat(F.lit("Scored "), F.col("l_quantity").cast("int").cast("string"), F.lit(","), F.col("l_linenumber").cast("string"))
    label = F.when(F.col("l_returnflag") == "N", F.lit("no score")).when(F.col("l_returnflag") == "R", number)
    label = F.when(F.col("l_returnflag") == "A", F.concat(number, F.lit(" of 60"))).otherwise(label)
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", scores.parse_score(label).alias("score"))


def q_review_key(spark: SparkSession, folder: str) -> DataFrame:
    title = F.nullif(F.col("p_type"), F.lit("SMALL"))
    return table(spark, folder, "part").select(
        "p_partkey", scores.review_key(F.col("p_brand"), F.col("p_name"), title).alias("source_id")
    )


def q_score_band_filter(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") / 5).alias("score"))
    return market.filter_bands(lines, "score")


def q_label_translate(spark: SparkSession, folder: str) -> DataFrame:
    names = {"BUILDING": "Budowa", "MACHINERY": "Maszyny"}
    return table(spark, folder, "customer").select(
        "c_custkey",
        labels.translate(F.col("c_mktsegment"), names).alias("kept"),
        labels.lookup(F.col("c_mktsegment"), names).alias("mapped"),
    )


# ------------------------------------------------------------------ keep-first and takes


def q_dedup_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    reviews = table(spark, folder, "documents").select(
        F.col("doc_id").alias("source_id"),
        F.col("lang").alias("hotel_name"),
        F.nullif(F.col("source"), F.lit("src1")).alias("traveler_type"),
        F.col("text").alias("neg_text"),
    )
    kept = dedup.dedup_content(reviews, ("hotel_name", "neg_text"))
    return kept.select("source_id", "hotel_name", "traveler_type")


def q_dedup_by_key(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", "n_chars")
    return dedup.dedup_by_key(docs, "source", [F.desc("n_chars"), F.asc("doc_id")])


def q_dedup_across_batches(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id", F.md5("text").alias("source_id"), F.length("source").alias("band")
    )
    return dedup.dedup_across_batches(docs, "source_id", "band").select("doc_id", "band")


def q_dedup_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The same rule, each batch against the stored ids of those before it."""
    docs = table(spark, folder, "documents").select("doc_id", F.md5("text").alias("source_id"), F.length("source").alias("band"))
    place = f"{checkpoint_folder(spark).rstrip('/')}/seen-{uuid.uuid4().hex}"
    store = seen.SeenIds(spark, f"{place}/store")
    bands = [row["band"] for row in docs.select("band").distinct().orderBy("band").collect()]  # one per batch
    kept = [store.take(docs.where(F.col("band") == band), "source_id", band, f"{place}/kept/{band}") for band in bands]
    return reduce(DataFrame.unionByName, kept).select("doc_id", "band")


def q_take_per_group(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    taken = take.take_per_group(orders, "o_custkey", [F.desc("o_orderdate"), F.asc("o_orderkey")], 5)
    return taken.select("o_custkey", "o_orderkey")


def q_take_whole_pages(spark: SparkSession, folder: str) -> DataFrame:
    page = (9999 - F.year("o_orderdate")) * 4 - F.quarter("o_orderdate")  # newest quarter first
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", page.alias("page"))
    return take.take_whole_pages(orders, "o_custkey", "page", 4)


def q_min_group_size(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey")
    return take.min_group_size(orders, "o_custkey", 12)


# ------------------------------------------------------------------ descriptives


def q_describe_overall(spark: SparkSession, folder: str) -> DataFrame:
    return describe.describe_overall(table(spark, folder, "lineitem"), "l_quantity", DIGITS)


def q_describe_overall_wide(spark: SparkSession, folder: str) -> DataFrame:
    return describe.transpose_overall(describe.describe_overall(table(spark, folder, "events"), "value", DIGITS))


def q_describe_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return describe.describe_by(table(spark, folder, "lineitem"), "l_quantity", "l_returnflag", DIGITS)


def q_describe_by_group5(spark: SparkSession, folder: str) -> DataFrame:
    return describe.describe_by(table(spark, folder, "events"), "value", "event_type", DIGITS)


def q_describe_by_origin(spark: SparkSession, folder: str) -> DataFrame:
    return describe.describe_by(order_origin(spark, folder), "o_totalprice", "origin", DIGITS)


def q_descriptive_report(spark: SparkSession, folder: str) -> DataFrame:
    segments = {"Standard Hotelu": "o_orderstatus", "Profil Podróżnego": "o_orderpriority", "Pochodzenie": "origin"}
    return describe.descriptive_report(
        order_origin(spark, folder), "o_totalprice", segments, digits=DIGITS, source_digits=None
    )


def q_report_rounding(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("l_quantity") + F.col("l_linenumber") * 0.005
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", half_even(value, 2).alias("shown"))


def q_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(describe.histogram(table(spark, folder, "events"), "value"), "lower", "upper", "mean")


def q_boxplot_stats(spark: SparkSession, folder: str) -> DataFrame:
    box = describe.boxplot(table(spark, folder, "events"), "value", "event_type")
    return rounded(box, "q1", "median", "q3", "whisker_low", "whisker_high")


def supplier_rates(spark: SparkSession, folder: str) -> DataFrame:
    counted = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_suppkey").alias("s_suppkey"))
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("l_returnflag") == "R").alias("negative_total"))
    )
    return counted.join(table(spark, folder, "supplier"), "s_suppkey")


def q_negative_rate(spark: SparkSession, folder: str) -> DataFrame:
    return market.negative_rate_by(supplier_rates(spark, folder), "s_nationkey", digits=DIGITS)


def q_negative_rate_pooled(spark: SparkSession, folder: str) -> DataFrame:
    return market.negative_rate_by(supplier_rates(spark, folder), "s_nationkey", pooled=True, digits=DIGITS)


def q_language_structure(spark: SparkSession, folder: str) -> DataFrame:
    per_source = (
        table(spark, folder, "documents")
        .groupBy("source", "lang")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("source")
        .agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("lang", "n")))).alias("languages_json"))
    )
    return market.language_structure(per_source, digits=4)


def q_score_distribution(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        "l_suppkey", (F.col("l_quantity") / 5).alias("score"), "l_returnflag", "l_linestatus"
    )
    return market.score_distribution(
        lines, "l_suppkey", "score", "l_returnflag", {"type_families": "A", "type_couples": "N"}, "l_linestatus"
    )


def q_distribution_rows(spark: SparkSession, folder: str) -> DataFrame:
    counted = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.nullif(F.count_if(F.col("o_orderstatus") == "F"), F.lit(0)).alias("fair_5to7"),
            F.nullif(F.count_if(F.col("o_orderstatus") == "P"), F.lit(0)).alias("very_poor_1to3"),
            F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("type_families"),
        )
        .withColumn("languages", F.when(F.col("very_poor_1to3").isNotNull(), F.create_map(F.lit("pl"), F.col("very_poor_1to3"))))
    )
    return market.distribution_rows(counted, "o_custkey")


# ------------------------------------------------------------------ hypothesis tests


def q_mid_ranks(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.mid_ranks(table(spark, folder, "events"), "value")


def q_shapiro_wilk(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(sig.shapiro_wilk(table(spark, folder, "events"), "value", "event_type", EVENT_TYPES), "w", "p_value")


def q_levene(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(sig.levene(table(spark, folder, "orders"), "o_totalprice", "o_orderpriority", PRIORITIES), "statistic", "p_value")


def q_anova_oneway(spark: SparkSession, folder: str) -> DataFrame:
    test = sig.anova_oneway(table(spark, folder, "orders"), "o_totalprice", "o_orderpriority", PRIORITIES)
    return rounded(test, "statistic", "p_value")


def q_kruskal_wallis(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(sig.kruskal_wallis(table(spark, folder, "lineitem"), "l_quantity", "l_returnflag", FLAGS), "statistic", "p_value")


def q_kruskal_wallis_events(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(sig.kruskal_wallis(table(spark, folder, "events"), "value", "event_type", EVENT_TYPES), "statistic", "p_value")


def q_mann_whitney_u(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(sig.mann_whitney_u(table(spark, folder, "lineitem"), "l_quantity", "l_linestatus", "F", "O"), "z", "p_value")


def q_ttest_ind(spark: SparkSession, folder: str) -> DataFrame:
    test = sig.ttest_ind(table(spark, folder, "orders"), "o_totalprice", "o_orderstatus", "F", "O")
    return rounded(test, "statistic", "df", "p_value")


def q_ttest_student(spark: SparkSession, folder: str) -> DataFrame:
    test = sig.ttest_ind(table(spark, folder, "orders"), "o_totalprice", "o_orderstatus", "F", "O", equal_variance=True)
    return rounded(test, "statistic", "df", "p_value")


def q_dunn_posthoc(spark: SparkSession, folder: str) -> DataFrame:
    pairs = sig.dunn_posthoc(table(spark, folder, "events"), "value", "event_type", EVENT_TYPES)
    return rounded(pairs, "mean_rank1", "mean_rank2", "z", "p_adjusted")


def q_dunn_matrix(spark: SparkSession, folder: str) -> DataFrame:
    pairs = sig.dunn_posthoc(table(spark, folder, "lineitem"), "l_quantity", "l_returnflag", FLAGS)
    return sig.symmetric_matrix(pairs, FLAGS, digits=DIGITS)


def q_dunn_report(spark: SparkSession, folder: str) -> DataFrame:
    pairs = sig.dunn_posthoc(table(spark, folder, "lineitem"), "l_quantity", "l_returnflag", FLAGS)
    names = {"A": "Polska", "R": "Reszta Świata"}
    return report.matrix_report(sig.symmetric_matrix(pairs, FLAGS), FLAGS, names)


def q_tukey_hsd(spark: SparkSession, folder: str) -> DataFrame:
    pairs = sig.tukey_statistics(table(spark, folder, "orders"), "o_totalprice", "o_orderpriority", PRIORITIES)
    return rounded(pairs, "meandiff", "se", "q")


def q_tukey_pvalues(spark: SparkSession, folder: str) -> DataFrame:
    pairs = sig.tukey_hsd(table(spark, folder, "orders"), "o_totalprice", "o_orderpriority", PRIORITIES)
    return rounded(pairs.select("group1", "group2", "p_adj", "reject"), "p_adj")


def q_tukey_limits(spark: SparkSession, folder: str) -> DataFrame:
    pairs = sig.tukey_hsd(table(spark, folder, "orders"), "o_totalprice", "o_orderpriority", PRIORITIES)
    return rounded(pairs, "meandiff", "p_adj", "lower", "upper")


def q_group_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return comparison.compare_groups(
        table(spark, folder, "events"), "value", "event_type", EVENT_TYPES, "events", digits=DIGITS
    ).main


def q_pb1(spark: SparkSession, folder: str) -> DataFrame:
    return comparison.problem_stars(table(spark, folder, "lineitem"), "l_quantity", "l_linenumber", digits=DIGITS).main


def q_pb2(spark: SparkSession, folder: str) -> DataFrame:
    return comparison.problem_travelers(order_origin(spark, folder), "o_totalprice", "c_mktsegment", SEGMENTS, digits=DIGITS).main


def q_pb3(spark: SparkSession, folder: str) -> DataFrame:
    return comparison.problem_origin(order_origin(spark, folder), "o_totalprice", "origin", ("Europe", "Other"), digits=DIGITS).main


def q_pvalue_format(spark: SparkSession, folder: str) -> DataFrame:
    p = F.when(F.col("l_linenumber") == 1, F.col("l_quantity") / 50).otherwise(F.col("l_discount") / 7 + F.col("l_tax") / 3)
    shown = F.when(F.col("l_returnflag") == "N", F.concat(F.lit("p="), F.col("l_linestatus"))).otherwise(p.cast("string"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        p_text(shown).alias("shown"),
        annotation(F.lit("Test"), F.col("l_linestatus"), F.col("l_quantity"), p).alias("note"),
    )


# ------------------------------------------------------------------ text


def q_language_id(spark: SparkSession, folder: str) -> DataFrame:
    found = language.detect_language(table(spark, folder, "documents").select("doc_id", "lang", "text"), "text")
    return found.select("doc_id", "lang", "language")


def q_language_filter(spark: SparkSession, folder: str) -> DataFrame:
    return language.filter_language(table(spark, folder, "documents").select("doc_id", "text"), "text").select("doc_id")


def q_language_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return language.train_profile(table(spark, folder, "documents"), "text", "lang", 2_000)


def q_language_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    profile = language.collect_profile(language.train_profile(docs, "text", "lang", 2_000))
    return rounded(language.accuracy(language.detect_language(docs, "text", profile), "lang"), "share")


def q_language_accuracy_built_in(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    return rounded(language.accuracy(language.detect_language(docs, "text"), "lang"), "share")


def q_aspect_extract(spark: SparkSession, folder: str) -> DataFrame:
    return document_aspects(spark, folder)


def q_aspect_phrases(spark: SparkSession, folder: str) -> DataFrame:
    found = aspects.extract_phrases(table(spark, folder, "documents").select("doc_id", "text"), "text")
    return aspects.flatten_aspects(found, ["doc_id"])


def q_flatten_aspects(spark: SparkSession, folder: str) -> DataFrame:
    tokens = text.words(F.col("text"))
    polarity = F.transform(
        F.filter(tokens, lambda w: F.length(w) == 8),
        lambda w: F.when(w < "m", F.lit("Negative")).otherwise(F.lit("Positive")),
    )
    lists = table(spark, folder, "documents").select(
        "doc_id", F.filter(tokens, lambda w: F.length(w) == 9).alias("aspect"), polarity.alias("sentiment")
    )
    return aspects.flatten_aspects(lists, ["doc_id"])


def q_opinion_weights(spark: SparkSession, folder: str) -> DataFrame:
    """Texts of good documents are the positive side, those of bad ones the negative."""
    quality = table(spark, folder, "labels").select("doc_id", "quality")
    docs = table(spark, folder, "documents").select("doc_id", "text").join(quality, "doc_id")
    sides = docs.select(F.when(F.col("quality") == 1, F.col("text")).alias("pos_text"), F.when(F.col("quality") == 0, F.col("text")).alias("neg_text"))
    return rounded(opinions.opinion_weights(sides), "weight")


def q_aspect_category(spark: SparkSession, folder: str) -> DataFrame:
    words = (
        table(spark, folder, "documents")
        .select(F.explode(text.words(F.col("text"))).alias("extracted_aspect"))
        .groupBy("extracted_aspect")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return aspects.categorise(words)


def q_aspect_category_join(spark: SparkSession, folder: str) -> DataFrame:
    rows = [(i, c, k) for i, (c, ks) in enumerate(PART_KEYWORDS.items()) for k in ks]
    dictionary = spark.createDataFrame(rows, "priority int, category string, keyword string")
    parts = table(spark, folder, "part").select("p_partkey", F.col("p_name").alias("extracted_aspect"))
    return aspects.categorise_by_table(parts, dictionary)


def q_negative_aspects(spark: SparkSession, folder: str) -> DataFrame:
    return aspects.negative_aspects(mentions(spark, folder)).drop("category_name")


def q_aspect_sentiment_crosstab(spark: SparkSession, folder: str) -> DataFrame:
    return report.aspect_counts(mentions(spark, folder))


def q_crosstab_share(spark: SparkSession, folder: str) -> DataFrame:
    negative = aspects.negative_aspects(mentions(spark, folder))
    return aspects.crosstab_share(negative, "hotel_stars", "aspect_category", list(PART_KEYWORDS), DIGITS)


def q_category_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return aspects.ranking(aspects.negative_aspects(mentions(spark, folder)), "category_name")


def q_absa_report(spark: SparkSession, folder: str) -> DataFrame:
    return report.aspect_report(report.aspect_counts(mentions(spark, folder)))


def q_aspect_text_join(spark: SparkSession, folder: str) -> DataFrame:
    texts = table(spark, folder, "documents").select("doc_id", F.col("text").alias("neg_text"))
    joined = aspects.attach_text(document_aspects(spark, folder), texts, "doc_id")
    return joined.select("doc_id", "extracted_aspect", "sentiment", F.md5("neg_text").alias("text_md5"))


def document_bigrams(spark: SparkSession, folder: str) -> DataFrame:
    found = aspects.categorise(document_aspects(spark, folder), keywords=DOCUMENT_KEYWORDS)
    return aspects.aspect_bigrams(found, table(spark, folder, "documents"), "doc_id", "text")


def q_aspect_bigrams(spark: SparkSession, folder: str) -> DataFrame:
    return document_bigrams(spark, folder).select("doc_id", "extracted_aspect", "bigram", F.col("mentions").alias("n"))


def q_top_bigrams(spark: SparkSession, folder: str) -> DataFrame:
    return aspects.top_bigrams(document_bigrams(spark, folder))


# ------------------------------------------------------------------ markup and files


def q_page_card_extract(spark: SparkSession, folder: str) -> DataFrame:
    blocks = markup.split_blocks(table(spark, folder, "pages"), "html", "<li>", ["page_id"])
    fields = {"link": r'<a href="([^"]*)">', "label": r"(?s)<a [^>]*>(.*?)</a>"}
    return markup.extract_fields(blocks, fields, ["page_id", "place"])


def q_review_card_extract(spark: SparkSession, folder: str) -> DataFrame:
    cards = markup.extract_cards(card_pages(spark, folder))
    return cards.withColumn("neg_text", F.when(F.col("neg_text") == "", "").otherwise(F.md5("neg_text")))


def q_option_counts(spark: SparkSession, folder: str) -> DataFrame:
    return markup.menu_options(menu_pages(spark, folder), "customerType", carry=["l_suppkey"])


def q_menu_distribution(spark: SparkSession, folder: str) -> DataFrame:
    counts = markup.extract_counts(menu_pages(spark, folder), carry=["l_suppkey"])
    return market.distribution_rows(counts, "l_suppkey")


def q_page_title_name(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", markup.hotel_name(F.col("html")).alias("hotel_name"))


def q_section_fill_forward(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    lines = lines.withColumn("chunk", F.floor(F.col("place") / 20))
    placed = files.sections(lines, "line", r"^([^.]+)[.]$", ["chunk"], ["place"], ["doc_id"])
    return placed.select("doc_id", "place", "section")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query of this module, by name."""
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_")}


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Kruskal-Wallis over the groups of a score."""
    return q_kruskal_wallis(spark, folder)

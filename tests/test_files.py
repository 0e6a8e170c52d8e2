import uuid

import pytest
from pyspark.sql import functions as F

from guestlens.operators import clean, language
from guestlens.plans import reviews
from guestlens.schemas import REVIEW
from guestlens.session import checkpoint_folder
from guestlens.sources import files

ROWS = [
    ("1", "Hotel \"A\", Town", "May 2025", 3, "Couple", "Poland", 8.0, "t", "line one\nline two, \"quoted\"", None),
    ("2", "Hotel B", "May 2025", 5, None, "Unknown", None, "", None, "NA"),
]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, REVIEW)


def test_csv_round_trip_with_multi_line_quotes(spark, rows, tmp_path):
    files.write_result(rows, str(tmp_path / "out"))
    back = {r["source_id"]: r for r in files.read_reviews(spark, str(tmp_path / "out")).collect()}
    assert tuple(back["1"]) == ROWS[0]
    assert back["2"]["rating_score"] is None and back["2"]["neg_text"] is None  # a spelling of "missing"


def test_csv_written_elsewhere(spark, tmp_path):
    header = ",".join(REVIEW.names)
    body = '7,H,May 2025,4.0,Family,Poland,"bad",T,"a ""b""\nc",None\n'
    (tmp_path / "r.csv").write_text(f"{header}\n{body}", encoding="utf-8")
    row = files.read_reviews(spark, str(tmp_path / "r.csv")).collect()[0]
    assert (row["hotel_stars"], row["rating_score"], row["pos_text"], row["neg_text"]) == (4, None, 'a "b"\nc', None)


def test_append_and_start_afresh(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    files.append_rows(rows, path)
    files.append_rows(rows.where("source_id = '1'"), path)
    assert spark.read.parquet(path).count() == 3
    files.start_afresh(rows, path)
    assert spark.read.parquet(path).count() == 2


def test_sectioned_list(spark, tmp_path):
    (tmp_path / "targets.txt").write_text(
        "https://early\n\n3 gwiazdkowe 2 hoteli:\n https://a \nnote\nhttps://b\n\n5 GWIAZDKOWE:\nhttps://c\nhttp://d\n", encoding="utf-8"
    )
    got = files.read_sectioned(spark, str(tmp_path / "targets.txt")).collect()
    assert sorted((r["url"], r["hotel_stars"]) for r in got) == [("https://a", 3), ("https://b", 3), ("https://c", 5)]


def test_sectioned_list_over_several_blocks(spark, tmp_path):
    lines = []
    expected = []
    for i in range(4000):
        if i % 700 == 5:
            lines.append(f"{i // 700 % 9 + 1} gwiazdkowe")
            stars = i // 700 % 9 + 1
        lines.append(f"https://hotel/{i}")
        if i >= 5:
            expected.append((f"https://hotel/{i}", stars))
    (tmp_path / "long.txt").write_text("\n".join(lines), encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    try:
        got = files.read_sectioned(spark, str(tmp_path / "long.txt"))
        assert sorted((r["url"], r["hotel_stars"]) for r in got.collect()) == sorted(expected)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_fill_forward_over_chunks(spark):
    df = spark.createDataFrame([(i, i // 3, "x" if i == 1 else "y" if i == 10 else None) for i in range(20)], "i int, c int, v string")
    out = files.fill_forward(df, "v", ["c"], ["i"]).orderBy("i").collect()
    assert [r["filled"] for r in out] == [None] + ["x"] * 9 + ["y"] * 10


def test_checkpoint_folder_is_stable_within_a_session(spark):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        assert checkpoint_folder(spark) == checkpoint_folder(spark)
    else:
        assert checkpoint_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_both_analysis_tables(spark, tmp_path):
    base = ("H", "May 2025", 3)

    def row(i, kind, score, neg, date="May 2025"):
        return (str(i), "H", date, 3, kind, "Poland", score, "t", None, neg)

    general = spark.createDataFrame(
        [
            row(1, "Solo traveller", 7.0, "The shower was dirty and the bed was hard"),
            row(2, "Couple", 5.0, "Das Bett war sehr hart und nicht sauber"),
            row(3, "Family", 6.0, "too hot"),
            row(4, "Family", None, "The bed was hard"),
            row(5, "Family", 6.0, "The bed was hard", "May 2020"),
        ],
        REVIEW,
    )
    business = spark.createDataFrame([row(1, "Solo traveller", 7.0, "The shower was dirty and the bed was hard")], REVIEW)
    statistics, texts, counts = reviews.write_tables(spark, str(tmp_path), general, general.limit(0), business)
    assert sorted((r["source_id"], r["traveler_type"]) for r in statistics.collect()) == [("1", "Business"), ("2", "Couple"), ("3", "Family")]
    assert [r["source_id"] for r in texts.collect()] == ["1"]
    found = reviews.aspect_results(texts).select("extracted_aspect", "sentiment", "aspect_category").collect()
    assert sorted(map(tuple, found)) == [("bed", "NEGATIVE", "COMFORT"), ("shower", "NEGATIVE", "FACILITIES")]
    labelled = clean.normalise_labels(statistics).where(F.col("source_id") == "1").collect()[0]
    assert (labelled["traveler_type"], labelled["origin"], labelled["hotel_stars"]) == ("Business", "Poland", base[2])


def stage_rows(counts):
    out = {}
    for r in counts.orderBy("pass", "position").collect():
        out.setdefault(r["pass"], []).append((r["stage"], r["rows"]))
    return out


def test_counts_of_a_run_equal_those_of_its_tables(spark, tmp_path):
    def rows(start, n, **fixed):
        base = dict.fromkeys(f.name for f in REVIEW.fields)
        some = [
            {**base, "source_id": f"{start + i}", "hotel_name": f"H{i % 3}", "stay_date": "May 2025" if i % 6 else "May 2019", "rating_score": 7.0 if i % 5 else None,
             "neg_text": ["The bed was very hard", "Das Bett war sehr hart und kalt", "bad", None][i % 4] if i % 7 else " ", **fixed}
            for i in range(n)
        ]
        return spark.createDataFrame([tuple(r[f.name] for f in REVIEW.fields) for r in some], REVIEW)

    general, negative, business = rows(0, 60), rows(0, 40), rows(500, 30, hotel_name="B")
    written = reviews.write_tables(spark, str(tmp_path), general, negative, business)
    found = stage_rows(written.counts)
    assert list(found) == ["business", "general", "negative"] and all([s for s, _ in x] == [s for s, _ in found["general"]] for x in found.values())
    for name, part in (("general", general), ("negative", negative), ("business", business)):
        alone = {r["stage"]: r["rows"] for r in clean.stage_counts(part).collect()}
        assert [n for _, n in found[name][:3]] == [alone[s] for s in ("loaded", "in_period", "with_score")]
    whole = {r["stage"]: r["rows"] for r in clean.stage_counts(reviews.union_passes(general, negative, business)).collect()}
    total = {stage: sum(dict(x)[stage] for x in found.values()) for stage, _ in found["general"]}
    assert {s: total[s] for s in whole} == whole and total["distinct_content"] == written.statistics.count()
    text = {r["stage"]: r["rows"] for r in clean.text_stage_counts(written.statistics, "neg_text", reviews_language()).collect()}
    assert {s: total[s] for s in ("with_text", "enough_words", "in_language")} == {s: text[s] for s in ("with_text", "enough_words", "in_language")}
    assert total["in_language"] == written.texts.count() > 0 and "__pass" not in written.texts.columns + written.statistics.columns


def reviews_language():
    return language.language_of(F.col("neg_text"))


def test_two_passes_alone_and_empty_ones(spark, tmp_path):
    none = spark.createDataFrame([], REVIEW)
    found = stage_rows(reviews.write_tables(spark, str(tmp_path), none, none).counts)
    assert set(found) == {"general", "negative"} and all(n == 0 for x in found.values() for _, n in x)


def test_a_pass_put_twice_or_broken_is_the_same_table(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = spark.createDataFrame([(f"H{i % 3}", i, f"t{i}") for i in range(30)], "hotel_name string, i int, text string")

    def table():
        return sorted((r["pass"], r["hotel_name"], r["i"], r["text"]) for r in spark.read.parquet(path).collect())

    files.put_pass(df, path, "general")
    files.put_pass(df.limit(4), path, "negative")
    expected = table()
    files.put_pass(df, path, "general")
    assert table() == expected
    files.put_pass(df.where("hotel_name <> 'H2' AND i < 7"), path, "general")  # broken half-way
    assert table() != expected
    files.put_pass(df, path, "general")
    assert table() == expected and len(expected) == 34


def test_phrases_reach_the_results(spark):
    said = "The rooms were dirty, the beds hard, towels stained, prices expensive, amenities missing, air conditioning broken"
    base = dict.fromkeys(f.name for f in REVIEW.fields)
    texts = spark.createDataFrame([tuple({**base, "source_id": "1", "neg_text": said}[f.name] for f in REVIEW.fields)], REVIEW)
    found = [r["extracted_aspect"] for r in reviews.aspect_results(texts).collect()]
    assert found == ["rooms", "beds", "towels", "prices", "amenities", "air conditioning"]

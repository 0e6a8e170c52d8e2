import pytest
from pyspark.sql import functions as F

from guestlens.functions import labels
from guestlens.operators import aspects, language


def texts(spark, rows):
    return spark.createDataFrame(rows, "source_id string, neg_text string")


def test_category_precedence_and_substrings(spark):
    expected = {
        "hotel": "COMFORT", "business": "LOCATION", "steak": "FACILITIES", "chair": "CLEANLINESS", "space": "FACILITIES",
        "cleaning lady": "STAFF", "Room Service": "STAFF", "bathroom": "CLEANLINESS", "ac": "OTHER", "ac unit": "COMFORT",
        "xyz": "OTHER",
    }
    rows = [(k,) for k in expected] + [(None,)]
    df = aspects.categorise(spark.createDataFrame(rows, "extracted_aspect string"))
    got = {r["extracted_aspect"]: r["aspect_category"] for r in df.collect()}
    assert got.pop(None) == "OTHER" and got == expected
    assert df.where("extracted_aspect = 'xyz'").collect()[0]["category_name"] == "Inne (pominięte)"


def test_dictionary_table_agrees_with_the_fixed_dictionary(spark):
    phrases = ["hotel", "business", "cleaning lady", "ac unit", "ac", "room service", "air", "a", "", None, "front desk staff"]
    df = spark.createDataFrame([(p,) for p in phrases * 3], "extracted_aspect string")
    rows = [(i, c, k) for i, (c, ks) in enumerate(labels.ASPECT_KEYWORDS.items()) for k in ks]
    table = spark.createDataFrame(rows, "priority int, category string, keyword string")
    joined = aspects.categorise_by_table(df, table)
    fixed = aspects.categorise(df).select("extracted_aspect", "aspect_category")
    assert sorted(map(str, joined.select("extracted_aspect", "aspect_category").collect())) == sorted(map(str, fixed.collect()))


def test_flatten_stops_at_the_shorter_list(spark):
    df = spark.createDataFrame(
        [("1", ["A", "b", "c"], ["Positive", "negative"]), ("2", [], []), ("3", None, None), ("4", ["x"], [])],
        "source_id string, aspect array<string>, sentiment array<string>",
    )
    out = aspects.flatten_aspects(df, ["source_id"]).collect()
    assert [tuple(r) for r in out] == [("1", "a", "POSITIVE"), ("1", "b", "NEGATIVE")]


def test_extraction_polarity_negation_and_reach(spark):
    df = texts(
        spark,
        [
            ("1", "The shower was dirty, the breakfast was not good"),
            ("2", "Staff great!"),
            ("3", "the window one two three four broken"),
            ("4", ""),
            ("5", None),
            ("6", "not dirty bathroom"),
        ],
    )
    out = aspects.flatten_aspects(aspects.extract_aspects(df), ["source_id"])
    assert sorted(tuple(r) for r in out.collect()) == [
        ("1", "breakfast", "NEGATIVE"), ("1", "shower", "NEGATIVE"), ("2", "staff", "POSITIVE"),
        ("3", "window", "NEUTRAL"), ("6", "bathroom", "POSITIVE"),
    ]


def test_model_hook_keeps_rows_and_results_together(spark):
    def model():
        def predict(batch):
            return [(t.upper().split(), ["Negative"] * len(t.split())) for t in batch]

        return predict

    df = texts(spark, [("1", "a b"), ("2", None), ("3", ""), ("4", "c")])
    out = aspects.flatten_aspects(aspects.extract_aspects_with(df, model), ["source_id"])
    assert sorted(tuple(r)[:2] for r in out.collect()) == [("1", "a"), ("1", "b"), ("4", "c")]


def brute_bigrams(aspect_rows, text_by_id):
    import re
    from collections import Counter

    out = Counter()
    for key, category, aspect in aspect_rows:
        ws = re.findall(r"\w+", text_by_id.get(key, "").lower())
        for a, b in zip(ws, ws[1:]):
            if aspect in (a, b) and a not in labels.BIGRAM_STOP_WORDS and b not in labels.BIGRAM_STOP_WORDS:
                pair = "-".join(labels.WORD_TRANSLATIONS.get(w, w) for w in (a, b))
                out[key, category, aspect, pair] += 1
    return dict(out)


def test_bigrams_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(aspects, "LIST_SIZE", 2)  # several lists per review
    text_by_id = {
        "1": "The dirty shower leaked. Dirty shower, shower shower; łóżko twarde łóżko",
        "2": "one",
        "3": "front desk rude",
        "hot": "bed bed hard bed soft",
    }
    rows = [("1", "F", "shower"), ("1", "F", "shower"), ("1", "C", "dirty"), ("1", "C", "łóżko"), ("1", "X", "leaked")]
    rows += [("2", "F", "one"), ("3", "S", "front desk"), ("3", "S", "desk"), ("missing", "F", "bed")] + [("hot", "C", "bed")] * 50
    found = aspects.aspect_bigrams(
        spark.createDataFrame(rows, "source_id string, aspect_category string, extracted_aspect string"),
        texts(spark, list(text_by_id.items())),
    )
    got = {(r["source_id"], r["aspect_category"], r["extracted_aspect"], r["bigram"]): r["mentions"] for r in found.collect()}
    assert got == brute_bigrams(rows, text_by_id)
    assert got["1", "F", "shower", "brudny-prysznic"] == 4
    top = aspects.top_bigrams(found, limit=1).collect()
    assert {r["aspect_category"]: r["bigram"] for r in top}["C"] == "twardy-łóżko"


def test_first_text_of_a_shared_id(spark):
    mentions = spark.createDataFrame([("1", "bed"), ("1", "tea"), ("2", "bar")], "source_id string, extracted_aspect string")
    reviews = spark.createDataFrame([("1", 2, "late"), ("1", 1, "early")], "source_id string, place int, neg_text string")
    out = aspects.attach_text(mentions, reviews, order=[F.asc("place")])
    assert sorted((r["source_id"], r["extracted_aspect"], r["neg_text"]) for r in out.collect()) == [
        ("1", "bed", "early"), ("1", "tea", "early"), ("2", "bar", None),
    ]


def test_crosstabs(spark):
    df = spark.createDataFrame(
        [(3, "A", "NEGATIVE"), (3, "A", "NEGATIVE"), (3, "B", "POSITIVE"), (4, "B", "NEGATIVE")],
        "hotel_stars int, aspect_category string, sentiment string",
    )
    counts = {r["aspect_category"]: r.asDict() for r in aspects.crosstab(df, "aspect_category", "sentiment", aspects.SENTIMENTS).collect()}
    assert counts["A"] == {"aspect_category": "A", "NEGATIVE": 2, "NEUTRAL": 0, "POSITIVE": 0}
    shares = {r["hotel_stars"]: (r["A"], r["B"]) for r in aspects.crosstab_share(df, "hotel_stars", "aspect_category", ["A", "B"]).collect()}
    assert shares[3] == pytest.approx((200 / 3, 100 / 3)) and shares[4] == (0.0, 100.0)
    assert [tuple(r) for r in aspects.ranking(df, "aspect_category").collect()] == [("A", 2), ("B", 2)]


def test_language_accuracy_on_labelled_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = language.detect_language(docs, "text").where("language IS NOT NULL")
    assert found.agg(F.avg((F.col("lang") == F.col("language")).cast("double"))).first()[0] > 0.95
    assert found.count() > 0.95 * docs.count()


def test_language_filter_keeps_undetectable_text(spark):
    df = texts(spark, [("1", "The bed was very hard and the room was cold"), ("2", "Das Bett war sehr hart und nicht sauber"),
                       ("3", ""), ("4", None), ("5", "12345 ???"), ("6", "pokój był bardzo zimny i nie było ręczników")])
    assert sorted(r["source_id"] for r in language.filter_language(df, "neg_text").collect()) == ["1", "3", "4", "5"]


def test_foreign_texts_are_not_kept_as_english(spark):
    foreign = {
        "ru": "В номере было очень холодно и грязно", "uk": "У кімнаті було дуже холодно і брудно", "el": "Το δωμάτιο ήταν πολύ κρύο",
        "he": "החדר היה קר מאוד", "ja": "部屋はとても寒かったです", "nl": "De kamer was erg koud en het bed was niet schoon",
        "no": "Rommet var veldig kaldt og det var ikke rent", "sv": "Rummet var mycket kallt och det var inte rent",
        "hu": "A szoba nagyon hideg volt és nem volt tiszta", "sk": "Izba bola veľmi studená a nebolo tam čisto",
        "it": "La camera era molto fredda e non era pulita", "pt": "O quarto estava muito frio e não era limpo",
    }
    df = texts(spark, [*foreign.items(), ("en", "The room was cold and it was not clean"), ("none", "12 / 34")])
    found = {r["source_id"]: r["language"] for r in language.detect_language(df, "neg_text").collect()}
    assert found == {**{k: k for k in foreign}, "en": "en", "none": None}
    assert sorted(r["source_id"] for r in language.filter_language(df, "neg_text").collect()) == ["en", "none"]


def test_plurals_stems_and_phrases_are_aspects(spark):
    said = "The rooms were dirty, the beds hard, towels stained, prices expensive, amenities missing, air conditioning broken"
    rows = aspects.extract_phrases(texts(spark, [("1", said), ("2", ""), ("3", None)]), "neg_text").collect()
    found = {r["source_id"]: (list(r["aspect"]), list(r["sentiment"])) for r in rows}
    assert found["1"][0] == ["rooms", "beds", "towels", "prices", "amenities", "air conditioning"]
    assert set(found["1"][1]) == {"Negative"} and found["2"] == ([], []) and found["3"] == ([], [])

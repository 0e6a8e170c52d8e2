"""Languages by character n-grams, against a plain computation and on sentences of many languages."""

import math
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from guestlens.functions.seed_texts import SEED_TEXTS
from guestlens.operators import language

SENTENCES = [
    ("fr", "La piscine était fermée et personne ne nous avait prévenus avant notre arrivée."),
    ("lt", "Kambaryje buvo šalta ir niekas neatsakė į mūsų skambučius."),
    ("lv", "Numuriņš bija mazs un auksts, vannas istabā nebija dvieļu."),
    ("vi", "Khách sạn nằm xa trung tâm và thang máy bị hỏng suốt ba ngày."),
    ("id", "Kolam renang kotor dan lift rusak selama kami menginap di sana."),
    ("en", "The pool was closed and nobody had told us before we arrived."),
    ("de", "Der Pool war geschlossen und niemand hatte uns vorher Bescheid gesagt."),
    ("es", "La piscina estaba cerrada y nadie nos había avisado antes de llegar."),
    ("pl", "Basen był zamknięty i nikt nas o tym wcześniej nie uprzedził."),
    ("cs", "Bazén byl zavřený a nikdo nás předem neupozornil."),
    ("it", "La piscina era chiusa e nessuno ci aveva avvisati prima del nostro arrivo."),
    ("pt", "A piscina estava fechada e ninguém nos tinha avisado antes de chegarmos."),
    ("nl", "Het zwembad was gesloten en niemand had ons dat van tevoren verteld."),
    ("sv", "Poolen var stängd och ingen hade sagt något innan vi kom fram."),
    ("no", "Bassenget var stengt og ingen hadde sagt fra før vi kom."),
    ("da", "Poolen var lukket, og ingen havde sagt noget, før vi ankom."),
    ("fi", "Uima-allas oli suljettu eikä kukaan ollut kertonut siitä meille."),
    ("hu", "A medence zárva volt, és senki sem szólt nekünk előre."),
    ("tr", "Havuz kapalıydı ve gelmeden önce kimse bize haber vermedi."),
    ("ro", "Piscina era închisă și nimeni nu ne-a anunțat înainte să ajungem."),
    ("hr", "Bazen je bio zatvoren i nitko nam to nije rekao prije dolaska."),
    ("sk", "Bazén bol zatvorený a nikto nás vopred neupozornil."),
    ("ru", "Бассейн был закрыт, и никто нас не предупредил."),
    ("uk", "Басейн був зачинений, і ніхто нас не попередив."),
    ("el", "Η πισίνα ήταν κλειστή και κανείς δεν μας είχε ενημερώσει."),
    ("ja", "プールは閉まっていて、誰も教えてくれませんでした。"),
    ("zh", "游泳池关闭了,没有人提前告诉我们。"),
    ("ko", "수영장이 닫혀 있었고 아무도 미리 알려주지 않았습니다."),
    ("ar", "كان المسبح مغلقا ولم يخبرنا أحد قبل وصولنا."),
    ("he", "הבריכה הייתה סגורה ואף אחד לא הודיע לנו מראש."),
    ("sl", "Bazen je bil zaprt in nihče nas ni obvestil pred prihodom."),
    ("et", "Bassein oli suletud ja keegi ei olnud meid ette hoiatanud."),
    ("bg", "Басейнът беше затворен и никой не ни предупреди."),
    ("en", "Rooms were dirty"),
    ("en", "noisy street at night"),
    ("en", "small bathroom, no parking"),
    ("en", "Nothing"),
    ("pl", "brak parkingu"),
    ("ca", "La piscina estava tancada i ningú no ens havia avisat abans d'arribar."),
]
LETTERS = re.compile(r"[^\W\d_]+")


def brute_grams(text):
    out = []
    for word in LETTERS.findall((text or "").lower()):
        padded = f" {word} "
        out += [*word, *(padded[i : i + 2] for i in range(len(padded) - 1)), *(padded[i : i + 3] for i in range(len(padded) - 2))]
    return out


def brute_language(text, samples):
    """Weights straight from the definition, one text and one language at a time."""
    counts = {code: Counter(brute_grams(sample)) for code, sample in samples.items()}
    kinds = {n: len({g for c in counts.values() for g in c if len(g) == n}) for n in (1, 2, 3)}
    found = brute_grams(text)
    if not found:
        return None
    if not any(g in c for g in found for c in counts.values()):
        return "other"

    def score(code):
        total = {n: sum(k for g, k in counts[code].items() if len(g) == n) for n in (1, 2, 3)}
        return sum(round(1000 * math.log(0.95 * counts[code][g] / max(1, total[len(g)]) + 0.05 / kinds[len(g)])) for g in found)

    return min(counts, key=lambda code: (-score(code), code))


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, label string, text string")


def test_sentences_of_many_languages(spark):
    rows = [(i, code, text) for i, (code, text) in enumerate(SENTENCES)]
    found = language.detect_language(frame(spark, rows), "text").collect()
    assert len({code for code, _ in SENTENCES}) > 30
    wrong = [(r.label, r.language) for r in found if r.label != r.language]
    assert len(wrong) <= 1 and not any("en" in pair for pair in wrong)


def test_profile_equals_the_definition(spark):
    samples = {code: SEED_TEXTS[code] for code in ("en", "pl", "fi", "ru")}
    trained = language.train_profile(frame(spark, [(i, c, t) for i, (c, t) in enumerate(samples.items())]).repartition(3), "text", "label")
    assert {(r["language"], r["gram"]): r["n"] for r in trained.collect()} == {(c, g): n for c, t in samples.items() for g, n in Counter(brute_grams(t)).items()}
    profile = language.collect_profile(trained)
    texts = [t for _, t in SENTENCES] + ["", None, "123 !?", "ՀԱՅ", "a", "łóżko bed", "x" * 70_000, "zażółć gęślą jaźń " * 3]
    assert profile.languages_of(pa.array(texts)).to_pylist() == [brute_language(t, samples) for t in texts]


def test_only_texts_without_letters_have_no_language(spark):
    rows = [(1, None, None), (2, None, ""), (3, None, " 12 / 34 ?!"), (4, None, "a"), (5, None, "ՀԱՅ"), (6, None, "_")]
    found = {r.id: r.language for r in language.detect_language(frame(spark, rows), "text").collect()}
    assert [found[i] for i in (1, 2, 3, 6)] == [None] * 4 and found[4] is not None and found[5] == language.UNKNOWN
    assert {r.id for r in language.filter_language(frame(spark, rows), "text").collect()} >= {1, 2, 3, 6}


def test_training_on_half_tells_the_other_half(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    even = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    profile = language.collect_profile(language.train_profile(docs.where(even), "text", "lang"))
    result = language.accuracy(language.detect_language(docs.where(~even), "text", profile), "lang").collect()
    assert {r.lang for r in result} == {"en", "de", "fr", "es"} and all(r.share > 0.98 for r in result)


def test_size_keeps_the_most_frequent_grams(spark):
    rows = frame(spark, [(1, "a", "aab ab a"), (2, "b", "zz"), (3, None, "q"), (4, "c", None)])
    kept = {(r["language"], r["gram"], r["n"]) for r in language.train_profile(rows, "text", "label", 1).collect()}
    assert kept == {("a", "a", 4), ("a", " a", 3), ("a", "ab ", 2), ("b", "z", 2), ("b", " z", 1), ("b", " zz", 1)}


def test_memory_of_training_does_not_grow_with_a_batch(spark, monkeypatch):
    """Grams leave a task in slices: a batch of many distinct words holds no more of them at once than HELD_CHARS allows."""
    monkeypatch.setattr(language, "HELD_CHARS", 64)
    monkeypatch.setattr(language, "SLICE_BYTES", 64)
    text = lambda i: " ".join(f"{chr(97 + i % 7)}{chr(97 + k % 26)}{chr(97 + i % 26)}é" for k in range(i % 5))
    samples = [(i, "xyz"[i % 3], text(i)) for i in range(120)] + [(200, "x", None), (201, None, "q"), (202, "x", "w" * 300)]
    counts = Counter((c, g) for _, c, t in samples if c and t for g in brute_grams(t))
    found = {(r["language"], r["gram"]): r["n"] for r in language.train_profile(frame(spark, samples), "text", "label").collect()}
    assert found == counts
    sizes = [b.num_rows for b in language._gram_batches({("x", chr(0x4E00 + k)): 1 for k in range(20_000)})]
    assert len(sizes) > 1 and max(sizes) <= language.TOGETHER


def test_empty_tables(spark):
    none = frame(spark, []).limit(0)
    profile = language.collect_profile(language.train_profile(none, "text", "label"))
    assert profile.languages == () and language.detect_language(none, "text").collect() == []
    found = language.detect_language(frame(spark, [(1, None, "word"), (2, None, "")]), "text", profile).collect()
    assert {r.id: r.language for r in found} == {1: language.UNKNOWN, 2: None}


@pytest.mark.parametrize("size", [1, 2, 3])
def test_built_in_profile_has_all_languages(size):
    profile = language.built_in()
    assert set(profile.languages) == set(SEED_TEXTS) and len(profile.codes[size]) > 0

"""Extraction, quality, rules and packing: brute force, exact round trips and held-out accuracy."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from guestlens.llm import binary_output, bins, divergence_rules, host_extract, pattern_packing, quality_model, textbytes, tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " \n\t", "it's don't I'LL x y   İstanbul ﬁ ½ 12 3a <|endoftext|>a", "b\x01c \x01 \x01 é é", "日本語 क़ Σας ΟΔΟΣ", "x" * 5000]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en" if i % 3 else None, None, None) for i, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary_path())


def test_window_hashes_and_words_by_rows():
    texts = ["ab  ab\tab", None, "", " ab", "ab ", "é ab"]
    (part,) = textbytes.slices(pa.array(texts))
    found = textbytes.words(part)
    assert np.diff(found.first).tolist() == [3, 0, 0, 1, 1, 2]
    hashes = textbytes.Windows(part.data).hashes(found.starts, found.ends)
    assert len(set(hashes.tolist())) == 2
    values = np.random.default_rng(0).integers(0, 9, 300).astype(np.uint64)
    at = textbytes.sliding_argmin(values, 7)
    assert at.tolist() == [k + int(np.argmin(values[k : k + 7])) for k in range(294)]
    assert [len(s) for s in textbytes.slices(pa.array(["x" * 10] * 5), limit=20)] == [2, 2, 1]


def test_ids_of_pieces_are_those_of_the_text(tokenizer):
    rng = random.Random(2)
    texts = [t for t in ODD if t] + ["".join(rng.choice("aB c,.!\n\té'😀ß1 ") for _ in range(200)) for _ in range(40)]
    encoder = tokens.PieceEncoder(tokens.vocabulary_path())
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.ids([t.encode() for t in texts])] == expected


def test_full_store_changes_no_id(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_PIECES", 1)
    encoder = tokens.PieceEncoder(tokens.vocabulary_path())
    first = encoder.ids([b"one two three", b"two four"])
    assert encoder.ids([b"two four", b"one two three five"])[0] == first[1]


def test_words_before_symbols_are_encoded_once():
    found, plain = tokens.PieceEncoder(tokens.vocabulary_path()), tokens.PieceEncoder(tokens.vocabulary_path())
    odd = ["unheardofword", "unheardofword,", "unheardofword's", "it's,", "\u0130,", "\u0958.", "e\u0301!", "\u00e9!", "a1,", "a<|endoftext|>", "a<|endoftext|>.", "&&", "x'", "'s", "\u01c5.", "\u00b2.", "\u4e2d,", "w\u0301\u0327,"]
    assert found.ids([" ".join(odd).encode(), *(t.encode() for t in odd)]) == [x.tobytes() for x in plain._raw([" ".join(odd), *odd])]
    batches = []
    together = found._together
    found._together = lambda pieces: batches.append(pieces) or together(pieces)
    found.ids([b"neverseenbefore neverseenbefore, neverseenbefore; neverseenbefore!"])
    assert sorted(p for b in batches for p in b if p.startswith(b"never")) == [b"neverseenbefore"]


def test_store_is_asked_once_for_a_piece():
    class Store(dict):
        asked = 0

        def get(self, *args):
            self.asked += 1
            return super().get(*args)

        def __getitem__(self, key):
            self.asked += 1
            return super().__getitem__(key)

        def __contains__(self, key):
            self.asked += 1
            return super().__contains__(key)

    found = tokens.PieceEncoder(tokens.vocabulary_path())
    plain = tokens.PieceEncoder(tokens.vocabulary_path())
    texts = ["one two one three", "two \x01 é1 two", "", "ONE Two unheardofword"]
    found.known = Store()
    for _ in range(2):
        found.known.asked = 0
        assert found.ids([t.encode() for t in texts]) == [x.tobytes() for x in plain._raw(texts)]
        assert found.known.asked <= sum(len(t.split()) for t in texts)


def test_room_tree():
    tree, rooms = bins.RoomTree(100), Counter()
    rng = random.Random(4)
    for _ in range(500):
        room = rng.randint(0, 100)
        by = 1 if not rooms[room] or rng.random() < 0.6 else -1
        rooms[room] += by
        tree.change(room, by)
        want = rng.randint(0, 100)
        assert tree.least(want) == min((r for r, c in rooms.items() if c and r >= want), default=None)


def best_fit_bins(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda k: rooms[k])] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


@pytest.mark.parametrize("maker", [lambda c, h: planned(bins.Plan(c, h)), lambda c, h: pattern_packing.pattern_plan(h, c, 1)])
def test_plans_place_every_item_once(maker):
    rng = np.random.default_rng(1)
    for capacity in (16, 64):
        lengths = np.minimum(rng.geometric(0.12, 400), capacity)
        histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)), strict=True))
        plan = maker(capacity, histogram)
        own = np.repeat(list(histogram), list(histogram.values()))
        number = np.concatenate([np.arange(c) for c in histogram.values()])
        where, offset = bins.placed(plan.table(), own, number)
        room = np.zeros((plan.bins, capacity), int)
        for b, o, n in zip(where, offset, own, strict=True):
            room[b, o : o + n] += 1
        assert room.max() == 1 and room.sum() == own.sum()
        assert all((np.diff(r) <= 0).all() for r in room)
        assert plan.bins <= best_fit_bins(lengths.tolist(), capacity) + 2


def planned(plan):
    plan.best_fit_decreasing()
    return plan


def test_best_fit_by_runs_needs_as_many_bins_as_one_by_one():
    rng = np.random.default_rng(3)
    for _ in range(20):
        lengths = rng.integers(1, 50, 200).tolist()
        assert planned(bins.Plan(50, Counter(lengths))).bins == best_fit_bins(lengths, 50)


def test_patterns_add_up_and_fit():
    found = pattern_packing.patterns(np.array([1, 2, 3, 5, 8]), 8)
    assert {tuple(p) for p in found.tolist()} == {(8, 0, 0), (5, 3, 0), (5, 2, 1), (3, 3, 2)}
    wanted = np.zeros(9)
    wanted[[8, 5, 3]] = 4, 7, 7
    counts = pattern_packing.fitted(found, wanted)
    assert counts.min() >= 0 and dict(zip(map(tuple, found.tolist()), counts.round(1), strict=True))[(5, 3, 0)] == pytest.approx(7, abs=0.2)


def pieces_of(texts, tokenizer, capacity):
    out = {}
    for i, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k in range(0, len(ids), capacity):
            own = ids[k : k + capacity]
            out[i, k // capacity] = (k, len(own), zlib.crc32(own.tobytes()))
    return out


def test_packed_pieces(spark, tokenizer):
    rng = random.Random(6)
    texts = list(enumerate([*ODD, *("word " * rng.randint(0, 300) for _ in range(60))]))
    rows = pattern_packing.pack(frame(spark, texts), tokens.vocabulary_path(), capacity=256, step=8).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == pieces_of(texts, tokenizer, 256)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False)) and sum(parts[-1]) <= 256
    assert len(sequences) <= sum(r["length"] for r in rows) / 256 * 1.1 + 2
    assert pattern_packing.pack(frame(spark, []), tokens.vocabulary_path()).count() == 0


def test_repeated_rows_are_packed_twice(spark):
    rows = pattern_packing.pack(frame(spark, [(1, "a b"), (1, "a b")]), tokens.vocabulary_path()).collect()
    assert sorted((r["doc_id"], r["offset"]) for r in rows) == [(1, 0), (1, 3)]


def test_matrices_round_trip(spark, tokenizer, tmp_path):
    texts = list(enumerate([*ODD, "a short one", "word " * 500]))
    rows = binary_output.packed_rows(frame(spark, texts), tokens.vocabulary_path(), row_ids=128)
    binary_output.write_matrices(rows, str(tmp_path / "m"), row_ids=128)
    table = spark.read.parquet(str(tmp_path / "m")).toPandas()
    found = {}
    for _, r in table.iterrows():
        ids, places = np.frombuffer(r["input_ids"], "<u2"), np.frombuffer(r["position_ids"], "<u2")
        ends = np.asarray(r["cu_seqlens"])
        assert len(ids) == len(places) == 128 and ends[0] == 0 and ends[-1] == r["n_ids"] and not ids[r["n_ids"] :].any()
        for doc, piece, a, b in zip(r["segment_docs"], r["segment_pieces"], ends, ends[1:], strict=False):
            found[doc, piece] = ids[a:b].tolist()
            assert places[a:b].tolist() == list(range(b - a))
    for i, text in texts:
        whole = [x for k in sorted(k for k in found if k[0] == i) for x in found[k]]
        assert whole == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
    again = {row: ids.tolist() for row, ids, _ in binary_output.read_matrix(str(tmp_path / "m"))}
    assert sum(map(len, again.values())) == sum(map(len, found.values()))


def base_measures(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    twice = {x for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for x in range(k, k + 5)}
    failed = len(words) < 10 or 100 * len(twice) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(twice), failed


def test_base_measures(spark):
    rng = random.Random(9)
    texts = list(enumerate([*ODD, "\n", "a\n\na\na", "a b c d e " * 30, *("".join(rng.choice("ab \n|é") for _ in range(rng.randint(0, 300))) for _ in range(80))]))
    rows = divergence_rules.measured(frame(spark, texts)).collect()
    assert {r[0]: tuple(r)[1:7] for r in rows} == {i: base_measures(t) for i, t in texts}
    assert not any(r["kept"] and r["base_failed"] for r in rows)
    assert divergence_rules.measured(frame(spark, [])).count() == 0


def test_distance_is_jensen_shannon():
    got = divergence_rules.distance(np.array([[4, 0], [1, 1], [0, 4], [0, 0]]), np.array([0.5, 0.5]))
    assert got[1] == 0 and got[3] == 0 and got[0] == pytest.approx(got[2]) and got[0] == pytest.approx(0.5579, abs=1e-3)


def test_rare_language_is_judged_by_its_own_texts(spark):
    rng = random.Random(11)
    english, russian = ("the of and to in that is was for it with as his on be".split(), "и в не на что он как это его но они мы был для она".split())
    text = lambda common, letters: " ".join(rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(400))
    plain = [(100 + i, text(english, "abcdefghijklmnoprstuvw"), "en") for i in range(20)]
    rare = [(i, text(russian, "абвгдежзийклмнопрстуфхцч"), "ru") for i in range(12)]
    noise = " ".join("#$%"[k % 3] * 3 + str(k) for k in range(200))
    odd = [(90, noise, "ru"), (91, noise, "en"), (92, text(russian, "абвгдежзийклмноп"), "uk"), (93, "и " * 50, "uk"), (94, None, "uk"), (95, None, "none")]
    schema = "doc_id long, text string, lang string"
    docs = spark.createDataFrame(plain, schema).crossJoin(spark.range(130).select()).unionByName(spark.createDataFrame(rare + odd, schema))
    assert 12 * 400 < 20 * 130 * 400 * divergence_rules.LEAST_SHARE
    wide = docs.unionByName(docs.filter("doc_id >= 100").withColumn("doc_id", F.col("doc_id") + 100))
    for given in (docs, wide):
        kept = {r["doc_id"] for r in divergence_rules.measured(given).where("kept").collect()}
        assert kept & set(range(100)) == {*range(12), 92} and kept >= set(range(100, 120))
        good = divergence_rules.keep_good(given)
        assert good.columns == given.columns and {r["doc_id"] for r in good.collect()} == kept


def test_rules_agree_with_labels_and_keep_columns(spark, small):
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    judged = divergence_rules.measured(docs).join(labels, "doc_id").where("not base_failed").toPandas()
    assert (judged["kept"] == (judged["quality"] == 1)).mean() > 0.97
    assert judged[judged["quality"] == 1]["kept"].mean() > 0.99
    extra = docs.selectExpr("text", "doc_id", "lang", "1 AS kept", "2 AS n_words")
    kept = divergence_rules.keep_good(extra)
    assert kept.columns == extra.columns and kept.count() == divergence_rules.measured(docs).where("kept").count()


def test_quality_on_held_out_labels(spark, small):
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    rows = quality_model.scored(docs, labels).toPandas()
    assert (rows["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in rows["doc_id"]]).all()
    assert ((rows["score"] >= 0) & (rows["score"] <= 1)).all() and (rows["predicted"] == (rows["score"] >= 0.7)).all()
    held = rows.merge(labels.toPandas(), on="doc_id").query("held_out")
    assert (held["predicted"] == held["quality"]).mean() > 0.93


def test_quality_ignores_held_out_labels_and_odd_rows(spark):
    texts = [(i, t) for i, t in enumerate([*ODD, *("good words here" if i % 2 else "*** ### $$$" for i in range(60))])]
    labels = [(i, int(i % 2 == len(ODD) % 2 or i < len(ODD)), 0) for i, _ in texts]
    turned = [(i, 1 - q if quality_model.fold(i) == 2 else q, t) for i, q, t in labels] + [(999, None, 0)]
    schema = "doc_id long, quality int, toxic int"
    one, two = (quality_model.scored(frame(spark, texts), spark.createDataFrame(x, schema)).collect() for x in (labels, turned))
    assert sorted(map(tuple, one)) == sorted(map(tuple, two)) and len(one) == len(texts)
    none = quality_model.scored(frame(spark, texts[:3]), spark.createDataFrame([], schema)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality_model.scored(frame(spark, []), spark.createDataFrame([], schema)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">menu</a></li></ul></nav>
<!-- ad --><div class="ad">Buy</div><div class="cookie-notice">We use cookies</div><div class="post-%d"><h1>Head &amp;  line</h1><p><b>One.<br><p>Two &eacute;&nbsp; %s</p>
<form><p>mail</p></form><aside>side</aside><div class="comments"><p>A reader's comment, longer than the article itself by far, to be sure.</p></div></div><footer>&copy; x</footer></body></html>"""


def test_pages_of_a_host(spark):
    rows = [(i, f"https://user@H.example:80/{i}", PAGE % (i, "x" * i)) for i in range(6)]
    rows += [(10, "https://h.example/y", "<p>no container<p>here"), (11, None, PAGE % (1, "z")), (12, "https://h.example", None), (13, "h", ""), (14, "https://h.example", "<nav>menu</nav>")]
    got = {r["page_id"]: r for r in host_extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(6):
        assert got[i]["text"] == "Head & line\nOne.\n" + f"Two é {'x' * i}".strip()
    assert got[10]["text"] == "no container\nhere" and got[11]["text"].endswith("Two é z")
    assert [got[i]["text"] for i in (12, 13, 14)] == ["", "", ""]
    assert all(r["n_chars"] == len(r["text"]) for r in got.values()) and got[11]["url"] is None


def test_pages_against_their_article(spark, small):
    import html

    pages = spark.read.parquet(f"{small}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in host_extract.main_text(pages).collect()}
    for page_id, _, source in pages.collect():
        article = re.search("<article>(.*)</article>", source, re.S).group(1)
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article))
        assert got[page_id] == "\n".join(b for b in blocks if b)


def test_paths_without_digits_and_hidden_elements():
    page = host_extract.parsed('<body><div class="b2 a1"><p>x</p><div style="display: none"><p>no</p></div></div></body>')
    path = host_extract.best_path(host_extract.container_scores(page))
    assert path == ">body>div.a.b" and host_extract.text_on(page, path) == "x"


def test_text_around_and_beside_the_winner(spark):
    long = lambda w, n: f"<p>{' '.join([w] * n)}</p>"
    titled = "<body><nav>menu</nav><article><h1>T{0}</h1><p>lead</p><div class='body'>{1}</div></article></body>"
    sections = "<body><main><section class='a'>{1}</section><section class='b'><p>short part {0}</p></section></main></body>"
    wrapped = "<body><div class='content has-sidebar'>{1}<div class='sidebar'><p>links here</p></div></div></body>"
    listed = "<body><div><p><a href='/x'>%s</a></p><div class='text'>{1}</div></div></body>" % ("menu of links " * 30)
    other = "<body><div class='story'>%s</div><article><p>teaser</p></article></body>" % long("story", 90)
    rows = [(10 * k + i, f"https://h{k}.example/{i}", source.format(i, long("word", 40))) for k, source in enumerate([titled, sections, wrapped, listed]) for i in range(5)]
    rows.append((9, "https://h0.example/9", other))
    got = {r["page_id"]: r["text"] for r in host_extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    body = " ".join(["word"] * 40)
    for i in range(5):
        assert got[i] == f"T{i}\nlead\n{body}"
        assert got[10 + i] == f"{body}\nshort part {i}"
        assert got[20 + i] == body and got[30 + i] == body
    assert got[9].startswith("story story")

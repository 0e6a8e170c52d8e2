"""Near duplicates, repeated spans and similar lines against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from guestlens.llm import bayes_dedup, compaction, decontaminate, line_join, run_index
from guestlens.llm.components import connected

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, schema=SCHEMA):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in texts], schema)


def corpus(seed=3, size=60):
    """Random texts with copies, near copies, shared passages, and the awkward cases."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 6)))
    passage = [word() for _ in range(70)]
    texts = []
    for _ in range(size):
        kind = rng.random()
        if kind < 0.25 and texts:
            texts.append(rng.choice(texts))
        elif kind < 0.5 and texts:
            words = rng.choice(texts).split(" ")
            words[rng.randrange(len(words))] = word()
            texts.append(" ".join(words))
        else:
            words = [word() for _ in range(rng.randint(1, 90))]
            if rng.random() < 0.5:
                at = rng.randrange(len(words) + 1)
                words[at:at] = passage[rng.randint(0, 30) : rng.randint(45, 70)]
            texts.append(" ".join(words).replace(" a", "\na"))
    texts += [None, "", "  \t\n ", "one", "One", "x y", "the same line\nthe same line\n\nthe same line", "é" * 130 + " ü", "a " * 400]
    return list(enumerate(texts))


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def components(texts, size, percent):
    sets = {i: shingles(t, size) for i, t in texts}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in sets}


def test_components_of_links(spark):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1060)]
    found = {r["id"]: r["component"] for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}
    for a, b in links:
        root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert found == {i: root[i] for i in linked}


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, size, percent):
    texts = corpus()
    rows = bayes_dedup.near_duplicates(frame(spark, texts), bayes_dedup.Rule(size, percent)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == components(texts, size, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_large_group_of_near_copies_needs_blocks(spark):
    rng = random.Random(8)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for i in range(260):
        words = list(base)
        for at in rng.sample(range(120), rng.choice([0, 1, 2, 3, 6, 9, 14])):
            words[at] = f"x{rng.randrange(10**6)}"
        texts.append((i, " ".join(words)))
    rows = bayes_dedup.near_duplicates(frame(spark, texts), bayes_dedup.Rule(3, 85)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == components(texts, 3, 85)


def test_keep_one_keeps_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e f", 1, "k"), (2, "a b c d e f", 2, "l"), (3, None, 3, "m")], "doc_id long, text string, kept int, component string")
    assert sorted(map(tuple, bayes_dedup.keep_one(df).collect())) == [(1, "a b c d e f", 1, "k"), (3, None, 3, "m")]


def without_windows(texts, window):
    """Per document what is left when words of windows found in an earlier document go."""
    first, out = {}, {}
    for i, text in texts:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if first.setdefault(tuple(words[k : k + window]), i) < i:
                gone[k : k + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[i] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_compacted_spans(spark, seed):
    texts = corpus(seed)
    rows = compaction.removal_digest(frame(spark, texts)).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == without_windows(texts, 13)


def without_bytes(texts, window):
    seen, out = set(), {}
    for i, text in texts:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - window + 1):
            own = data[k : k + window]
            if own in seen:
                gone[k : k + window] = True
            seen.add(own)
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out[i] = (len(data), int(gone.sum()), run_index.spans_of(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_run_index_removal(spark, seed):
    texts = corpus(seed)
    rows = run_index.removal_digest(frame(spark, texts)).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == without_bytes(texts, 100)


def test_run_index_against_all_windows():
    rng = random.Random(1)
    for _ in range(200):
        pieces = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 8))]
        pieces.append(pieces[0][3:] + b"x")
        group = pd.DataFrame({"doc_id": range(len(pieces)), "lo": 0, "bytes": pieces})
        found = {(d, k) for d, low, n in run_index.marked(group, 5).itertuples(index=False) for k in range(low, low + n)}
        seen, expected = set(), set()
        for d, piece in enumerate(pieces):
            for k in range(len(piece) - 4):
                if piece[k : k + 5] in seen:
                    expected.add((d, k))
                seen.add(piece[k : k + 5])
        assert found == expected


def test_large_anchor_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(run_index, "SHARD_ROWS", 4)
    passage = "the passage that all of these documents share, word for word, over rather more than one hundred bytes of text in all"
    texts = [(i, f"{i * 7919} {'ab'[i % 2] * (i % 5)} {passage} {i * 104729}") for i in range(30)]
    rows = run_index.removal_digest(frame(spark, texts)).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == without_bytes(texts, 100)


def test_common_anchor_makes_rows_in_proportion(spark, monkeypatch):
    """Contexts of a common anchor are dealt by their windows: no row is made for each pair of blocks."""
    monkeypatch.setattr(run_index, "SHARD_ROWS", 4)
    line = "a line that very many of these documents have in common, word for word, in one hundred bytes and some more of them"
    tails = ["nothing else", "nothing else at all, and then some more words of its own kind until the very end of it", "", "é ü"]
    texts = [(i, f"{i * 7919} {line} {tails[i % 4]} {i % 11}") for i in range(48)]
    spans = run_index.repeated_bytes(frame(spark, texts))
    assert "Generate" not in spans._jdf.queryExecution().executedPlan().toString()
    # every window comes once: no pair of blocks finds it again
    places = [(r["doc_id"], k) for r in spans.collect() for k in range(r["lo"], r["lo"] + r["n"])]
    assert len(places) == len(set(places))
    rows = run_index.removal_digest(frame(spark, texts)).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == without_bytes(texts, 100)


def removed_lines(texts, size=5, percent=80):
    sets, out = [], {}
    for i, text in texts:
        out[i] = []
        for k, line in enumerate((text or "").split("\n")):
            own = shingles(line, size)
            if own:
                if any(100 * len(own & s) >= percent * len(own | s) for s in sets):
                    out[i].append(k)
                sets.append(own)
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_similar_lines(spark, seed):
    texts = corpus(seed)
    rows = line_join.line_report(frame(spark, texts)).collect()
    assert {r["doc_id"]: list(r["removed_lines"]) for r in rows} == removed_lines(texts)
    assert {r["doc_id"]: r["n_lines"] for r in rows} == {i: len((t or "").split("\n")) for i, t in texts}


def removed_by_words(texts, percent=80):
    bags, out = [], {}
    for i, text in texts:
        out[i] = []
        for k, line in enumerate((text or "").split("\n")):
            own = Counter(line.encode().lower().split())
            if own:
                if any(100 * (own & b).total() >= percent * (own | b).total() for b in bags):
                    out[i].append(k)
                bags.append(own)
    return out


@pytest.mark.parametrize("seed,block,star,short", [(3, 1024, 32, 512), (4, 3, 2, 4), (5, 8, 1, 0)])
def test_similar_lines_by_words(spark, monkeypatch, seed, block, star, short):
    monkeypatch.setattr(line_join, "BLOCK", block)
    monkeypatch.setattr(line_join, "STAR", star)
    monkeypatch.setattr(line_join, "SHORT", short)
    texts = corpus(seed)
    extra = ["a b c d e f g h i j k l", "a b c X e f g h i j k l", "l k j i h g f e d c b a", "a a a a a", "a a a a", "a a a", "p q r s", "p q r s t", "p q r"]
    texts += [(1000 + k, t) for k, t in enumerate(extra)]
    rows = line_join.line_report(frame(spark, texts), line_join.WORDS).collect()
    assert {r["doc_id"]: list(r["removed_lines"]) for r in rows} == removed_by_words(texts)


def test_rare_words_lead_the_prefixes(spark, monkeypatch):
    rng, kept, write = random.Random(8), [], line_join.written
    common = [f"c{k}" for k in range(3000)]
    texts = [(i, " ".join([f"r{i}x{k}" for k in range(8)] + rng.sample(common, 28))) for i in range(1500)]
    monkeypatch.setattr(line_join, "written", lambda df: kept.append(write(df)) or kept[-1])
    line_join.later_lines(frame(spark, texts), line_join.WORDS)
    lines = next(df for df in kept if "prefix" in df.columns)
    uses = Counter(token for r in lines.select("prefix").collect() for token in r["prefix"])
    assert sum(n for n in uses.values() if n > 1) < 0.05 * sum(uses.values())


@pytest.mark.parametrize("wide,rows,bits,star", [(3, 0, 60, 1), (80, 1_000_000, 32, 3)])
def test_text_is_cut_once_for_the_whole_table(spark, monkeypatch, wide, rows, bits, star):
    """Also with hashes of which most have equal halves, maps of two parts and no broadcasts."""
    from pyspark.sql import functions as F

    cut, words = [], line_join._words
    monkeypatch.setattr(line_join, "_words", lambda docs: cut.append(docs.columns) or words(docs))
    monkeypatch.setattr(line_join, "_heads", lambda hashes: F.transform(hashes, lambda h: F.shiftright(h, bits).cast("int")), raising=False)
    monkeypatch.setattr(line_join, "WIDE", wide, raising=False)
    monkeypatch.setattr(line_join, "BROADCAST_ROWS", rows)
    monkeypatch.setattr(line_join, "STAR", star)
    texts = corpus(6, 40)
    found = line_join.line_report(frame(spark, texts), line_join.WORDS).collect()
    assert {r["doc_id"]: list(r["removed_lines"]) for r in found} == removed_by_words(texts)
    assert sum("lang" in columns for columns in cut) == 1


def test_every_white_space_parts_words(spark):
    texts = [(1, "a\tb\x0bc\x0cd\re"), (2, " a  b c d   e "), (3, "a\u00a0b c d e"), (4, "\t\r \x0b")]
    rows = line_join.line_report(frame(spark, texts), line_join.WORDS).collect()
    assert {r["doc_id"]: list(r["removed_lines"]) for r in rows} == {1: [], 2: [0], 3: [], 4: []}


def test_rows_of_one_id_keep_their_lines_apart(spark):
    near = "one line of a dozen words in all that comes back once"
    texts = [(1, near), (2, "other words of some kind here"), (2, near.replace("back", "here")), (3, "other words of some kind here")]
    rows = line_join.later_lines(frame(spark, texts), line_join.WORDS).collect()
    assert sorted((r["doc_id"], r["removed"]) for r in rows) == [(1, False), (2, False), (2, True), (3, True)]


def test_pipeline_cuts_lines_with_one_changed_word(spark):
    import corpus_pipeline

    texts = [(1, "one line of a dozen words in all that comes back once"), (2, "one line of a dozen words in all that comes here once\nother")]
    kept = corpus_pipeline.line_dedup(spark, frame(spark, texts), "")
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == {1: texts[0][1], 2: "other"}


def test_lines_are_cut_and_columns_stay(spark):
    line = "one line of quite a few words to repeat"
    df = spark.createDataFrame(
        [(1, f"{line}\nown words here", "x", 1), (2, f"before\n{line}\n\nafter", "y", 2), (3, line, "z", 3), (4, None, "n", 4), (5, "", "e", 5)],
        "doc_id long, text string, removed string, class long",
    )
    got = sorted(map(tuple, line_join.without_later_lines(df).collect()))
    assert got == [(1, f"{line}\nown words here", "x", 1), (2, "before\n\nafter", "y", 2), (4, None, "n", 4), (5, "", "e", 5)]


def test_contaminated_documents(spark):
    rng = random.Random(5)
    word = lambda: rng.choice("the of to in a and is it on by".split()) + str(rng.randrange(40))
    items = [(k, " ".join(word() for _ in range(rng.randint(5, 60)))) for k in range(25)] + [(90, "two words"), (91, ""), (92, None)]
    texts = []
    for i in range(80):
        words = [word() for _ in range(rng.randint(0, 400))]
        if i % 3 == 0:
            own = items[rng.randrange(25)][1].split()
            if i % 2:
                own[len(own) // 2] = "changed"
            words[len(words) // 2 : len(words) // 2] = own[: rng.randint(1, len(own))] if i % 5 == 0 else own
        texts.append((i, " ".join(words).upper()))
    texts += [(800, None), (801, ""), (802, "Two  words"), (803, "two words more")]
    sets = {k: shingles(t, 5) for k, t in items}
    expected = set()
    for i, t in texts:
        own = shingles(t, 5)
        for k, s in sets.items():
            if s and 100 * len(s & own) >= 80 * len(s):
                expected.add((i, k, len(s), len(s & own)))
    docs, bench = frame(spark, texts), spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, doc_id long")
    assert {tuple(r) for r in decontaminate.contaminated(docs, bench).collect()} == expected
    kept = {r["doc_id"] for r in decontaminate.without_items(docs, bench).collect()}
    assert kept == {i for i, _ in texts} - {e[0] for e in expected}
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_least_hits_is_exact_for_whole_sets_and_bounded_for_sketches():
    assert decontaminate.least_hits(10) == 8 and decontaminate.least_hits(1) == 1
    assert 8 <= decontaminate.least_hits(500) <= 16


def test_posterior_rule_prunes_only_the_improbable():
    steps = bayes_dedup.Rule(3, 85).least_matches()
    assert [n for n, _ in steps] == [16, 32, 48, 64] and all(m < n * 0.85 for n, m in steps)


OPERATORS = {
    "near": lambda d: bayes_dedup.near_duplicates(d),
    "words": lambda d: compaction.removal_digest(d),
    "bytes": lambda d: run_index.removal_digest(d),
    "lines": lambda d: line_join.line_report(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables_and_repeated_rows(spark, name):
    run = OPERATORS[name]
    assert run(frame(spark, [])).count() == 0
    long = " ".join(f"w{k}" for k in range(60))
    rows = run(frame(spark, [(1, long), (1, long), (2, long)])).collect()
    by_doc = defaultdict(set)
    for r in rows:
        by_doc[r["doc_id"]].add(str(r))
    assert set(by_doc) == {1, 2} and Counter(map(len, by_doc.values()))[1] == 2


def test_rows_without_doc_id_stay_and_remove_nothing(spark):
    line = "one line of quite a few words to repeat in another row"
    df = spark.createDataFrame([(None, line, 1), (5, line, 2), (None, None, 3)], "doc_id long, text string, kept int")
    assert sorted(r["kept"] for r in bayes_dedup.keep_one(df).collect()) == [1, 2, 3]
    assert sorted(r["kept"] for r in line_join.without_later_lines(df).where("text is not null").collect()) == [1, 2]
    assert {(r["doc_id"], r["n_removed"]) for r in compaction.removal_digest(df).collect()} == {(None, 0), (5, 0)}
    assert {(r["doc_id"], r["n_removed"]) for r in run_index.removal_digest(df).collect()} == {(None, 0), (5, 0)}

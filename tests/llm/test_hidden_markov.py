"""Hidden Markov scores against sums over all state paths, and on held-out documents."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from guestlens.llm import hidden_markov as hm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, chunk string, c int, words string, ids int"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*WORD.findall((text or "").translate(UPPER)), ""]


def learns(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2


def brute_base(rows):
    counts = Counter(w for i, t in rows if learns(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        ws = tokens(t)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
        out.append((i, i is not None and not learns(i), len(ws), sum(counts[w] > 0 for w in ws), n, round(base, 6)))
    return sorted(out, key=str)


def some_rows(n=150):
    rng = random.Random(6)
    texts = [None, "", " \n", "A B a b", "Z\x0bz\x85 İ", "one " * 5000]
    texts += [" ".join(rng.choice(["red", "Blue", "é", f"w{rng.randrange(50)}"]) for _ in range(rng.randrange(90))) for _ in range(n)]
    return list(enumerate(texts)) + [(9, texts[9]), (None, "red blue unmet")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "c", 1, "w", 2) for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture
def model():
    rng = np.random.default_rng(2)
    mass = np.zeros(hm.CLASSES)
    mass[:5] = [3, 1, 4, 1, 5]
    return hm.Model.of(rng.random(3), rng.random(3), 9 * rng.random((3, 3)), mass[:, None] * rng.random((hm.CLASSES, 3)), mass, 0.01)


def paths(classes, model, start):
    """Probability of every state path together with the classes."""
    for path in itertools.product(range(3), repeat=len(classes)):
        p = start[path[0]] * model.emit[classes[0], path[0]]
        for a, b, c in zip(path, path[1:], classes[1:]):
            p *= model.move[a, b] * model.emit[c, b]
        yield path, p


def test_forward_is_the_sum_over_paths(model):
    classes = np.array([0, 2, 4, 1, 3, 3, 0, hm.UNSEEN, 2], np.uint16)
    heads, lengths = np.array([0, 5, 6]), np.array([5, 1, 3])
    found = hm.forward(classes, heads, lengths, model)
    for h, n, value in zip(heads, lengths, found):
        assert math.isclose(value, math.log10(sum(p for _, p in paths(classes[h : h + n], model, model.start))), abs_tol=1e-12)


def test_states_are_distributions(model):
    assert np.allclose(model.emit.sum(0), 1) and np.allclose(model.move.sum(1), 1)
    assert np.allclose(model.emit[hm.UNSEEN], 0.01)


def test_expected_counts_are_those_of_all_paths(model):
    classes = np.array([0, 2, 4, 1, 3, 3, 0, 1], np.uint16)
    heads, lengths, opens = np.array([0, 5]), np.array([5, 3]), np.array([True, False])
    counts = hm.Counts(3)
    counts.add(classes, heads, lengths, opens, model)
    start, inner, move, emit, log = np.zeros(3), np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3)), 0.0
    for h, n, first in zip(heads, lengths, opens):
        part = classes[h : h + n]
        each = list(paths(part, model, model.start if first else model.inner))
        total = sum(p for _, p in each)
        log += math.log10(total)
        for path, p in each:
            (start if first else inner)[path[0]] += p / total
            for a, b in zip(path, path[1:]):
                move[a, b] += p / total
            for c, s in zip(part, path):
                emit[c, s] += p / total
    for found, expected in ((counts.start, start), (counts.inner, inner), (counts.move, move), (counts.emit[:5], emit), (counts.log, log)):
        assert np.allclose(found, expected, atol=1e-5)


def test_stretches_cover_documents():
    lengths = np.array([3, 64, 65, 200])
    heads = np.cumsum(lengths) - lengths
    first, size, opens = hm._stretches(lengths, heads)
    assert sorted(itertools.chain.from_iterable(range(a, a + n) for a, n in zip(first, size))) == list(range(332))
    assert size.max() == 64 and (np.diff(size) <= 0).all() and sorted(first[opens]) == heads.tolist()


def test_base_columns_of_odd_texts(spark):
    rows = some_rows()
    found = hm.scored(frame(spark, rows), 4, 2).collect()
    assert sorted(((*r[:5], round(r.base_score, 6)) for r in found), key=str) == brute_base(rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)


def test_one_state_is_the_base_model(spark):
    """With one state the class and inside factors multiply to the base model, up to the mix of counts and counts + 1."""
    rows = [(i, "a b c a a " * 40) for i in range(40)]
    found = hm.scored(frame(spark, rows), 1, 2).collect()
    assert all(abs(r.score - r.base_score) < 0.01 * abs(r.base_score) for r in found)


def test_shared_classes_keep_words_apart(spark, monkeypatch):
    """Classes shared by words don't change the base columns, and a class's words add up to it."""
    monkeypatch.setattr(hm, "COMMON", 3)
    rows = some_rows(60)
    parts = hm.stored(hm.chunks(frame(spark, rows)))
    vocab = hm.vocabulary(parts)
    words = vocab.words.where("c > 0").collect()
    sums = Counter()
    for r in words:
        sums[r["class"]] += (r["c"] + 1) / vocab.mass[r["class"]]
    assert sum(r["class"] < 3 for r in words) == 3 and all(math.isclose(x, 1) for x in sums.values())
    assert (vocab.tokens, vocab.distinct) == (sum(r["c"] for r in words), len(words))


def test_nothing_to_learn_and_empty_table(spark):
    held = next(i for i in range(100) if not learns(i))
    (row,) = hm.scored(frame(spark, [(held, "a b")])).collect()
    assert tuple(row) == (held, True, 3, 0, 0, 0.0, pytest.approx(0, abs=1e-12))
    assert hm.scored(frame(spark, []).limit(0)).collect() == []


def test_likelihood_grows_and_held_out_documents_gain(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    parts = hm.stored(hm.chunks(docs))
    vocab = hm.vocabulary(parts)
    model, likelihood = hm.trained(hm.stored(hm.coded(parts, vocab)), vocab)
    assert all(b > a for a, b in zip(likelihood, likelihood[1:]))
    rows = [r for r in hm.scored(docs).collect() if r.held_out and r.n_tokens > 1]
    assert len(rows) > 100
    assert sum(r.score for r in rows) > 0.95 * sum(r.base_score for r in rows)
    assert sum(r.score > r.base_score for r in rows) > 0.8 * len(rows)

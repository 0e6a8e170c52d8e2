"""Periodic runs against brute force over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from guestlens.llm import periodic_runs as pr

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, runs string, h int, period int"


def brute_runs(words, least=24, times=3):
    """Every maximal stretch by the definition: each period in turn, smallest period per stretch."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, times * q):
                found.setdefault((i, length), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def brute_digest(doc_id, text):
    words = brute_planted(doc_id, WORD.findall(text or ""))
    runs = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2], *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


def spoilt(rng, n, letters):
    words = [rng.choice("abcdeé"[:letters]) * rng.randrange(1, 3) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        a = rng.randrange(n)
        p = rng.randrange(1, max(2, (n - a) // 3 + 1))
        for i in range(a, rng.randrange(a, n + 1)):
            words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("least", [5, 9, 24, 60])
def test_runs_of_signs(least):
    rng = random.Random(least)
    for _ in range(300):
        words = spoilt(rng, rng.randrange(1, 220), rng.choice([1, 2, 3, 6]))
        codes = {w: k for k, w in enumerate(sorted(set(words)))}
        signs = np.array([codes[w] for w in words] + [len(codes)])
        assert sorted(map(tuple, pr.find_runs(signs, len(words), least).tolist())) == brute_runs(words, least)


def test_wavelet_tree():
    rng = np.random.default_rng(3)
    values = rng.permutation(300)
    tree = pr.WaveletTree(values)
    low = rng.integers(0, 250, 400)
    high = low + rng.integers(1, 50, 400)
    x = rng.integers(0, 300, 400)
    assert tree.below(low, high, x).tolist() == [int((values[a:b] < y).sum()) for a, b, y in zip(low, high, x)]
    k = rng.integers(0, high - low)
    assert tree.smallest(low, high, k).tolist() == [int(np.sort(values[a:b])[i]) for a, b, i in zip(low, high, k)]


def test_digest_of_odd_texts(spark):
    rng = random.Random(5)
    texts = [None, "", " \n\t", "a", "a " * 24, "a " * 23, "a b " * 12, "ab\x0bab\x0c" * 40, "\x1fé \x85é " * 30, " ".join(["x y z"] * 9 + ["x y"])]
    texts += [rng.choice([" ", "\n", " \t"]).join(spoilt(rng, rng.randrange(1, 300), rng.choice([1, 2, 4]))) for _ in range(300)]
    rows = [(i, t, "r", 1, 2) for i, t in enumerate(texts)] + [(7, texts[7], None, None, None), (None, "b " * 30, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = sorted((tuple(r) for r in pr.run_digest(df).collect()), key=str)
    assert found == sorted((brute_digest(i, t) for i, t, *_ in rows), key=str)


def test_whole_table(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").where(F.length("text") < 20_000)
    found = sorted(tuple(r) for r in pr.run_digest(docs).collect())
    assert found == sorted(brute_digest(r.doc_id, r.text) for r in docs.collect())
    assert sum(r[1] > 0 for r in found) > 10


def test_very_long_text(spark):
    rng = random.Random(8)
    words = [rng.choice("abcdefgh") + str(rng.randrange(999)) for _ in range(300_000)]
    for i in range(100_000, 250_000):
        words[i] = words[100_000 + (i - 100_000) % 40_000]
    for i in range(260_000, 260_100):
        words[i] = "same"
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    (row,) = pr.periodic_runs(docs).collect()
    assert [tuple(r) for r in row.runs] == [(100_000, 150_000, 40_000), (260_000, 100, 1)]
    assert row.collapsed == " ".join(words[:140_000] + words[250_000:260_001] + words[260_100:])


def test_empty_table(spark):
    assert pr.run_digest(spark.createDataFrame([], SCHEMA)).collect() == []

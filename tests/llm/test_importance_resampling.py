"""Importance resampling against a plain computation, and its draw."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa

from guestlens.llm import importance_resampling as ir

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, rank string, weight int, part int, fit string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def grams(text, longest):
    ws = words(text)
    return [" ".join(ws[i : i + n]) for n in range(1, longest + 1) for i in range(len(ws) - n + 1)]


def brute(rows, target, rule):
    def bucket(g):
        return zlib.crc32(g.encode()) % rule.buckets

    s = Counter(bucket(g) for _, t in rows for g in grams(t, rule.longest))
    t = Counter(bucket(g) for x in target for g in grams(x, rule.longest))
    s_all, t_all, b = sum(s.values()), sum(t.values()), rule.buckets
    gain = [math.floor(1000 * math.log((t[k] + 1) * (s_all + b) / ((s[k] + 1) * (t_all + b)))) for k in range(b)]
    out = []
    for i, text in rows:
        found = grams(text, rule.longest)
        weight = sum(gain[bucket(g)] for g in found)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{rule.seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, None])
    fit = sorted((r for r, (i, x) in zip(out, rows) if i is not None and len(words(x)) >= rule.least), key=lambda r: (-r[3], r[0]))
    for place, r in enumerate(fit[: rule.percent * len(fit) // 100], 1):
        r[4] = place
    return sorted(map(tuple, out), key=str)


def some_rows(n=400):
    rng = random.Random(4)
    texts = [None, "", " .,;\n", "A b-C_d É é ß_x", "\x7f{}~[a]", "İ ſ K", "no break here", "x" * 9000, "a " * 30_000]
    texts += [rng.choice([" ", ", ", "\n"]).join(rng.choice(["one", "Two", "drei", "vier5", "é", "66"]) for _ in range(rng.randrange(60))) for _ in range(n)]
    return list(enumerate(texts)) + [(11, texts[11]), (None, "one two " * 20)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "r", 1, 2, "f") for i, t in rows], SCHEMA).repartition(3)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_ranks_of_odd_texts(spark):
    rows, target = some_rows(), ["one two two", None, "", "É 66 one"]
    for rule in (ir.Draw(), ir.Draw(longest=3, buckets=97, least=5, percent=33, seed=7)):
        bench = spark.createDataFrame([(t,) for t in target], "text string")
        assert result(ir.ranked(frame(spark, rows), bench, rule)) == brute(rows, target, rule)


def test_target_without_rows_and_empty_table(spark):
    rows = some_rows(40)
    none = spark.createDataFrame([], "text string")
    assert result(ir.ranked(frame(spark, rows), none)) == brute(rows, [], ir.Draw())
    assert ir.ranked(frame(spark, rows).limit(0), none).collect() == []


def test_equal_rows_are_drawn_one_by_one(spark):
    rows = [(5, "w " * 20)] * 30 + [(6, "v " * 20)] * 10
    rule = ir.Draw(percent=80)
    found = result(ir.ranked(frame(spark, rows), frame(spark, rows[-1:]), rule))
    assert found == brute(rows, ["v " * 20], rule)
    assert sorted(r[4] for r in found if r[4]) == list(range(1, 33))


def test_rows_of_a_batch_in_runs():
    texts = pa.array(["aa", None, "b" * 50, "", "c"])
    runs = [(first, part.to_pylist()) for first, part in ir.row_runs(texts, 10)]
    assert runs == [(0, ["aa", ""]), (2, ["b" * 50]), (3, ["", "c"])]


def test_draw_moves_towards_the_target(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["red", "green", "blue"] if i % 5 else ["cat", "dog", "hen"]) for _ in range(40))) for i in range(500)]
    target = spark.createDataFrame([("cat dog hen " * 50,)], "text string")
    drawn = ir.resampled(frame(spark, rows), target)
    assert drawn.columns == ["doc_id", "text", "rank", "weight", "part", "fit"]
    ids = [r.doc_id for r in drawn.collect()]
    assert len(ids) == 50 and all(i % 5 == 0 for i in ids)

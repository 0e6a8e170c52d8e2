"""Line deduplication: an exact set-similarity self-join of lines.

A line is the set of its tokens: word shingles, or with size WORDS its words, repeated ones numbered. Tokens have one global order, rarest first:
occurrences are counted in a table of fixed size by the leading bits of the word's (or shingle's) hash, and a token is led by the
logarithm of that count, which makes common ones last. The text is cut and hashed once: the leading half of every hash is written, and
counts, prefixes and maps are taken from there; words with equal halves only make more candidates. The table is large enough to tell words of some hundred uses from rarer ones. Two lines of the
wanted Jaccard similarity share a token among the first few of both (prefix filter), have
similar sizes (length filter), and enough tokens after the shared ones (positional filter). A parity bit map of 64 bits, 128 for long lines,
goes with every prefix token: two sets differ in as many tokens at least as their maps in bits, so most pairs
that cannot be similar end before their sets are read. The others are verified on their whole sets, made again from the
texts, and a line that is similar to an earlier one is removed.

Lines with equal sets are one class, named by its first line. Classes that share a frequent prefix token are first compared with
the first class of them, which is broadcast; only those not removed by that are compared with all earlier classes that share a token.
The classes of a token with more than a block of them are dealt to blocks, and every pair of blocks is compared by itself.
Only SQL functions are used.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestlens.llm.frames import packed, written
from guestlens.llm.shingles import shingle_hashes
from guestlens.plans.skew import lookup_join

SHINGLE = 5
_OTHER_WHITE = "\t\x0b\x0c\r"
#: As a shingle size: tokens are single words, the k-th use of a word in a line is a token of its own.
WORDS = 0
#: Classes of a prefix token that one task compares with as many others.
BLOCK = 1024
#: Classes of a prefix token from which they are first compared with one of them.
STAR = 256
#: Words of a line up to which repeated ones are numbered by looking for the first; beyond it, by the starts of their runs. Both give the same numbers.
SHORT = 512
#: Rows of document ids or tokens up to which a counted table of them is broadcast.
BROADCAST_ROWS = 1_000_000
PERCENT = 80
#: Leading bits of a word's hash by which words are counted: a table of so many small numbers goes to every task.
RARITY_BITS = 18
_LEVEL_BIT = 32
#: Words of a line beyond which its parity map is kept in two parts.
WIDE = 80


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no and line of every line, blank ones too; white space in a line is blanks."""
    text = F.coalesce("text", F.lit(""))
    odd = reduce(Column.__or__, [F.contains(text, F.lit(c)) for c in _OTHER_WHITE])
    lines = F.split(F.when(odd, F.translate(text, _OTHER_WHITE, " " * len(_OTHER_WHITE))).otherwise(text), "\n")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), lines.alias("lines")).select("doc_id", F.posexplode_outer("lines").alias("line_no", "line"))


def _words(docs: DataFrame) -> DataFrame:
    """doc_id, line_no and words of every line. Cut at single blanks, which needs no pattern."""
    cut = F.split(F.lower("line"), " ")
    odd = (F.col("line") == "") | F.startswith("line", F.lit(" ")) | F.endswith("line", F.lit(" ")) | F.contains("line", F.lit("  "))
    return _lines(docs).select("doc_id", "line_no", F.when(odd, F.array_remove(cut, "")).otherwise(cut).alias("words"))


def _lead(h: Column) -> Column:
    return F.shiftrightunsigned(h, 32 - RARITY_BITS)


def _rarity(lines: DataFrame) -> Column:
    """Twice the binary logarithm of the occurrences of every value of the leading bits of ``heads``, as an array of fixed size."""
    every = lines.sparkSession.range(1 << RARITY_BITS).select(F.col("id").cast("int").alias("lead"), F.lit(0).alias("n"))
    leads = lines.select(F.explode("heads").alias("h")).select(_lead(F.col("h")).alias("lead"), F.lit(1).alias("n"))
    counted = leads.unionByName(every).groupBy("lead").agg(F.sum("n").alias("n"))
    level = F.floor(2 * F.log2(F.greatest("n", F.lit(1)))).cast("tinyint")
    levels = F.transform(F.sort_array(F.collect_list(F.struct("lead", level.alias("level")))), lambda x: x["level"].cast("string"))
    return F.split(F.lit(counted.agg(F.array_join(levels, ",").alias("levels")).first()["levels"]), ",").cast("array<tinyint>")


def _numbered(own: str) -> Column:
    """The words whose sorted hashes are in the column ``own``, told apart by use: the k-th use of a word, k > 0, has a hash of its own."""
    again = lambda h, k: F.xxhash64(h, k.cast("int"))
    short = F.transform(own, lambda h, i: F.when(F.get(own, i - 1) == h, again(h, i + 1 - F.array_position(own, h))).otherwise(h))
    places = F.sequence(F.lit(0), F.size(own) - 1)
    starts = F.filter(places, lambda i: (i == 0) | (F.get(own, i) != F.get(own, i - 1)))

    def run(start: Column, end: Column) -> Column:
        h = F.get(own, start)
        return F.transform(F.sequence(start, end - 1), lambda i: F.when(i == start, h).otherwise(again(h, i - start)))

    ends = F.concat(F.slice(starts, 2, F.size(own)), F.array(F.size(own)))
    runs = F.zip_with(starts, ends, lambda start, end: F.struct(start.alias("start"), end.alias("end")))
    long = F.flatten(F.transform(runs, lambda r: run(r["start"], r["end"])))
    return F.when(F.size(own) <= SHORT, short).otherwise(long)


def _hashes(words: DataFrame, size: int) -> DataFrame:
    """The sorted hashes of each line's words, with repeats, or of its distinct shingles: doc_id, line_no, hashes."""
    if size == WORDS:
        hashes = F.transform("words", lambda w: F.xxhash64(w))
    else:
        hashes = F.array_distinct(shingle_hashes(F.col("words"), size))
    return words.select("doc_id", "line_no", F.sort_array(hashes).alias("hashes"))


def _heads(hashes: str) -> Column:
    """The leading halves of sorted hashes, in order."""
    return F.transform(hashes, lambda h: F.shiftright(h, 32).cast("int"))


def _tokens(rarity: Column) -> Column:
    """``heads`` led by their levels, rarest first. Words of one head make more candidates at most: sets are told apart by whole hashes."""
    level = lambda h: F.coalesce(F.get(rarity, _lead(h)), F.lit(0).cast("tinyint")).cast("long")
    return F.sort_array(F.transform("heads", lambda h: F.shiftleft(level(h), _LEVEL_BIT) + h.cast("long")))


def _parity(one: Callable[[Column], Column]) -> Column:
    """64 parity bits of ``heads``, of those for which ``one`` is 1 and not 0."""
    return F.aggregate("heads", F.lit(0).cast("long"), lambda bits, h: bits.bitwiseXOR(F.call_function("shiftleft", one(h), h.bitwiseAND(F.lit(63)))))


def _maps() -> list[Column]:
    """s1: the parity bits of ``heads``; s2: of those with the sign bit, in lines of more than WIDE words."""
    signed = _parity(lambda h: F.shiftrightunsigned(h, 31).cast("long"))
    return [_parity(lambda h: F.lit(1).cast("long")).alias("s1"), F.when(F.size("heads") > WIDE, signed).otherwise(F.lit(0).cast("long")).alias("s2")]


def _prefix_rows(classes: DataFrame, *more: str) -> DataFrame:
    return classes.select(*more, "doc_id", "line_no", "n", "s1", "s2", F.posexplode("prefix").alias("pos", "token"))


def _near(percent: int, x: str = "x.", y: str = "y.") -> Column:
    """Whether the classes of two prefix rows of a token can be similar. A negative size stands for a class that is removed already, on the left."""
    xn, yn = F.col(f"{x}n"), F.abs(F.col(f"{y}n"))
    long = (xn * 100 >= yn * percent) & (yn * 100 >= xn * percent)
    room = F.least(xn - F.col(f"{x}pos"), yn - F.col(f"{y}pos")) * (100 + percent) >= (xn + yn) * percent
    one, two = (F.col(f"{x}{s}").bitwiseXOR(F.col(f"{y}{s}")) for s in ("s1", "s2"))
    fits = lambda apart: apart * (100 + percent) <= (xn + yn) * (100 - percent)
    return long & room & fits(F.bit_count(one)) & ((xn <= WIDE) | (yn <= WIDE) | fits(F.bit_count(two) + F.bit_count(one.bitwiseXOR(two))))


def _place(side: str) -> Column:
    return F.struct(F.col(f"{side}doc_id").alias("doc_id"), F.col(f"{side}line_no").alias("line_no"))


def _later(x: str = "x.", y: str = "y.") -> Column:
    """Whether the place of ``y`` is the earlier one. By columns: a struct would be made for every pair."""
    same = F.col(f"{y}doc_id") == F.col(f"{x}doc_id")
    return (F.col(f"{y}doc_id") < F.col(f"{x}doc_id")) | (same & (F.col(f"{y}line_no") < F.col(f"{x}line_no")))


def _pairs(joined: DataFrame, x: str = "x.", y: str = "y.") -> DataFrame:
    return joined.select(_place(x).alias("a"), _place(y).alias("b"))


def _small(df: DataFrame) -> DataFrame:
    """``df`` of narrow rows, broadcast if its counted rows allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """The classes of the later places a of ``pairs`` (a, b) whose whole sets are similar."""
    pairs = written(pairs.distinct())
    wanted = pairs.select("a.*").unionByName(pairs.select("b.*")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(_small(written(wanted.select("doc_id").distinct())), "doc_id", "left_semi")
    words = _words(texts).join(_small(written(wanted)), ["doc_id", "line_no"], "left_semi")
    made = _hashes(words, size).withColumn("class", F.xxhash64("hashes")).withColumn("tokens", _numbered("hashes") if size == WORDS else F.col("hashes")).drop("hashes")
    # rows of equal doc_id may have other lines at a class's place
    sets = written(made.join(classes.select("doc_id", "line_no", "class"), ["doc_id", "line_no", "class"], "left_semi").dropDuplicates(["class"]))
    left = sets.select(F.struct("doc_id", "line_no").alias("a"), F.col("tokens").alias("x"), "class")
    right = sets.select(F.struct("doc_id", "line_no").alias("b"), F.col("tokens").alias("y"))
    both = pairs.join(left, "a").join(right, "b").withColumn("both", F.size(F.array_intersect("x", "y")))
    return both.filter(F.col("both") * 100 >= (F.size("x") + F.size("y") - F.col("both")) * percent).select("class").distinct()


def later_lines(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Every line with ``removed``: doc_id, line_no, removed.

    A line is removed if an earlier one (smaller doc_id, or earlier in the same document) has a
    similar set; lines are judged on the input. Blank lines have no token and stay. Rows without
    doc_id have no place in the order and are left out.
    """
    docs = docs.filter("doc_id is not null")
    # words are cut and hashed once, for all steps but the last proof
    made = _hashes(_words(docs), size)
    lines = packed(made.select("doc_id", "line_no", F.xxhash64("hashes").alias("class"), F.hash("hashes").alias("proof"), F.size("hashes").alias("n"), _heads("hashes").alias("heads")))
    full = lines.filter("n > 0")
    ordered = full.select("*", *_maps(), _tokens(_rarity(full)).alias("tokens"))
    n = F.col("n")
    # a word's uses stand side by side in the order, so its first use alone tells whether two prefixes meet in it
    prefix = F.array_distinct(F.slice("tokens", 1, F.greatest(n - F.ceil(n * percent / 100).cast("int") + 1, F.lit(0))))
    # the hash of the whole list is proved by another one
    key = ["class", "proof"]
    first = F.min(F.struct("doc_id", "line_no", "n", "s1", "s2", prefix.alias("prefix"))).alias("first")
    classes = written(ordered.groupBy(*key).agg(first).select(*key, "first.*"))

    # a token has no more uses than its level tells, and the last one of a prefix is the commonest
    least = (math.floor(2 * math.log2(STAR)) - 1 << _LEVEL_BIT) - (1 << _LEVEL_BIT - 1)
    rows = _prefix_rows(classes.filter(F.get("prefix", F.size("prefix") - 1) >= least)).filter(F.col("token") >= least)
    frequent = written(rows.groupBy("token").agg(F.count("*").alias("uses"), F.min("doc_id").alias("doc_id")).filter(F.col("uses") > STAR))
    some = frequent.count()
    place = F.struct("doc_id", "line_no", "n", "pos", "s1", "s2")
    firsts = rows.join(_small(frequent), ["token", "doc_id"]).groupBy("token", "uses").agg(F.min(place).alias("y"))
    often = rows.select("token", place.alias("x"))
    star = often.join(F.broadcast(firsts), "token") if some <= BROADCAST_ROWS else lookup_join(often, firsts, ["token"], "uses", "inner")
    first = written(_verified(_pairs(star.filter(_near(percent) & _later())), docs, classes, size, percent))

    signs = _small(first).withColumn("gone", F.lit(-1))
    signed = lambda df: df.join(signs, "class", "left").withColumn("n", F.col("n") * F.coalesce("gone", F.lit(1)))
    rows = _prefix_rows(signed(classes))
    hot = frequent.filter(F.col("uses") > BLOCK).select("token", "uses")
    some = hot.count()
    # one shuffle serves both sides: rows of removed classes are told by their sign, in conditions on both
    cold = rows.join(_small(hot.select("token")), "token", "left_anti") if some else rows
    x, y = cold.alias("x"), cold.alias("y")
    later = _near(percent) & _later()
    more = _pairs(x.join(y, (F.col("x.token") == F.col("y.token")) & later))
    if some:
        blocks = F.ceil(F.col("uses") / BLOCK).cast("int")
        own, every = F.pmod(F.xxhash64("doc_id", "line_no"), blocks).cast("int"), F.explode(F.sequence(F.lit(0), blocks - 1))
        dealt = written(signed(_prefix_rows(classes, "class").join(_small(hot), "token")))
        x = dealt.filter("n > 0").select("*", own.alias("i"), every.alias("j")).alias("x")
        y = dealt.select("*", own.alias("j"), every.alias("i")).alias("y")
        same = (F.col("x.token") == F.col("y.token")) & (F.col("x.i") == F.col("y.i")) & (F.col("x.j") == F.col("y.j"))
        more = more.unionByName(_pairs(x.join(y, same & later)))
    gone = first.unionByName(_verified(more, docs, classes, size, percent)).distinct().withColumn("similar", F.lit(True))

    places = classes.select(*key, F.struct("doc_id", "line_no").alias("place")).join(gone, "class", "left")
    decided = full.join(places, key).select("doc_id", "line_no", (F.coalesce("similar", F.lit(False)) | (F.struct("doc_id", "line_no") > F.col("place"))).alias("removed"))
    return decided.unionByName(lines.filter("n = 0").select("doc_id", "line_no", F.lit(False).alias("removed")))


def line_report(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed, removed_lines (their numbers from 0, in order).

    A null or empty text is one blank line. Rows of equal doc_id are one document, whose lines of equal
    number have one place and never remove each other. An empty table gives no rows; other columns are not read.
    """
    lines = later_lines(docs, size, percent)
    numbers = F.array_sort(F.collect_list(F.when(F.col("removed"), F.col("line_no"))))
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if("removed").alias("n_removed"), numbers.alias("removed_lines"))


def without_later_lines(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with the removed lines cut from ``text``; documents left without any word go, if a line of theirs was removed.

    Columns are as they are, ``n_chars`` too: it tells the length of the source text.
    """
    gone = line_report(docs, size, percent).filter("n_removed > 0").select(F.col("doc_id").alias("__doc"), F.col("removed_lines").alias("__gone"))
    joined = docs.join(gone, docs["doc_id"].cast("long") == F.col("__doc"), "left").withColumn("__lines", F.split("text", "\n"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone"))
    left = F.array_join(F.transform(kept, lambda i: F.get("__lines", i)), "\n")
    cut = joined.withColumn("text", F.when(F.col("__doc").isNull(), F.col("text")).otherwise(left))
    blank = F.col("__doc").isNotNull() & (F.btrim("text", F.lit(" \t\n\x0b\x0c\r")) == "")
    return cut.filter(~blank).select(*docs.columns)

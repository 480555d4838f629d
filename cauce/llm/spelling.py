"""Grouping of spelling variants by permuterm rotations.

A word is marked with a terminator and rotated: the word ``xcy`` has the rotation ``y$xc``, whose prefix ``y$x`` skips the
character ``c``. A word ``xc'y`` has the same prefix, so replacements share it, and ``y$x`` itself is a rotation of the word
``xy``, so the insertion of a character is found under it, too. All rotations and their prefixes are sorted; the entries of one
prefix are one group. A group holds at most one word for each letter that may stand at the skipped place, and one
without any, whatever the number of words, so no group is ever hot. A scan of the sorted groups gives each entry the number
of the others and the best of them, and never lists pairs; entries are added up by word.

Two words that differ by one replacement meet in one group only. A deletion from a run of equal characters gives
the same word at each of its places; it counts at the run's first place. So near words are counted once.

All this is DataFrame functions. Only words beyond ``LONG`` code points, whose rotations would be as many texts of that length,
write a rotation as the hash of its characters and the place of its terminator, which sums over the word give in one pass; words
that meet there are compared exactly.

A word's form is its most frequent near word, if that is ``ratio`` times as frequent; forms rise in frequency by that factor, so
the way from a word to its root has no more steps than the largest count has digits, and doubling reaches it in the logarithm of that.

Defined results: null and empty texts have no words; very long texts give their words like any others; repeated rows of
documents count as often as they stand there; very long words take part; an empty table gives no words; ties between forms go to the smallest in code-point
order; a word without near words has n_near 0, no form, and is its own root. A null doc_id is read as an empty text by the
query's planting rule. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cauce.llm.common import stored, table

LETTERS = "A-Za-zÀ-ÿ"
END = "$"
ROWS = 500_000  # rotations in a shuffle partition
LONG = 256
BASE = 0x9E3779B97F4A7C15


def runs(docs: DataFrame, letters: str = LETTERS, shortest: int = 1) -> DataFrame:
    """(doc_id as text, run): the maximal runs of letters of at least ``shortest`` code points, A-Z lowered."""
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    found = F.regexp_extract_all(lowered, F.lit(f"[{letters}]{{{shortest},}}"), F.lit(0))
    return docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(found).alias("run"))


def planted(found: DataFrame, one_in: int = 31) -> DataFrame:
    """Runs that have lost a character by the planting rule: one in ``one_in``, by a checksum of document and run."""
    h = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return found.withColumn("h", h).select(F.when(F.col("h") % one_in == 0, short).otherwise(F.col("run")).alias("word"))


def counted(words: DataFrame, shortest: int = 7, least: int = 2) -> DataFrame:
    """(word, n) of words of at least ``shortest`` code points that occur at least ``least`` times."""
    return words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _part(start: Column, length: Column) -> Column:
    return F.substring("word", start, length)


def rotations(words: DataFrame) -> DataFrame:
    """(key, own: -n and word, skips, first): whole rotations, and rotations less their last character."""
    i = F.col("i")
    whole = F.concat(_part(i + 1, F.length("word")), F.lit(END), _part(F.lit(1), i))
    less = F.concat(_part(1 - i, F.length("word")), F.lit(END), _part(F.lit(1), -i - 1))
    places = words.select("word", "n", F.explode(F.sequence(-F.length("word"), F.length("word"))).alias("i"))
    return places.select(
        F.when(i >= 0, whole).otherwise(less).alias("key"), F.struct((-F.col("n")).alias("m"), "word").alias("own"),
        (i < 0).cast("int").alias("skips"),
        F.when(i >= -1, F.lit(1)).otherwise((_part(-i, F.lit(1)) != _part(-i - 1, F.lit(1))).cast("int")).alias("first"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, at, id): the rotations of ``rotations``, as the hash of their characters and the terminator's place."""
    turn, back = np.uint64(BASE), np.uint64(pow(BASE, -1, 1 << 64))
    for batch in batches:
        for own, word in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist()):
            codes = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
            n = len(codes)
            with np.errstate(over="ignore"):
                powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n - 1, turn))), dtype=np.uint64)
                upto = np.concatenate(([np.uint64(0)], np.cumsum(codes * powers, dtype=np.uint64)))
                less = upto[:-1] + (upto[-1] - upto[1:]) * back
            h = np.concatenate((np.full(n + 1, upto[-1]), less)).view(np.int64)
            at = np.concatenate((np.arange(n + 1), np.arange(n)))
            for k in range(0, len(h), 100_000):
                part = slice(k, k + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(h[part]), pa.array(at[part]), pa.array(np.full(len(h[part]), own))], ["h", "at", "id"])


def _near_long(words: DataFrame) -> DataFrame:
    """(word, near, best) of pairs with a word beyond LONG, one row a near word."""
    some = words.where(F.length("word") >= LONG).withColumn("id", F.xxhash64("word"))
    met = some.select("id", "word").mapInArrow(_hashed, "h long, at long, id long").groupBy("h", "at").agg(
        F.array_sort(F.collect_set("id")).alias("ids")).where(F.size("ids") > 1)  # one for each letter at most
    pairs = met.select("at", "ids", F.explode("ids").alias("a")).select("at", "a", F.explode("ids").alias("b")).where("a != b").groupBy(
        "a", "b").agg(F.min("at").cast("int").alias("at"))
    one, other = (some.select(F.col("id").alias(k), F.col("word").alias(f"w{k}"), F.col("n").alias(f"n{k}"),
                              F.length("word").alias(f"l{k}")) for k in "ab")
    rest = lambda k: F.substring(f"w{k}", F.col("at") + 1 + (F.col(f"l{k}") >= F.greatest("la", "lb")).cast("int"), F.col(f"l{k}"))
    same = (F.substring("wa", F.lit(1), F.col("at")) == F.substring("wb", F.lit(1), F.col("at"))) & (rest("a") == rest("b"))
    return pairs.join(one, "a").join(other, "b").where(
        (F.greatest("la", "lb") > LONG) & (F.abs(F.col("la") - F.col("lb")) <= 1) & same).select(
        F.col("wa").alias("word"), F.lit(1).cast("long").alias("near"), F.struct((-F.col("nb")).alias("m"), F.col("wb").alias("word")).alias("best"))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best: -n and word of its most frequent near word) of the words (word, n) that have near words."""
    longest = words.agg(F.max(F.length("word"))).first()[0] or 0
    rows = _near_short(words.where(F.length("word") <= LONG))
    if longest > LONG:
        rows = rows.unionByName(_near_long(words))
    return rows.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def _near_short(words: DataFrame) -> DataFrame:
    """(word, near, best), one row for each group of rotations in which the word has company."""
    length = words.agg(F.sum(2 * F.length("word") + 1)).first()[0] or 0
    least = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = Window.partitionBy("key")
    order = group.orderBy("own")
    scanned = rotations(words).repartition(max(least, -(-length // ROWS)), "key").select(
        "own", "skips", "first", F.first("own").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("top"),
        F.lead("own").over(order).alias("next"), F.sum("skips").over(group).alias("all"),
        F.count("*").over(group).alias("entries"), F.sum(F.col("skips") * F.col("first")).over(group).alias("firsts")).where("entries > 1")
    whole = F.col("entries") - F.col("all")  # 1 if a word is a whole rotation of this group
    near = F.when(F.col("skips") == 1, F.col("all") - 1 + whole * F.col("first")).otherwise(F.col("firsts"))
    return scanned.select(F.col("own.word").alias("word"), near.alias("near"),
                          F.when(F.col("top") == F.col("own"), F.col("next")).otherwise(F.col("top")).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form) without cycles: each round doubles the steps that a link spans."""
    links = stored(forms.select("word", F.col("form").alias("to")), "spelling-links")
    while True:
        further = links.select(F.col("word").alias("to"), F.col("to").alias("next"))
        links = stored(links.join(further, "to", "left").select(
            "word", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "spelling-links")
        if links.where("moved").isEmpty():
            return links.select("word", F.col("to").alias("root"))
        links = links.drop("moved")


def spelling_groups(words: DataFrame, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near and form_n of distinct words (word, n)."""
    words = stored(words.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    near = words.join(near_words(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), (-F.col("best.m")).alias("m"), F.col("best.word").alias("form"))
    held = F.col("m") >= ratio * F.col("n")
    formed = stored(near.select("word", "n", "n_near", F.when(held, F.col("form")).alias("form"), F.when(held, F.col("m")).alias("form_n")),
                    "spelling-forms")
    return formed.join(roots(formed.where("form IS NOT NULL")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return spelling_groups(counted(planted(runs(docs, shortest=7))))


_CRC = "xor(list_reduce(list_prepend(4294967295, [('0x' || substr(hex({0}), 2 * i + 1, 2))::BIGINT FOR i IN range(strlen({0}))]), " \
       "lambda c, b: xor(c >> 8, steps[xor(c, b) % 256 + 1])), 4294967295)"
OP12_SQL = f"""
WITH RECURSIVE crc AS (SELECT list(v ORDER BY i) AS steps FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v FROM range(256) r(i))),
u AS (SELECT coalesce(doc_id::VARCHAR, '') AS d, unnest(regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
    '[{LETTERS}]+')) AS run FROM documents),
v AS (SELECT d || ':' || run AS mark, run, count(*) AS k FROM u WHERE length(run) >= 7 GROUP BY ALL),
c AS (SELECT run, k, {_CRC.format('mark')} AS h FROM v, crc),
w AS (SELECT word, sum(k)::BIGINT AS n FROM (SELECT k, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
    ELSE run END AS word FROM c) WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
g AS (SELECT word, unnest([substr(word, 1, i) || '{END}' || substr(word, i + 2) FOR i IN range(length(word))]) AS gap FROM w),
p AS (SELECT a.word, b.word AS other FROM g a JOIN g b USING (gap) WHERE a.word <> b.word
      UNION SELECT g.word, w.word FROM g JOIN w ON replace(g.gap, '{END}', '') = w.word
      UNION SELECT w.word, g.word FROM g JOIN w ON replace(g.gap, '{END}', '') = w.word),
b AS (SELECT p.word, count(*) AS n_near, first(other ORDER BY o.n DESC, other) AS best, max(o.n) AS best_n FROM p JOIN w o ON o.word = other GROUP BY p.word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * w.n THEN best END AS form,
      CASE WHEN best_n >= 10 * w.n THEN best_n END AS form_n FROM w LEFT JOIN b ON b.word = w.word),
t(word, root) AS (SELECT word, word FROM f UNION ALL SELECT t.word, f.form FROM t JOIN f ON f.word = t.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, t.root, f.n, f.n_near, f.form_n FROM f JOIN t ON t.word = f.word JOIN f e ON e.word = t.root AND e.form IS NULL
"""

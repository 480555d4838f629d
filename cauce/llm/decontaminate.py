"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

Every item gives windows of ``width`` consecutive words (one shorter window if it has fewer). A window's tokens are its
word shingles. Of all positions of all documents, those whose shingle occurs in some window stay, and they give each
shingle's frequency in the corpus. Windows order their shingles by rarity; exact containment needs all of them, so the
prefix to join on is the rarest one. Where it stands in document and window fixes the window's place (positional
bound), which must lie inside the document (length bound). Surviving places are compared word by word.

The windows' shingles and prefixes are as many as the benchmark's words. No join has a hint: Spark broadcasts them
below its threshold, by estimate or by measured size, and sorts and merges beyond it.

Defined results: null and empty texts have no words and no hits; items without words, or without an id, are no items;
items of equal id count once; repeated documents get equal rows; very long texts are searched whole; without documents there are no
rows, without items no hits; columns besides doc_id, item_id and text are not read
by the join and are kept by ``clean``.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.llm.common import stored, table

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHINGLE = 4


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def _loose(text: Column) -> Column:
    """Words with all letters lowered: never separates what the exact rule joins, and much cheaper."""
    return _words(F.lower(text))


def _exact(text: Column) -> Column:
    return _words(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def _places(words: Column, length: Column | int) -> Column:
    """Positions from 0 at which ``length`` words begin."""
    n = F.size(words)
    return F.when(n >= length, F.sequence(F.lit(0), n - length)).otherwise(F.array().cast("array<int>"))


def _grams(words: Column, length: int) -> Column:
    """Hashes of the shingles of ``length`` words at all positions."""
    return F.transform(_places(words, length), lambda at: F.xxhash64(*(F.get(words, at + k) for k in range(length))))


def _key(df: DataFrame) -> list[Column]:
    return [F.coalesce(df["doc_id"].cast("long"), F.lit(-(1 << 63))).alias("k1"), F.xxhash64(df["text"]).alias("k2")]


def _windows(benchmark: DataFrame, width: int) -> DataFrame:
    """(window: exact words as text, length, items: ids as text, loose: words)."""
    items = benchmark.where("item_id is not null").select(
        F.col("item_id").cast("string").alias("item"), _exact(F.col("text")).alias("w"), _loose(F.col("text")).alias("l"))
    items = items.where(F.size("w") > 0).withColumn("length", F.least(F.size("w"), F.lit(width)))
    return items.select("item", "w", "l", "length", F.explode(_places(F.col("w"), F.col("length"))).alias("s")).select(
        "item", "length", F.concat_ws(" ", F.slice("w", F.col("s") + 1, F.col("length"))).alias("window"),
        F.slice("l", F.col("s") + 1, F.col("length")).alias("loose")).groupBy("window", "length", "loose").agg(
        F.collect_set("item").alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 13) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (sorted ids as text), spans (from word, length)."""
    windows = stored(_windows(benchmark, width), "windows")
    lengths = [r[0] for r in windows.select(F.least("length", F.lit(SHINGLE)).alias("n")).distinct().collect()]  # at most SHINGLE rows
    narrow = docs.select(*_key(docs), _loose(F.col("text")).alias("w"))
    grams, places = [], []
    for n in lengths:
        grams.append(windows.where(F.least("length", F.lit(SHINGLE)) == n).select(
            "window", "length", "items", F.lit(n).alias("n"),
            F.posexplode(_grams(F.col("loose"), n)).alias("off", "gram")))
        places.append(narrow.select("k1", "k2", F.size("w").alias("n_words"), F.lit(n).alias("n"), 
            F.posexplode(_grams(F.col("w"), n)).alias("at", "gram")))
    blank = F.array().cast("array<struct<start:int,length:int,window:string,items:array<string>>>")
    if lengths:
        shingles, there = grams[0], places[0]
        for g, p in zip(grams[1:], places[1:]):
            shingles, there = shingles.unionByName(g), there.unionByName(p)
        met = stored(there.join(shingles.select("n", "gram").distinct(), ["n", "gram"]), "shingles")
        rarity = met.groupBy("n", "gram").agg(F.count("*").alias("freq"))
        prefixes = shingles.join(rarity, ["n", "gram"], "left").groupBy("window", "length", "items", "n").agg(
            F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "gram", "off")).alias("p")).where("p.freq > 0").select(
            "window", "length", "items", "n", "p.gram", "p.off")
        placed = met.join(prefixes, ["n", "gram"]).withColumn("start", F.col("at") - F.col("off")).where(
            "start >= 0 and start + length <= n_words")
        found = placed.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "length", "window", "items")).alias("cands"))
    else:
        found = narrow.select("k1", "k2", blank.alias("cands")).limit(0)
    checked = docs.select("doc_id", "text", *_key(docs)).join(found, ["k1", "k2"], "left").select(
        "doc_id", "cands", F.when(F.col("cands").isNull(), _loose(F.col("text"))).otherwise(_exact(F.col("text"))).alias("w"))
    true = F.filter("cands", lambda c: F.concat_ws(" ", F.slice("w", c["start"] + 1, c["length"])) == c["window"])
    hits = checked.select("doc_id", F.size("w").alias("n_words"), F.coalesce(true, blank).alias("c"))
    return hits.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"),
        F.size(F.array_distinct(F.flatten(F.transform("c", lambda c: F.sequence(c["start"], c["start"] + c["length"] - 1)))))
        .cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.transform("c", lambda c: c["items"])))).alias("items"),
        F.array_sort(F.array_distinct(F.transform("c", lambda c: F.struct(c["start"].alias("start"), c["length"].alias("length"))))).alias("spans"))


def _contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def clean(docs: DataFrame, benchmark: DataFrame, width: int = 13) -> DataFrame:
    """The documents that are not contaminated: fewer than a twentieth of their words lie in windows of items.

    Documents without an id cannot be named by the join and are judged by their text alone.
    """
    bad = contamination(docs.select(F.xxhash64("text").alias("doc_id"), "text"), benchmark, width).where(_contaminated())
    return docs.join(bad.select(F.col("doc_id").alias("_bad")).distinct(), F.xxhash64(docs["text"]) == F.col("_bad"), "left_anti")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                       _contaminated().alias("contaminated"))


OP8_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (
  SELECT item_id::VARCHAR AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
i AS (
  SELECT DISTINCT item, n, array_to_string(w[s:s + n - 1], ' ') AS win FROM (
    SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM (SELECT item, w, least(len(w), 13) AS n FROM b WHERE len(w) > 0))),
p AS (
  SELECT r, s, n, array_to_string(w[s:s + n - 1], ' ') AS win FROM (
    SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM i) WHERE len(w) >= n)),
m AS (SELECT p.r, p.s, p.n, i.item FROM p JOIN i ON p.n = i.n AND p.win = i.win),
h AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS q FROM m) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""

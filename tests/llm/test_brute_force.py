"""Operators without SQL against plain Python: language backoff, boosting and calibration, shards, line templates; and very long words."""

from __future__ import annotations

import math
import struct
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cauce.llm import language, line_templates, shards, toxicity
from cauce.llm.common import table

TABLES = "/root/testdata/sf0.001"


# ---- language

def letters_only(text):
    words, word = [], ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            words.append(word)
            word = ""
    return words


class BruteLanguage:
    """The backoff by nested dictionaries."""

    def __init__(self, rows, least=2):
        self.counts = defaultdict(lambda: defaultdict(Counter))  # group -> unit -> languages
        for lang, text in rows:
            for word in letters_only(text):
                self.counts["word"][word][lang] += 1
                padded = f" {word} "
                for n in range(1, 5):
                    for i in range(len(padded) - n + 1):
                        self.counts[n][padded[i:i + n]][lang] += 1
        for units in self.counts.values():
            for u in [u for u, c in units.items() if c.total() < least]:
                del units[u]
        self.langs = sorted({x for units in self.counts.values() for c in units.values() for x in c})
        self.totals = {(g, x): sum(c[x] + 0.5 for c in units.values()) for g, units in self.counts.items() for x in self.langs}

    def log(self, group, unit, lang):
        return math.log((self.counts[group][unit][lang] + 0.5) / self.totals[group, lang])

    def __call__(self, text):
        words = letters_only(text or "")
        if not words or not self.langs:
            return "und", 0.0, 0.0
        sums, known = dict.fromkeys(self.langs, 0.0), 0.0
        for word in words:
            if word in self.counts["word"]:
                known += 1
                for x in self.langs:
                    sums[x] += self.log("word", word, x)
                continue
            padded, found = f" {word} ", []
            for i in range(len(padded)):
                for n in (4, 3, 2, 1):
                    gram = padded[i:i + n]
                    if gram != " " and gram in self.counts[len(gram)]:
                        found.append(gram)
                        break
            known += sum(len(g) >= 3 for g in found) / len(word)
            for x in self.langs:
                sums[x] += sum(self.log(len(g), g, x) for g in found) / max(len(found), 1)
        best = max(self.langs, key=lambda x: (sums[x], [-ord(c) for c in x]))
        odds = [math.exp(v - sums[best]) for v in sums.values()]
        return best, 1 / sum(odds), known / len(words)


ODD = ["½ ² ① 12 ½", "...", "naïve²plus ÉTÉ", "Привет мир", "x" * 3, "日本語 テキスト", "áb İstanbul ΣΑΣ", "42"]


def test_language_equals_brute_force(spark):
    docs = table(spark, TABLES, "documents").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(10_000 + k, t, None) for k, t in enumerate(ODD)], "doc_id long, text string, lang string")
    rows = docs.collect()
    held = lambda d: d is None or zlib.crc32(str(d).encode()) % 5 == 0
    brute = BruteLanguage([(r.lang, r.text) for r in rows if not held(r.doc_id) and r.lang is not None and r.text is not None])
    for r in language.identified(docs.unionByName(odd), ["doc_id", "text"]).collect():
        lang, score, known = brute(r.text)
        assert r.lang_pred == lang and r.held_out == held(r.doc_id)
        assert r.score == pytest.approx(score, abs=1e-9) and r.known == pytest.approx(known, abs=1e-12)


def test_letters_decide_on_und_and_unlearned_languages_go(spark):
    learned = [(k, "the quick brown fox jumps over the lazy dog again and again", "en") for k in range(1, 40)]
    some = learned + [(100, ODD[0], None), (101, ODD[3], None), (102, "the quick brown fox", None), (103, "quickest foxes jumping overly", None),
                      (104, None, None), (105, "", None), (None, "the lazy dog", None)]
    docs = spark.createDataFrame(some, "doc_id long, text string, lang string").withColumn("score", F.lit("own")).withColumn("known", F.lit(1))
    got = {r.doc_id: r for r in language.identified(docs, ["doc_id", "text", "score"]).collect()}
    assert got[100].lang_pred == "und" and got[100].score == 0 and got[101].lang_pred == "en" and got[101].known == 0
    kept = language.in_known_language(docs)
    assert kept.columns == docs.columns and {r.score for r in kept.collect()} == {"own"}
    assert {r.doc_id for r in kept.collect()} == {d for d, *_ in learned} | {102, 103, None}  # one language: the score is 1, the share decides
    assert language.in_known_language(docs.where("lang IS NULL")).count() == 0


def test_one_id_repeated_does_not_fill_the_sample(spark):
    docs = spark.range(20_000).selectExpr("7L AS doc_id", "'same words here' AS text", "'en' AS lang")
    sample = language.training_sample(docs, "lang", 10_000)
    assert sample.count() <= 1
    other = spark.range(20_000).selectExpr("7L AS doc_id", "concat('words ', id) AS text", "'en' AS lang")
    assert language.training_sample(other, "lang", 1000).count() < 1300


# ---- toxicity

def brute_trees(x, y, depth, rounds, rate, bins, least):
    """Boosting by trying every cut of every feature at every node."""
    edges = [sorted({float(v) for v in np.quantile(c, np.linspace(0, 1, bins)[1:-1])}) for c in x.T]
    score = np.full(len(y), math.log(y.mean() / (1 - y.mean())))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        nodes = [np.arange(len(y))]
        for _ in range(depth):
            below = []
            for rows in nodes:
                best, cut = 1e-9, None
                for f in range(x.shape[1]):
                    for e in edges[f]:
                        left, right = rows[x[rows, f] <= e], rows[x[rows, f] > e]
                        if h[left].sum() < least or h[right].sum() < least:
                            continue
                        gain = g[left].sum() ** 2 / (h[left].sum() + 1) + g[right].sum() ** 2 / (h[right].sum() + 1) - g[rows].sum() ** 2 / (h[rows].sum() + 1)
                        if gain > best + 1e-12:
                            best, cut = gain, (f, e)
                below += [rows[x[rows, cut[0]] <= cut[1]], rows[x[rows, cut[0]] > cut[1]]] if cut else [rows, rows[:0]]
            nodes = below
        for rows in nodes:
            if len(rows):
                score[rows] += rate * g[rows].sum() / (h[rows].sum() + 1)
    return score


def test_boosting_equals_brute_force():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(120, 3)).round(1)
    y = (x[:, 0] + x[:, 1] ** 2 + rng.normal(size=120) > 1).astype(float)
    model = toxicity.Boosted(depth=2, rounds=5, bins=9).fit(x, y)
    assert np.allclose(model.raw(x), brute_trees(x, y, 2, 5, 0.1, 9, 1.0))


def brute_isotonic(score, y):
    """Best rising frequencies: for each point the highest over starts of the lowest over ends of the mean."""
    points = sorted(set(score))
    mean = lambda a, b: np.mean([v for s, v in zip(score, y) if points[a] <= s <= points[b]])
    return {p: max(min(mean(a, b) for b in range(k, len(points))) for a in range(k + 1)) for k, p in enumerate(points)}


@pytest.mark.parametrize("seed", range(6))
def test_calibration_pools_ties(seed):
    rng = np.random.default_rng(seed)
    score, y = rng.integers(0, 6, 60) / 5, rng.integers(0, 2, 60).astype(float)
    want = brute_isotonic(score.tolist(), y.tolist())
    for order in (np.arange(60), rng.permutation(60), np.argsort(y), np.argsort(-y)):
        at, freq = toxicity.isotonic(score[order], y[order])
        assert (np.diff(freq) > 0).all() and sorted(set(want.values())) == pytest.approx(freq.tolist())
    assert toxicity.isotonic(np.zeros(100), np.arange(100) == 5)[1].tolist() == [0.01]
    for y in ([0, 0, 1, 1], [1, 1, 0, 0], [0, 1, 0, 1]):
        assert toxicity.isotonic(np.full(4, 0.3), np.array(y, float))[1].tolist() == [0.5]


def test_long_words_take_linear_time(spark):
    lexicon, began = toxicity.Lexicon({"bad": 5.0, "badw*": 6.0}), time.time()
    for text in ("x" * 1_000_000, "x1" * 500_000, "bad" + "1" * 1_000_000, "_" * 500_000 + "a1" * 300_000, "½" * 300_000):
        assert len(toxicity.features(text, lexicon)) == 20
    assert toxicity.MIXED.findall("b4d w0rd a_1b plain 12a a1 x@y!z ab1c1") == ["b4d", "w0rd", "x@y!z", "ab1c"]
    scorer = language.Scorer(["en"], language.packed(*empty()), language.packed(*empty(len)))
    assert scorer("y" * 1_000_000)[2] == 0
    assert time.time() - began < 30
    docs = spark.createDataFrame([(1, "z" * 1_000_000 + "\n" + "w" * 500_000 + "7 b c d"), (2, " ".join("y" * 300_000 for _ in range(4)))],
                                 "doc_id long, text string")
    assert line_templates.without_recurring_lines(docs).where("n_dropped = 0").count() == 2
    assert time.time() - began < 60


def empty(group=lambda u: 0):
    import pandas as pd
    return pd.DataFrame({"unit": [], "lang": [], "n": []}, dtype=object), ["en"], group


def test_features_read_letters_only():
    lexicon = toxicity.Lexicon({"bad": 5.0})
    assert toxicity.letters("ab½cd ² été 3x_y") == ["ab", "cd", "été", "x", "y"]
    assert toxicity.features("bad bad good", lexicon)[0] == 2 and toxicity.features(None, lexicon) == toxicity.features("", lexicon)


# ---- shards

def signed(v):
    return v - (1 << 64) if v >= 1 << 63 else v


def draw(doc_id, shard, seed=7):
    h = xxhash.xxh64_intdigest(struct.pack("<i", seed), 42)
    if doc_id is not None:
        h = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), h)
    return signed(xxhash.xxh64_intdigest(struct.pack("<i", shard), h))


def test_shards_equal_brute_force(spark):
    rows = [(k, f"text {k} é") for k in range(300)] + [(None, f"no id {k}") for k in range(50)] + [(5, "same")] * 40 + [(6, None), (7, ""), (8, "x" * 100_000)]
    docs = spark.createDataFrame([(*r, "own", 1, 2) for r in rows], "doc_id long, text string, shard string, slot int, other int")
    got = shards.shuffled_shards(docs, shards=5, bucket_bytes=300).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows) and all(r.other == 2 for r in got)
    for r in got:
        draws = [draw(r.doc_id, s) for s in range(6)]
        assert r.shard == int(np.argmax(draws[:5])) and r.grown_shard == (5 if draws[5] > max(draws[:5]) else r.shard)
        assert r["size"] == len((r.text or "").encode()) + 16
    for s in range(5):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    same = [r.slot for r in got if r.text == "same"]
    assert np.std(same) > 0.1 * sum(r.shard == draw_shard(5) for r in got)  # equal rows lie all over their shard
    assert shards.shuffled_shards(docs.limit(0)).count() == 0


def draw_shard(doc_id):
    return int(np.argmax([draw(doc_id, s) for s in range(5)]))


def test_sharding_query(spark):
    docs = {r.doc_id: r.text for r in table(spark, TABLES, "documents").collect()}
    got = shards.op9_sharding(spark, TABLES).collect()
    assert {r.doc_id for r in got} == set(docs) and len(got) == len(docs) and {r.law for r in got} == {"key"}
    for r in got:
        raw = (docs[r.doc_id] or "").encode()
        draws = [draw(r.doc_id, s) for s in range(41)]
        assert (r["size"], r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
        assert r.shard == int(np.argmax(draws[:40])) and r.grown_shard == int(np.argmax(draws))
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_written_shards_are_in_slot_order_and_tasks_are_few(spark, tmp_path):
    docs = spark.range(5000).selectExpr("id AS doc_id", "repeat('x', cast(id % 50 as int)) AS text")
    shards.write_shards(docs, str(tmp_path / "s"), shards=3, bucket_bytes=1000)
    buckets = spark.read.parquet(str(tmp_path / "s")).select("shard", "_bucket").distinct().count()
    files = list((tmp_path / "s").rglob("*.parquet"))
    assert buckets > 100 and len(files) <= 8 + 3
    for file in files:
        rows = spark.read.parquet(str(file)).select("_bucket", "_at").collect()
        assert rows == sorted(rows)


# ---- line templates

def test_templates_do_not_depend_on_the_size_of_the_leaf(spark):
    def dropped(count, values):
        rows = [(k, f"Posted in the forum f{'abcdefghij'[k % values % 10]}{'q' * (k % values // 10)} by user u{'klmnopqrst'[k // 7 % values % 10]}") for k in range(count)]
        return {r.n_dropped for r in line_templates.without_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert dropped(60, 40) == {1} and dropped(3000, 40) == {1}


def test_long_equal_lines_recur_from_two_documents_on(spark):
    passage = " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60))
    rows = [(1, f"own line one\n{passage}"), (2, f"{passage}\nother words here now"), (3, "short line of five words"), (4, "short line of five words"),
            (5, f"call 1 {passage}"), (6, f"call 22 {passage}"), (7, passage + " x"), (7, passage + " x"), (8, "1 2 3 4 5 6 7 8 9"), (9, "9 8 7 6 5 4 3 2 1")]
    got = defaultdict(list)
    for r in line_templates.without_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r.doc_id].append((r.n_dropped, r.text))
    assert got[1] == [(1, "own line one")] and got[2] == [(1, "other words here now")] and got[5] == got[6] == [(1, "")]
    assert got[3] == got[4] == [(0, "short line of five words")] and [d for d, _ in got[7]] == [0, 0] and got[8][0][0] == got[9][0][0] == 0

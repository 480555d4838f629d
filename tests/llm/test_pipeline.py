"""The pipeline's stages on the driver's small tables: each keeps what its rule keeps."""

from __future__ import annotations

import hashlib
import re
import string
import zlib

from pyspark.sql import functions as F

import corpus_pipeline
from cauce.llm import mixing
from cauce.llm.common import stored, table
from tests.llm.test_brute_force import BruteLanguage, draw
from tests.llm.test_operators import TABLES, shingles


def test_stages(spark):
    docs = table(spark, TABLES, "documents")
    names, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, TABLES), "pipeline-test")
        assert docs.columns[:len(names)] == names
        kept.append({r.doc_id: r.text for r in docs.select("doc_id", "text").collect()})
    for before, after in zip(kept, kept[1:]):
        assert after.items() <= before.items()
    sets = {d: shingles(t, 5) for d, t in kept[1].items()}
    ids = sorted(sets)
    assert not any(5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) > 0 for i, a in enumerate(ids) for b in ids[i + 1:])
    assert sorted(r.slot for r in docs.where("shard = 0").collect()) == list(range(docs.where("shard = 0").count()))


def test_near_duplicates_keep_null_and_repeated_ids(spark):
    words = [[f"{c}{i}" for i in range(60)] for c in "abcdefg"]
    a, b, c, d, e, f, g = (" ".join(w) for w in words)
    rows = [(1, a), (1, b), (1, b),                            # two texts under one id, one row repeated
            (2, a + " more"), (2, c),                          # a near copy of a smaller id, and a clean text
            (None, d), (None, d), (None, e),                   # texts without an id
            (None, f), (3, f + " more"),                       # an id goes before none
            (None, g), (None, g + " more"),                    # a class without ids
            (4, None), (None, None), (None, " "), (None, "")]  # nothing to link
    docs = spark.createDataFrame([(*r, "en", "s") for r in rows], "doc_id long, text string, lang string, source string")
    out = corpus_pipeline.near_duplicates(spark, docs, TABLES)
    assert out.columns == docs.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert sum(x in got for x in [(None, g), (None, g + " more")]) == 1
    got = [x for x in got if not (x[1] or "").startswith(g)]
    assert len(got) == 10 and set(got) == {(1, a), (1, b), (2, c), (None, d), (None, e), (3, f + " more"),
                                           (4, None), (None, None), (None, " "), (None, "")}


WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def hit_words(text, items):
    """(words, words inside windows of items)."""
    words = WORDS.findall((text or "").translate(LOWER))
    windows = {tuple(w[i:i + min(13, len(w))]) for w in (WORDS.findall((t or "").translate(LOWER)) for t in items) if w
               for i in range(len(w) - min(13, len(w)) + 1)}
    hit = {k for n in {len(w) for w in windows} for i in range(len(words) - n + 1) if tuple(words[i:i + n]) in windows for k in range(i, i + n)}
    return len(words), len(hit)


def test_stages_equal_brute_force(spark):
    """Each stage on all that the one before has kept, against its rule in plain Python."""
    docs = table(spark, TABLES, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    brute = BruteLanguage([(r.lang, r.text) for r in rows.values()
                           if zlib.crc32(str(r.doc_id).encode()) % 5 and r.lang is not None and r.text is not None])

    def after(stage, before):
        out = stored(stage(spark, before, TABLES), "pipeline-brute")
        return out, {r.doc_id for r in out.select("doc_id").collect()}

    one, kept = after(corpus_pipeline.known_language, docs)
    judged = {d: brute(r.text) for d, r in rows.items()}
    assert kept == {d for d, (lang, score, known) in judged.items() if lang != "und" and score >= 0.5 and known >= 0.3}

    two, left = after(corpus_pipeline.near_duplicates, one)
    sets, root = {d: shingles(rows[d].text, 5) for d in kept}, {d: d for d in kept}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(kept)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    assert left == {d for d in kept if root[d] == d}

    three, clean = after(corpus_pipeline.decontaminated, two)
    items = [r.text for r in table(spark, TABLES, "benchmark").collect()]
    hits = {d: hit_words(rows[d].text, items) for d in left}
    assert clean == {d for d, (n, hit) in hits.items() if not (hit and 20 * hit >= n)} and clean != left

    four, drawn = after(corpus_pipeline.to_target_weights, three)
    levels = mixing.corpus_levels()
    names = [x.name for x in levels]
    base = three.select("doc_id", mixing.space_tokens(three.text).alias("n"), *(F.coalesce(x.value, F.lit("(none)")).alias(x.name) for x in levels))
    total = int(base.agg(F.sum("n")).first()[0] * corpus_pipeline.SHARE)
    leaves = base.where("n > 0").groupBy(*names).agg(F.sum("n").alias("tokens"))
    budgets = {tuple(r[n] for n in names): r.budget for r in mixing.leaf_budgets(leaves, levels, total, 1).collect()}
    assert sum(budgets.values()) == total
    expected = set()
    for leaf, budget in budgets.items():
        own = [r for r in base.where("n > 0").collect() if tuple(r[n] for n in names) == leaf]
        for r in sorted(own, key=lambda r: hashlib.md5(f"7:{budget // sum(x.n for x in own)}:{r.doc_id}".encode()).hexdigest()):
            if budget > 0:
                expected.add(r.doc_id)
            budget -= r.n
    assert drawn == expected

    five = corpus_pipeline.sharded(spark, four, TABLES).collect()
    assert {r.doc_id for r in five} == drawn and all(r.shard == max(range(40), key=lambda s: draw(r.doc_id, s)) for r in five)


def test_odd_and_empty_tables_through_all_stages(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, size int, slot string, _id int, k1 string, known double"
    words = " ".join(f"wort{i} und der die" for i in range(60))
    rows = [(1, None, "de", "s", 0), (2, "", "de", None, None), (3, "½ 12 ...", None, "s", 1), (None, words, "de", "src1", 2), (None, words, "de", "src1", 2),
            (4, words + " mehr", "de", "src1", 3), (5, words + " " + " ".join(f"lang{i}" for i in range(30_000)), "de", "src2", 4), (6, "der die und", None, "src2", None)]
    rows += [(10 + k, f"und der die das {k}", "de", "src3", k) for k in range(40)]
    docs = spark.createDataFrame([(*r, 7, "x", 1, "k", 0.5) for r in rows], schema)
    names = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, TABLES), "pipeline-odd")
        assert set(names) <= set(docs.columns) and (name == "sharding" or docs.columns == names)
        kept.append(docs.select("doc_id", "text").collect())
    assert {1, 2, 3}.isdisjoint({r.doc_id for r in kept[0]}) and {4, 5, 6, None} <= {r.doc_id for r in kept[0]}
    assert sum((r.text or "").startswith("wort0") for r in kept[1]) == 2  # one of the near copies, and the long one
    assert {"size", "slot", "shard"} <= set(docs.columns) and len(kept[4]) == len(kept[3]) > 10
    docs = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, TABLES), "pipeline-empty")
        assert docs.count() == 0


def test_own_columns_of_mixing_replace_others(spark):
    rows = [(k, "one two three", "en", "src0", "own", 5, "t", "d") for k in range(6)] + [(None, "four five six seven", "en", "src1", "own", 5, "t", "d")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, epoch string, take int, n_tokens string, domain string")
    out = mixing.mixed(docs, mixing.corpus_levels(), 20, 1)
    drawn = out.collect()
    assert sum(r.take for r in drawn) == 20 and all(isinstance(r.epoch, int) and r.domain == "web" for r in drawn)
    assert sorted(out.columns) == sorted(docs.columns)

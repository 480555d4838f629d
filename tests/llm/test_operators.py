"""The operators against brute force or the libraries themselves, on odd rows and on the driver's small tables."""

from __future__ import annotations

import math
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cauce.llm import decontaminate, hash_forest, jaccard_join, language, line_templates, mixing, shards, token_counts, token_files, toxicity
from cauce.llm.queries import QUERIES, TWINS

public_tokenizers = pytest.importorskip("public_tokenizers")
TABLES = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, shard string, k1 int"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
ODD = [
    (1, None, "en", "src0", "x", 1), (2, "", "en", None, None, None), (3, "   \n ", None, "src1", "x", 1),
    (4, "one two", "en", "src0", "y", 2), (5, "one two", "en", "src0", "y", 2), (5, "one two", "en", "src0", "y", 2),
    (6, LONG, "de", "src2", "z", 3), (7, LONG + " end", "de", "src2", "z", 3), (None, "no id here at all", "en", "src0", "", 0),
    (8, "123 456 !!!", "en", "src0", "", 0), (9, "naïve ÉTÉ 日本 <|endoftext|> <s>", "fr", "src9", "", 0),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{TABLES}/documents.parquet")


def shingles(text, width=4):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute_classes(rows):
    sets, root = {}, {}
    for doc_id, text in rows:
        sets[doc_id], root[doc_id] = shingles(text), doc_id

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {d: (len(sets[d]), top(d)) for d in ids}


@pytest.mark.parametrize("page", [1_000_000, 2_000])
def test_jaccard_classes(documents, page, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PAGE_SHINGLES", page)
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.ngram_classes(documents).collect()}
    assert got == brute_classes(rows)


def test_jaccard_odd_rows(odd, none):
    got = defaultdict(list)
    for r in jaccard_join.ngram_classes(odd).collect():
        got[r.doc_id].append((r.n_shingles, r.component_id))
    assert got[1] == [(0, 1)] and got[2] == [(0, 2)] and got[3] == [(0, 3)]
    assert got[4] == [(1, 4)] and got[5] == [(1, 4)] * 2 and got[7][0][1] == 6 and got[None] == [(2, None)]
    assert jaccard_join.ngram_classes(none).count() == 0


@pytest.mark.parametrize("page", [1_000_000, 300])
def test_jaccard_lists_every_link(spark, page, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PAGE_SHINGLES", page)
    base = [f"v{i}" for i in range(60)]
    texts = [" ".join(base + [f"{c}{i}" for i in range(k)]) for k, c in enumerate("abcdefghijkl")]  # from 57 to 68 shingles
    texts += [texts[3]] * 2 + ["some other words here now", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [shingles(t) for t in texts]
    near = [[i != j and 100 * len(a & b) >= 85 * len(a | b) > 0 for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    want = {i: (len(sets[i]), sum(row)) for i, row in enumerate(near)}
    assert 0 < want[0][1] < want[3][1] or want[11][1] < want[3][1]
    assert {r.doc_id: (r.n_shingles, r.n_links) for r in jaccard_join.ngram_classes(docs).collect()} == want
    known, links = jaccard_join.ngram_links(docs, every="list")
    ids = {r.doc_id: r.id for r in known.collect()}
    got = [tuple(sorted((r.a, r.b))) for r in links.collect()]
    assert len(set(got)) == len(got)
    assert set(got) == {tuple(sorted((ids[i], ids[j]))) for i in ids for j in ids if near[i][j] and ids[i] != ids[j]}


@pytest.mark.parametrize("page", [1_000_000, 2_000])
def test_jaccard_fewer_links_have_the_same_classes(documents, page, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PAGE_SHINGLES", page)
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    known, links = jaccard_join.ngram_links(documents, every="")
    cls = {r.doc_id: r.cls for r in jaccard_join._classed(known, links).where("n > 0").collect()}
    want = {d: top for d, (n, top) in brute_classes(rows).items() if n}
    assert len({(cls[d], want[d]) for d in want}) == len(set(cls.values())) == len(set(want.values()))


@pytest.mark.parametrize("threshold", [85, 80])
@pytest.mark.parametrize("common", [0, 0.3, 0.9, 1])
def test_blocks_miss_no_linked_pair(threshold, common):
    rng, blocks = np.random.default_rng(3), jaccard_join.Blocks(threshold)
    frequent = np.sort(rng.integers(0, 1 << 62, 2000).astype(np.uint64))
    for n in (1, 2, 5, 6, 7, 11, 12, 13, 40, 200, 900):
        for _ in range(30):
            k = int(rng.binomial(n, common))
            a = np.unique(np.concatenate([rng.choice(frequent, k), rng.integers(0, 1 << 62, n - k).astype(np.uint64)]))
            a = rng.permutation(a)
            drop, add = rng.integers(0, n // 8 + 2), rng.integers(0, n // 8 + 2)
            more = rng.integers(0, 1 << 62, add).astype(np.uint64) if rng.random() < 0.5 else rng.choice(frequent, add)
            b = np.unique(np.concatenate([a[min(drop, n - 1):], more]))
            a = np.sort(a)
            both = len(np.intersect1d(a, b))
            if 100 * both >= threshold * (len(a) + len(b) - both):
                assert set(blocks.keys(a, frequent).tolist()) & set(blocks.keys(b, frequent).tolist())


def test_overlaps_over_bits_and_lists(monkeypatch):
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 300)).astype(np.uint64)) for _ in range(40)] + [np.array([10 ** 9], np.uint64)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    for bits in (1 << 20, 0):
        monkeypatch.setattr(jaccard_join, "BITS", bits)
        overlaps = jaccard_join.Overlaps(sets)
        assert (overlaps.bits is not None) == bool(bits)
        rows = [overlaps.with_one(q, np.arange(len(sets))).tolist() for q in range(len(sets))]
        assert [r[:-1] for r in rows[:-1]] == [w[:-1] for w in want[:-1]] and rows[-1][:-1] == [0] * 40  # alone: nothing shared


def test_jaccard_counts_repeated_rows_and_long_texts(spark, monkeypatch):
    """A third of all rows repeat one text under one id or none; passages that all documents share tie nothing."""
    monkeypatch.setattr(jaccard_join, "SEEN", 2)
    monkeypatch.setattr(jaccard_join, "PAGE_SHINGLES", 3_000)
    passage = " ".join(f"p{i}" for i in range(80))
    rows = [(None, passage + " end")] * 60 + [(1, passage + " end")] * 40
    rows += [(10 + k, " ".join(f"u{k}x{i}" for i in range(60 + k)) + " " + passage) for k in range(60)]
    rows += [(100 + k, " ".join(f"v{i}" for i in range(200)) + f" e{k}") for k in range(40)] + [(200, LONG), (201, LONG + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = defaultdict(list)
    for r in jaccard_join.ngram_classes(docs).collect():
        got[r.doc_id].append((r.component_id, r.n_links))
    assert got[None] == [(1, 99)] * 60 and got[1] == [(1, 99)] * 40 and got[200] == [(200, 1)] and got[201] == [(200, 1)]
    assert all(got[10 + k] == [(10 + k, 0)] for k in range(60)) and all(got[100 + k] == [(100, 39)] for k in range(40))


def test_documents_of_small_tasks_spread_over_parts(spark):
    docs = spark.range(0, 64, 1, 32).selectExpr("id AS doc_id", "concat('same words in each ', id % 2) AS text", "xxhash64(id) AS th")
    rows = docs.mapInArrow(
        jaccard_join._entries(85, 16, np.empty(0, np.uint64), 4), jaccard_join.ENTRY).where("kind < 2").groupBy("kind", "part").count().collect()
    assert {(r.kind, r.part): r["count"] for r in rows if r.kind == 0} == {(0, p): 2 for p in range(16)}


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{TABLES}/{t}.parquet'")
    result = con.execute(TWINS[name])
    columns = [d[0] for d in result.description]
    got = QUERIES[name](spark, TABLES)
    assert sorted(got.columns) == sorted(columns)
    rows = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str)
    assert rows == sorted(result.fetchall(), key=str)


def test_mixing_budgets(spark, odd, none):
    leaves = spark.createDataFrame([("a", "x", 10), ("a", "y", 100), ("b", "x", 500)], "domain string, lang string, tokens long")
    levels = [mixing.Level("domain", F.col("domain"), F.lit(1)), mixing.Level("lang", F.col("lang"), F.lit(1))]
    got = {(r.domain, r.lang): r.budget for r in mixing.leaf_budgets(leaves, levels, 301, 1).collect()}
    assert got == {("a", "x"): 10, ("a", "y"): 100, ("b", "x"): 191}  # the sibling takes what x lacks, then b what a lacks
    rows = mixing.mixed(odd, mixing.corpus_levels(), max_epochs=1)
    assert rows.count() and "shard" in rows.columns and rows.where("take > n_tokens or take <= 0").count() == 0
    assert mixing.mixed(none, mixing.corpus_levels()).count() == 0


def test_shards(odd, none, documents):
    rows = shards.shuffled_shards(documents, shards=5, bucket_bytes=50_000).toPandas()
    assert len(rows) == documents.count()
    for _, own in rows.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    more = dict(zip(rows.doc_id, rows.grown_shard))
    again = shards.shuffled_shards(documents, shards=6).toPandas()
    assert dict(zip(again.doc_id, again.shard)) == more
    assert shards.shuffled_shards(odd).count() == len(ODD) and shards.shuffled_shards(none).count() == 0


def test_token_files(spark, odd, none, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    files = spark.createDataFrame(token_files.write_token_files(odd, str(tmp_path / "t"), path, shard_tokens=50).toPandas())
    got = token_files.read_documents(spark, str(tmp_path / "t"), files).orderBy("start").collect()
    library = Tokenizer.from_file(path)
    want = {}
    for d, text, *_ in ODD:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want.setdefault(d, (len(ids), zlib.crc32(ids.tobytes())))
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 4, 5, 5, 6, 7, 8, 9]
    assert all((r.n_tokens, r.ids_crc32) == want[r.doc_id] for r in got)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    assert token_files.write_token_files(none, str(tmp_path / "n"), path).count() == 0


def test_wavelet_lookups():
    ids = np.random.default_rng(0).integers(0, 300, 200_000).astype(np.uint32)
    matrix = token_files.WaveletMatrix(token_files.build(ids, [7, None], np.array([5, 199_995])))
    at = np.flatnonzero(ids == 17)
    assert (matrix.all_ids() == ids).all() and matrix.documents()[0] == [7, None]
    assert all(matrix.access(i) == ids[i] for i in range(0, 200_000, 9_999))
    assert matrix.rank(17, 150_000) == (at < 150_000).sum() and matrix.rank(511) == 0
    assert [matrix.select(17, k) for k in (0, len(at) // 2, len(at) - 1)] == at[[0, len(at) // 2, -1]].tolist()


def test_token_counts(odd, none, documents):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    for df in (odd, documents):
        rows = df.select("doc_id", "text").collect()
        want = sorted((r.doc_id or 0, len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in rows)
        assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in token_counts.token_counts(df, path).collect()) == want
    assert token_counts.token_counts(none, path).count() == 0


def test_language(odd, none, documents):
    rows = language.identified(documents, ["doc_id", "text", "lang"]).where("held_out AND lang IS NOT NULL").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) >= 0.95 and all(0 <= r.score <= 1 for r in rows)
    got = {r.doc_id: r for r in language.identified(odd, ["doc_id", "text"]).collect()}
    assert all(got[d].lang_pred == "und" for d in (1, 2, 3, 8)) and got[None].held_out
    assert language.in_known_language(none).count() == 0


def test_toxicity(spark, odd, none):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = toxicity.toxicity(spark.read.parquet(f"{folder}/documents.parquet"), labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([(r.score >= 0.5) == r.toxic for r in rows]) >= 0.95
    few = spark.createDataFrame([(4, 1), (4, 0), (6, None)], "doc_id long, toxic int")
    assert all(0 <= r.score <= 1 for r in toxicity.toxicity(odd, few).collect())
    assert toxicity.toxicity(none, few.limit(0)).count() == 0


def test_isotonic_never_falls():
    rng = np.random.default_rng(1)
    score = rng.normal(size=500)
    at, freq = toxicity.isotonic(score, (rng.random(500) < 1 / (1 + np.exp(-score))).astype(float))
    assert (np.diff(at) > 0).all() and (np.diff(freq) > 0).all()


def test_lines(spark, odd, none):
    rows = [(i, f"call me at {i}55 now please\nown line {chr(97 + i)} {chr(99 + i)} x{chr(97 + i)}", "en") for i in range(6)]
    got = line_templates.without_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string, n_lines string")).collect()
    assert all(r.n_lines == 2 and r.n_dropped == 1 and r.text.startswith("own line") for r in got)
    got = {r.doc_id: r for r in line_templates.without_recurring_lines(odd).collect()}
    assert got[1].text is None and got[1].n_lines == 0 and got[2].n_lines == 1 and got[4].text == "one two"
    assert line_templates.without_recurring_lines(none).count() == 0


def test_decontamination_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "ONE two"), (2, None), (3, "..."), (None, "one two"), (4, LONG[:200])], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(odd, items).collect()}
    assert got[4].items == ["1"] and got[4].n_hit == 2 and got[6].items == ["4"] and got[1].n_words == 0 and got[8].n_hit == 0
    assert decontaminate.clean(odd, items).where("doc_id in (4, 5)").count() == 0
    assert decontaminate.contamination(none, items).count() == 0
    assert decontaminate.contamination(odd, items.limit(0)).where("n_hit > 0").count() == 0


def brute_nearest(rows, asked, k=10):
    """All rows but the query's own, by distance and id."""
    out = []
    for i, (q, v) in enumerate(rows):
        if asked(q):
            far = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(v, w))), o) for j, (o, w) in enumerate(rows) if j != i)
            out += [(q, r, o, d) for r, (d, o) in enumerate(far[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [16_384, 7])
def test_forest_with_copies_and_repeated_ids(spark, monkeypatch, block):
    """Everything is compared where there are few vectors: exact, with rows that repeat ids and vectors."""
    monkeypatch.setattr(hash_forest, "BLOCK", block)
    rng = np.random.default_rng(8)
    vectors = [[float(x) for x in rng.integers(-3, 4, 4)] for _ in range(25)]
    vectors = [v for v in vectors if any(v)]
    rows = [(int(i), v) for i, v in enumerate(vectors)] + [(100 + i, vectors[0]) for i in range(30)] + [(0, vectors[0])] * 3
    rows += [(0, vectors[1]), (200, vectors[2]), (200, vectors[2]), (200, vectors[3])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = hash_forest.nearest(df, F.col("vec_id") % 100 == 0, recall=1.1).collect()  # never reached: from the root
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute_nearest(rows, lambda i: i % 100 == 0)


@pytest.mark.parametrize("clusters", [0, 40])
@pytest.mark.parametrize("n", [300, 4096, 12_000])
def test_forest_recall_at_several_sizes(spark, n, clusters):
    rng = np.random.default_rng(n)
    x = rng.standard_normal((n, 32)).astype(np.float32)
    if clusters:
        x = (rng.standard_normal((clusters, 32))[rng.integers(0, clusters, n)] + 0.15 * x).astype(np.float32)
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<float>")
    got = hash_forest.nearest(df, F.col("vec_id") % 100 == 0).toPandas()
    found, wide = 0, x.astype(float)
    assert len(got) == 10 * len(range(0, n, 100))
    for q, own in got.groupby("query_id"):
        far = np.sqrt(((wide - wide[q]) ** 2).sum(1))
        far[q] = np.inf
        found += len(set(np.argsort(far, kind="stable")[:10]) & set(own.vec_id))
        assert np.allclose(own.score, far[own.vec_id], rtol=0, atol=1e-12) and own.sort_values("rank").score.is_monotonic_increasing
    assert found >= 0.9 * len(got)


def test_forest_gives_all_candidates_if_partitions_hold_too_few(spark):
    """Queries whose prefixes hold next to nothing ascend to the root."""
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.standard_normal((400, 8)) * 0.01 + 5, rng.standard_normal((5, 8)) * 3 - 9])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = hash_forest.nearest(df, F.col("vec_id") >= 395).groupBy("query_id").count().collect()
    assert {r.query_id: r["count"] for r in got} == {q: 10 for q in range(395, 405)}


def test_depth_follows_the_data():
    rng = np.random.default_rng(2)
    far, near = rng.standard_normal((200, 64)), rng.standard_normal((200, 64))
    planes, of = hash_forest.Planes(far, 1), np.arange(200)
    counts = np.broadcast_to(10_000 >> np.arange(33), (200, hash_forest.TREES, 33))

    def depth(other, classes=10_000, recall=0.95):
        shared = hash_forest._shared_bits(planes.strings(far, hash_forest.TREES), planes.strings(other, hash_forest.TREES))
        return hash_forest.chosen_depth(shared, of, counts, classes, 10, recall)
    close, loose = depth(far + 0.02 * near), depth(far + 0.8 * near)
    assert 7 >= close[0] > loose[0] and close[2] == 10_000 >> close[0]
    assert depth(far, 30) == (0, 1, 30) and depth(far, 10_000, 1.1) == (0, 1, 10_000)
    dense = np.full((200, hash_forest.TREES, 33), 10_000)  # all share all bits: nothing is found below the root's range
    shared = hash_forest._shared_bits(planes.strings(far, hash_forest.TREES), planes.strings(far + 0.8 * near, hash_forest.TREES))
    assert hash_forest.chosen_depth(shared, of, dense, 10_000, 10, 0.95)[2] >= loose[2]


def test_forest_recall_and_odd_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = vectors.toPandas()
    x, ids = np.stack(data.embedding).astype(float), data.vec_id.to_numpy()
    got = hash_forest.nearest(vectors, F.col("vec_id") % 100 == 0).toPandas()
    found = 0
    for q, own in got.groupby("query_id"):
        far = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        far[ids == q] = np.inf
        found += len(set(ids[np.lexsort((ids, far))[:10]]) & set(own.vec_id))
        assert np.allclose(own.score, far[[int(np.flatnonzero(ids == v)[0]) for v in own.vec_id]], rtol=0, atol=1e-12)
    assert found >= 0.9 * 10 * got.query_id.nunique()
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [0.0, 2.0]),
            (7, [1.0, 0.0]), (None, [1.0, 1.0]), (8, [1.0])]
    few = hash_forest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") == 0).collect()
    assert [(r.rank, r.vec_id) for r in sorted(few, key=lambda r: r.rank)] == [(1, 1), (2, 7), (3, 6)]
    assert hash_forest.nearest(vectors.limit(0), F.col("vec_id") == 0).count() == 0

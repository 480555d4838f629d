"""What the blocks of the Jaccard join leave out."""

from __future__ import annotations

from cauce.llm import jaccard_join


def test_the_sample_of_frequent_shingles_grows_with_the_rows(spark, monkeypatch):
    """A passage of a hundred texts out of many is found, though a sample of fixed size holds it too seldom; the classes stay."""
    monkeypatch.setattr(jaccard_join, "SAMPLE", 20)
    passage = " ".join(f"p{i}" for i in range(12))
    texts = [(i, " ".join(f"w{i}x{k}" for k in range(30)) + (f" {passage}" if i % 20 == 0 else "")) for i in range(4000)]
    docs = spark.createDataFrame(texts + [(4000, texts[7][1] + " end")], "doc_id long, text string")
    found = jaccard_join._frequent(docs.selectExpr("xxhash64(text) as th", "text"), "th", 5)
    assert set(jaccard_join.shingle_set(passage, 5, jaccard_join.WordHashes())) <= set(found)
    kept = jaccard_join.first_of_each(docs, width=5, threshold=80)
    assert kept.count() == 4000 and kept.where("doc_id = 4000").isEmpty()

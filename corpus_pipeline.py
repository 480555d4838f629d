"""From raw documents to training shards: each stage is written as Parquet and read again as the next one's input.

All stages keep the columns of the documents as they are, whatever they are called, and give no rows for an empty table. A null
doc_id is a document like any other, and so are rows that repeat an id; very long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.llm.common import discard, stored, table
from cauce.llm.decontaminate import clean
from cauce.llm.jaccard_join import first_of_each
from cauce.llm.language import in_known_language
from cauce.llm.mixing import corpus_levels, mixed, space_tokens
from cauce.llm.shards import shuffled_shards

SHARE = 0.9  # of the tokens that are left, dealt by the production weights


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, null and empty texts among them, or without a recognised language go; equal rows fare alike."""
    return in_known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays: sets of five-word shingles, similarity 0.8.

    Of rows equal in doc_id and text one stays; texts without words are no copies of anything.
    """
    return first_of_each(docs, width=5, threshold=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go if a twentieth of their words or more lies in 13-word windows of benchmark items; without words they stay."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents up to each source's budget, none twice; null and empty texts have no tokens and go."""
    total = docs.agg(F.sum(space_tokens(F.col("text")))).first()[0] or 0
    names = docs.columns
    rows = docs.select(F.struct(*names).alias("row"), "doc_id", "text", "lang", "source")
    return mixed(rows, corpus_levels(), int(total * SHARE), max_epochs=1).select("row.*")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with size, shard, grown_shard and slot, which replace columns of these names; null texts have no bytes."""
    return shuffled_shards(docs)


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing to target weights", to_target_weights),
    ("sharding", sharded),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir), "pipeline")
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)

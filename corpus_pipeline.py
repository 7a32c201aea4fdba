"""Corpus pipeline: quality rules, line dedup, near duplicates, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as
the next stage's docs. All but the last return the columns that they are given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siftmark.llm.decontaminate import uncontaminated
from siftmark.llm.jaccard_join import one_of_each
from siftmark.llm.line_dedup import deduped_lines
from siftmark.llm.quality_rules import keep_good, learned_rules, trusted_ids
from siftmark.llm.sentencepiece_codec import encoded
from siftmark.sources.scratch import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go. The trusted target is what labels mark as good."""
    trusted = trusted_ids(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return keep_good(docs, learned_rules(docs, trusted))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs go; a document of which nothing is left goes too."""
    return deduped_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles, similarity 0.8."""
    return one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids, exact of every document that is left."""
    return encoded(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("SentencePiece encoding", encoding_stage),
]

#: SQL has no means for hashed n-gram scores nor for the search for pieces.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of the folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs

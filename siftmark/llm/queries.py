"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftmark.llm.compression_quality import held_out_quality
from siftmark.llm.decontaminate import contamination
from siftmark.llm.jaccard_join import jaccard_components
from siftmark.llm.lexical_search import ranked_search
from siftmark.llm.line_dedup import line_report
from siftmark.llm.maxent_lm import language_scores
from siftmark.llm.quality_rules import learned_rules, quality_measures, trusted_ids
from siftmark.llm.sentencepiece_codec import encoded
from siftmark.llm.spelling_variants import spelling_forms
from siftmark.llm.substring_dedup import substring_dedup
from siftmark.llm.token_counts import token_counts
from siftmark.llm.toxicity import held_out_toxicity
from siftmark.llm.url_filter import url_verdicts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_measures(docs, learned_rules(docs, trusted_ids(table(spark, sf_dir, "labels"))))


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return held_out_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def dedup_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"))


def count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), shingle=4, percent=85)


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return held_out_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents"))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(table(spark, sf_dir, "documents"))


def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": quality_rules,
    "op2_quality_classifier": quality_classifier,
    "op3_decontaminate": decontaminate,
    "op4_line_dedup": line_dedup,
    "op5_substring_dedup": dedup_substrings,
    "op6_url_filter": url_filter,
    "op7_token_counts": count_tokens,
    "op8_sentencepiece": sentencepiece,
    "op9_jaccard_join": jaccard_join,
    "op10_toxicity": toxicity,
    "op11_language_model": language_model,
    "op12_spelling_variants": spelling_variants,
    "op13_lexical_search": lexical_search,
}

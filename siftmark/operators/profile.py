"""Profiles of long facts and of arbitrary frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftmark.functions.columns import contains_any, value_hashes
from siftmark.spec import SUSPICIOUS_TOKENS, MarketSpec


def frequency(df: DataFrame, c: str) -> DataFrame:
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("rows"))


def attribute_profile(long: DataFrame, spec: MarketSpec, top: int = 10) -> dict[str, DataFrame]:
    """The parts of an attribute profile, each as its own frame."""
    rows = F.desc("rows")
    return {
        "attribute_counts": frequency(long, spec.attribute).orderBy(rows, spec.attribute),
        "period_range": long.agg(
            F.min(spec.period).alias("min_period"), F.max(spec.period).alias("max_period"),
            F.count_distinct(spec.period).alias("periods"),
        ),
        "attribute_entities": long.groupBy(spec.attribute)
        .agg(F.count_distinct(spec.entity).alias("entities"))
        .orderBy(F.desc("entities"), spec.attribute),
        "top_entities": frequency(long, spec.entity).orderBy(rows, spec.entity).limit(top),
        "attribute_units": long.select(spec.attribute, spec.unit).distinct().orderBy(spec.attribute, spec.unit),
    }


def dataset_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: type, rows, non-null rows, distinct values.

    One scan and one shuffle for any number of columns: every row becomes one cell (column, two 64-bit
    hashes of the value) a column, equal cells are counted within each task, and only their counts
    are shuffled, by column and hash, so that neither a frequent value nor a column with many values is hot.
    The second hash tells values apart that share the first one.
    """
    types, names = dict(df.dtypes), list(columns or df.columns)
    cells = F.array(*[
        F.struct(F.lit(i).alias("position"), *[h.alias(f"h{k}") for k, h in enumerate(value_hashes(c, types[c]))])
        for i, c in enumerate(names)
    ])
    values = df.select(F.inline(cells)).groupBy("position", "h0", "h1").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("h0").isNotNull()
    counts = values.groupBy("position").agg(
        F.sum("n").alias("rows"), F.sum(F.when(known, F.col("n"))).alias("non_null"), F.count_if(known).alias("distinct_values"))
    every = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.lit(types[c]).alias("type")) for i, c in enumerate(names)])
    return df.sparkSession.range(1).select(F.inline(every)).join(counts, "position", "left").select(
        "position", "column_name", "type", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "non_null", "distinct_values")])


def suspicious_names(df: DataFrame, name: str, tokens: Sequence[str] = SUSPICIOUS_TOKENS) -> DataFrame:
    """Distinct names that contain one of the tokens."""
    return df.select(name).filter(F.col(name).isNotNull() & contains_any(name, tokens)).distinct()


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    return df.select(c).filter(F.col(c).isNotNull()).distinct()

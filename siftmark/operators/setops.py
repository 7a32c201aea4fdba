"""Set operations on keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).distinct().union(b.select(key).distinct()).distinct()


def minus_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys of a that b lacks."""
    return a.select(key).distinct().join(b.select(key).distinct(), key, "left_anti")


def common_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).distinct().join(b.select(key).distinct(), key, "left_semi")


def expected_members(df: DataFrame, key: str, expected: Sequence) -> DataFrame:
    """One row per expected key with whether the frame has it."""
    found = df.filter(F.col(key).isin(*expected)).agg(F.collect_set(key).alias("_found"))
    wanted = F.explode(F.array(*[F.lit(e) for e in expected]))
    return found.select(wanted.alias(key), "_found").select(
        key, F.array_contains("_found", F.col(key)).alias("present")
    )


def same_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys on one side only; empty when both hold the same set."""
    only_a = minus_keys(a, b, key).withColumn("side", F.lit("left"))
    return only_a.union(minus_keys(b, a, key).withColumn("side", F.lit("right")))

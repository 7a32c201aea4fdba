"""Top-k, sparsest entity and seeded samples; all ties are broken by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: str | Column, k: int, tie: Sequence[str]) -> DataFrame:
    """First k rows by ``by`` descending, NULLs last; each task keeps only its own k."""
    by = F.col(by) if isinstance(by, str) else by
    return df.orderBy(by.desc_nulls_last(), *tie).limit(k)


def sparsest(df: DataFrame, entity: str) -> DataFrame:
    """The entity with the fewest rows."""
    counts = df.groupBy(entity).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy("n", entity).limit(1)


def sample_keys(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n distinct non-null keys, chosen by a seeded hash: the same keys on every run and layout."""
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return keys.orderBy(order, key).limit(n)


def mode(df: DataFrame, c: str) -> DataFrame:
    """Most common value and its count."""
    counts = df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), c).limit(1)

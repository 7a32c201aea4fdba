"""Joins against lookup tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(facts: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Join ``facts`` to a lookup that has one row per key; ``how`` is left, inner, left_semi or left_anti.

    A plain join without hints: adaptive execution sees the sizes in bytes when both sides
    have run, sends a small lookup to every task, and otherwise splits the partitions of
    hot keys (and of missing keys) of the facts. Nothing runs while the plan is built and
    each input is read once. That keys are unique is what ``audit.key_report`` checks.
    """
    keys = [on] if isinstance(on, str) else list(on)
    added = [] if how in ("left_semi", "left_anti") else [c for c in lookup.columns if c not in keys]
    return facts.join(lookup, keys, how).select(*facts.columns, *added)


def orphans(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct fact keys that have no dimension row."""
    keys = facts.select(key).filter(F.col(key).isNotNull()).distinct()
    return keys.join(dim.select(key).distinct(), key, "left_anti")


def fill_from_lookup(
    dim: DataFrame, lookup: DataFrame, key: str, source: str, targets: Sequence[str]
) -> DataFrame:
    """Where any target is NULL and the lookup knows the key, set all targets to the lookup value."""
    values = lookup.select(key, F.col(source).alias("_lookup")).groupBy(key).agg(F.max("_lookup").alias("_lookup"))
    any_null = F.lit(False)
    for t in targets:
        any_null = any_null | F.col(t).isNull()
    fill = any_null & F.col("_lookup").isNotNull()
    joined = lookup_join(dim, values, key, "left")
    filled = {t: F.when(fill, F.col("_lookup")).otherwise(F.col(t)) for t in targets}
    return joined.withColumns(filled).drop("_lookup").select(*dim.columns)

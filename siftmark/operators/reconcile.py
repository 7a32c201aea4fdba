"""Entity-name to code reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftmark.functions.columns import match_key, sentinels_to_null, strip
from siftmark.operators.joins import lookup_join
from siftmark.spec import EXCLUDED_NAMES, NAME_OVERRIDES

MAPPED_METHODS = ("manual_override", "exact_match")


def label_lookup(codes: DataFrame, name: str, code: str, order: str | Column) -> DataFrame:
    """One code per lower-cased, stripped label; the row latest in ``order`` wins."""
    known = sentinels_to_null(name).isNotNull() & sentinels_to_null(code).isNotNull()
    rows = codes.filter(known).select(
        match_key(name).alias("_label"),
        strip(code).alias("_label_code"),
        (F.col(order) if isinstance(order, str) else order).alias("_order"),
    )
    return rows.groupBy("_label").agg(F.max_by("_label_code", "_order").alias("_label_code"))


def resolve_codes(
    df: DataFrame,
    name: str,
    labels: DataFrame,
    *,
    code: str = "iso3_code",
    method: str = "match_method",
    overrides: Mapping[str, str] = NAME_OVERRIDES,
    excluded: Sequence[str] = EXCLUDED_NAMES,
) -> DataFrame:
    """Add ``code`` and ``method`` to every row.

    Precedence: excluded name, override (exact string), label (case and outer whitespace
    ignored), unmapped. Works on distinct names and on whole fact tables alike: overrides
    are literals and the label table is joined by ``lookup_join``.
    """
    n = F.col(name)
    is_excluded = n.isin(*excluded) if excluded else F.lit(False)
    if overrides:
        pairs = [F.lit(x) for item in overrides.items() for x in item]
        override = F.element_at(F.create_map(*pairs), n)
    else:
        override = F.lit(None).cast("string")
    keyed = df.withColumn("_label", match_key(name))
    joined = lookup_join(keyed, labels, "_label", "left")
    by_label = F.when(F.col("_label_code") != "", F.col("_label_code"))
    return joined.withColumns({
        code: F.when(~is_excluded, F.coalesce(override, by_label)),
        method: F.when(is_excluded, "excluded")
        .when(override.isNotNull(), "manual_override")
        .when(by_label.isNotNull(), "exact_match")
        .otherwise("unmapped"),
    }).select(*df.columns, code, method)


def name_mapping(source: DataFrame, name: str, labels: DataFrame, **kwargs) -> DataFrame:
    """Mapping report: one row per distinct source name."""
    names = source.select(name).filter(F.col(name).isNotNull()).distinct()
    return resolve_codes(names, name, labels, **kwargs)


def method_counts(mapping: DataFrame, method: str = "match_method") -> DataFrame:
    return mapping.groupBy(method).agg(F.count(F.lit(1)).alias("names"))

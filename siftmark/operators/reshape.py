"""Long <-> wide reshaping and attribute choice."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftmark.functions.columns import contains_any
from siftmark.spec import ATTRIBUTE_PREFERENCES, MarketSpec


class PivotReport(NamedTuple):
    fact: DataFrame
    kept: dict[str, str]
    dropped: list[str]


def pivot_measures(long: DataFrame, spec: MarketSpec, measures: Mapping[str, str] | None = None) -> DataFrame:
    """Long facts to one row per (entity, period), one column per mapped attribute.

    Only pairs present in the source appear, and only if they carry a value. The explicit
    attribute list keeps it one hash aggregate with map-side combine: a hot entity shrinks
    to one row per period in every map task before the shuffle.
    """
    measures = spec.measures if measures is None else measures
    return _pivot(long, spec, [(attribute, column) for attribute, column in measures.items()])


def _pivot(long: DataFrame, spec: MarketSpec, cells: Sequence[tuple[str, str]]) -> DataFrame:
    cells = [
        F.max(F.when(F.col(spec.attribute) == attribute, F.col(spec.value))).alias(column)
        for attribute, column in cells
    ]
    return (
        long.filter(F.col(spec.entity).isNotNull())
        .groupBy(*spec.keys)
        .agg(*cells, F.count(spec.value).alias("_values"))
        .filter("_values > 0")
        .drop("_values")
    )


def attributes_present(long: DataFrame, spec: MarketSpec, candidates: Iterable[str]) -> list[str]:
    """Those of the candidate labels that occur; runs a job, whose result is no longer than the candidates."""
    rows = long.select(spec.attribute).filter(F.col(spec.attribute).isin(*set(candidates))).distinct().collect()
    return sorted(r[0] for r in rows)


def pivot_present(
    long: DataFrame, spec: MarketSpec, targets: Mapping[str, Sequence[str]]
) -> PivotReport:
    """Pivot by a preference list per measure; measures without any present attribute are dropped."""
    present = set(attributes_present(long, spec, [c for names in targets.values() for c in names]))
    kept: dict[str, str] = {}
    dropped: list[str] = []
    for column, candidates in targets.items():
        match = next((c for c in candidates if c in present), None)
        if match is None:
            dropped.append(column)
        else:
            kept[column] = match
    fact = _pivot(long, spec, [(attribute, column) for column, attribute in kept.items()])
    return PivotReport(fact, kept, dropped)


def choose_attributes(
    present: Sequence[str], preferences: Mapping[str, Sequence[str]] = ATTRIBUTE_PREFERENCES
) -> dict[str, str]:
    """First preferred attribute per category among those present whose label names the category."""
    chosen = {}
    for category, candidates in preferences.items():
        matches = [a for a in present if category in a.lower()]
        pick = next((c for c in candidates if c in matches), None)
        if pick is None:
            raise ValueError(f"no attribute for {category}; present: {list(present)}")
        chosen[category] = pick
    return chosen


def category_matches(long: DataFrame, spec: MarketSpec, categories: Sequence[str]) -> DataFrame:
    """(category, attribute) pairs where the attribute label contains the category word."""
    labels = long.select(spec.attribute).filter(F.col(spec.attribute).isNotNull()).distinct()
    hits = F.array_compact(F.array(*[
        F.when(contains_any(spec.attribute, [c]), F.lit(c)) for c in categories
    ]))
    return labels.select(F.explode(hits).alias("category"), spec.attribute)


def unpivot_periods(
    wide: DataFrame, ids: Sequence[str], period_columns: Sequence[str], period: str, value: str
) -> DataFrame:
    """One row per (ids, period column); narrow operation, no shuffle."""
    return wide.unpivot(list(ids), list(period_columns), period, value)


def unpivot_measures(fact: DataFrame, spec: MarketSpec, measures: Mapping[str, str]) -> DataFrame:
    """Wide fact back to (entity, period, attribute, value), leaving out empty cells."""
    cells = F.array(*[
        F.struct(F.lit(attribute).alias("a"), F.col(column).alias("v"))
        for attribute, column in measures.items()
    ])
    return (
        fact.select(*spec.keys, F.explode(cells).alias("cell"))
        .select(*spec.keys, F.col("cell.a").alias(spec.attribute), F.col("cell.v").alias(spec.value))
        .filter(F.col(spec.value).isNotNull())
    )

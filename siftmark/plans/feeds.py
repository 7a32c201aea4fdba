"""Data feeds for overview, comparison and detail displays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftmark.functions import labels
from siftmark.functions.columns import cagr
from siftmark.operators.growth import cagr_name
from siftmark.operators.latest import first_and_last, headline_rows
from siftmark.plans.warehouse import IMPORT_SHARE, PER_CAPITA_KG
from siftmark.spec import MarketSpec


def trend_range(trends: DataFrame, spec: MarketSpec, low: int, high: int) -> DataFrame:
    """Trend rows of a closed period range, with totals in thousands."""
    return trends.filter(F.col(spec.period).between(low, high)).withColumns({
        "consumption_thousands": F.col("total_consumption") / 1000.0,
        "production_thousands": F.col("total_production") / 1000.0,
    })


def endpoint_growth(trends: DataFrame, spec: MarketSpec, low: int, high: int) -> DataFrame:
    """Headline row of a range: end total, compound growth in percent (0 if undefined), entities at the end.

    No row when the range has fewer than two periods.
    """
    first, last = f"first_{spec.period}", f"last_{spec.period}"
    ends = first_and_last(
        trends.filter(F.col(spec.period).between(low, high)), spec.period,
        ["total_consumption", spec.reporting],
    ).filter("periods >= 2")
    span = F.col(last) - F.col(first)
    growth = F.when(span > 0, cagr("last_total_consumption", "first_total_consumption", span.cast("double")))
    return ends.select(
        first, last,
        (F.col("last_total_consumption") / 1000.0).alias("latest_thousands"),
        (F.coalesce(growth, F.lit(0.0)) * 100.0).alias("growth_pct"),
        F.col(f"last_{spec.reporting}").alias(spec.reporting),
    )


def kpi_cards(growth: DataFrame, spec: MarketSpec) -> DataFrame:
    """Display texts of the headline row; input is ``endpoint_growth``."""
    return growth.select(
        F.format_string("%.1fM", F.col("latest_thousands")).alias("latest_label"),
        F.format_string("%.2f%%", F.col("growth_pct")).alias("growth_label"),
        F.format_string("CAGR (%d to %d)", F.col(f"first_{spec.period}"), F.col(f"last_{spec.period}")).alias("growth_title"),
        labels.number(spec.reporting).alias("reporting_label"),
    )


def region_totals(
    metrics: DataFrame, spec: MarketSpec, period: int, *, keep_unknown: bool = False
) -> DataFrame:
    """Consumption and entities per region in one period."""
    rows = metrics.filter(F.col(spec.period) == period)
    if not keep_unknown:
        rows = rows.filter(F.col(spec.region).isNotNull() & F.col(spec.consumption).isNotNull())
    return rows.groupBy(spec.region).agg(
        F.sum(spec.consumption).alias("total_consumption"),
        F.count_distinct(spec.entity).alias(spec.region_members),
    )


def comparison_feed(snapshot: DataFrame, spec: MarketSpec, regions: Sequence[str] | None = None) -> DataFrame:
    """Markets with known size, population and growth, in the chosen regions."""
    growth = cagr_name(spec.lags[0])
    rows = snapshot.filter(
        F.col(spec.consumption).isNotNull() & F.col(spec.population).isNotNull() & F.col(growth).isNotNull()
    )
    if regions is not None:
        rows = rows.filter(F.col(spec.region).isin(*regions))
    return rows.select(
        spec.entity, spec.name, spec.region, spec.consumption, growth, spec.population, PER_CAPITA_KG
    )


def entity_series(metrics: DataFrame, spec: MarketSpec, entity) -> DataFrame:
    """Full series of one entity; the equality filter is pushed to the scan."""
    return metrics.filter(F.col(spec.entity) == F.lit(entity)).select(
        spec.entity, spec.period, spec.consumption, spec.production, spec.imports
    )


def deep_dive_headlines(metrics: DataFrame, spec: MarketSpec) -> DataFrame:
    """Headline labels for every entity: latest period with population, else the latest."""
    rows = headline_rows(metrics, spec.entity, spec.period, spec.population)
    return rows.select(
        spec.entity, spec.name, spec.period,
        labels.number(spec.consumption).alias("consumption_label"),
        labels.number(spec.production).alias("production_label"),
        labels.millions(spec.population).alias("population_label"),
        labels.number(PER_CAPITA_KG, 2).alias("per_capita_label"),
    )


def opportunity_lines(snapshot: DataFrame, spec: MarketSpec) -> DataFrame:
    """One sentence per entity of the snapshot."""
    return snapshot.select(spec.entity, labels.opportunity(spec, IMPORT_SHARE).alias("opportunity"))


def entity_choices(snapshot: DataFrame, spec: MarketSpec) -> DataFrame:
    """Entities offered by a selector."""
    return snapshot.select(spec.entity, spec.name).distinct()


def region_choices(dim: DataFrame, spec: MarketSpec) -> DataFrame:
    return dim.select(spec.region).filter(F.col(spec.region).isNotNull()).distinct()


def period_bounds(fact: DataFrame, spec: MarketSpec) -> DataFrame:
    return fact.agg(F.min(spec.period).alias("first_period"), F.max(spec.period).alias("last_period"))



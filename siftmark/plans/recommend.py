"""Parameterised recommendation and its sensitivity to weights and regions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftmark.functions import labels
from siftmark.functions.columns import weighted_sum
from siftmark.operators.growth import cagr_name
from siftmark.plans.warehouse import (
    COMPOSITE,
    IMPORT_SHARE,
    SCORES,
    component_scores,
    market_attractiveness,
    rank_position,
    top_candidates,
)
from siftmark.spec import WEIGHT_SCENARIOS, MarketSpec


def normalise_weights(weights: Sequence[float]) -> tuple[float, ...]:
    """Weights that sum to one; all-zero weights stay as they are."""
    total = sum(weights)
    return tuple(w / total for w in weights) if total > 0 else tuple(weights)


def recommend(
    snapshot: DataFrame,
    spec: MarketSpec,
    *,
    regions: Sequence[str] | None = None,
    weights: Sequence[float] | None = None,
    k: int | None = None,
) -> DataFrame:
    """Top-k markets among the chosen regions, by normalised weights.

    ``regions=None`` keeps every entity, also those without a region. A list keeps only
    entities of these regions, and an empty list gives an empty result.
    """
    weights = normalise_weights(spec.weights if weights is None else weights)
    scored = market_attractiveness(snapshot, spec, weights, regions=regions)
    return top_candidates(scored, spec, k)


def recommendation_cards(
    top: DataFrame, spec: MarketSpec, notes: Mapping[str, str] | None = None, cards: int = 3
) -> DataFrame:
    """Display rows of the first markets; empty if there are fewer than ``cards`` of them."""
    growth = cagr_name(spec.lags[0])
    numbered = rank_position(top, spec)
    enough = F.count(F.lit(1)).over(Window.partitionBy()) >= cards
    return numbered.withColumn("_enough", enough).filter(F.col("_enough") & (F.col("position") <= cards)).select(
        "position", spec.entity, spec.name,
        F.coalesce(F.col(spec.region), F.lit(labels.NOT_AVAILABLE)).alias("region_label"),
        labels.number(COMPOSITE, 2).alias("score_label"),
        labels.millions(spec.population).alias("population_label"),
        labels.number(spec.consumption).alias("consumption_label"),
        labels.pct(growth).alias("growth_label"),
        labels.pct(IMPORT_SHARE, 0).alias("import_label"),
        labels.narrative("position", growth, IMPORT_SHARE).alias("narrative"),
        labels.note_for(spec.name, notes or {}).alias("note"),
        labels.reason(spec, growth, IMPORT_SHARE).alias("reason"),
    )


def display_table(top: DataFrame, spec: MarketSpec) -> DataFrame:
    """The full top list with formatted columns."""
    return rank_position(top, spec).select(
        "position", spec.name, spec.region,
        labels.number(spec.consumption).alias("consumption_label"),
        labels.pct(cagr_name(spec.lags[0])).alias("growth_label"),
        labels.millions(spec.population).alias("population_label"),
        labels.pct(IMPORT_SHARE, 0).alias("import_label"),
        labels.number(COMPOSITE, 3).alias("score_label"),
    )


def weight_scenarios(
    snapshot: DataFrame,
    spec: MarketSpec,
    scenarios: Mapping[str, Sequence[float]] = WEIGHT_SCENARIOS,
    *,
    k: int = 3,
) -> DataFrame:
    """Top k entities per weight scenario.

    The ranks are computed once. Each row then carries one score per scenario, and the
    rank limit keeps k rows per scenario in every task before anything is shuffled.
    """
    scored = component_scores(snapshot, spec)
    cells = F.array(*[
        F.struct(F.lit(name).alias("scenario"), weighted_sum(SCORES, weights).alias(COMPOSITE))
        for name, weights in scenarios.items()
    ])
    long = scored.select(spec.entity, spec.name, F.explode(cells).alias("c")).select(
        "c.scenario", spec.entity, spec.name, f"c.{COMPOSITE}"
    )
    w = Window.partitionBy("scenario").orderBy(F.col(COMPOSITE).desc(), spec.entity)
    return (
        long.withColumn("position", F.row_number().over(w))
        .filter(F.col("position") <= k)
        .withColumn("position", F.col("position").cast("bigint"))
    )


def region_scenarios(
    snapshot: DataFrame,
    spec: MarketSpec,
    regions: Mapping[str, Sequence[str] | None],
    *,
    k: int = 3,
) -> DataFrame:
    """Top k per region choice; the ranks are those within each choice.

    The snapshot is computed once and all choices are ranked in one pass, however many there are.
    """
    scored = component_scores(snapshot, spec, choices=regions).withColumn(COMPOSITE, weighted_sum(SCORES, spec.weights))
    w = Window.partitionBy("scenario").orderBy(F.col(COMPOSITE).desc(), spec.entity)
    top = scored.withColumn("position", F.row_number().over(w).cast("bigint")).filter(F.col("position") <= k)
    return top.select("scenario", "position", spec.entity, spec.name, spec.region, COMPOSITE)


def ranked_lists(tops: DataFrame, spec: MarketSpec) -> DataFrame:
    """The ordered list of entities per scenario, as text."""
    ordered = F.array_sort(F.collect_list(F.struct("position", F.col(spec.entity).cast("string").alias("e"))))
    return tops.groupBy("scenario").agg(F.concat_ws(",", ordered["e"]).alias("ranked"))


def distinct_lists(tops: DataFrame, spec: MarketSpec) -> DataFrame:
    """How many scenarios there are and how many different lists they give."""
    return ranked_lists(tops, spec).agg(
        F.count(F.lit(1)).alias("scenarios"), F.count_distinct("ranked").alias("distinct_lists")
    )

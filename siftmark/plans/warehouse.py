"""From raw frames to the ranked markets: clean layer, facts, views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftmark.functions.columns import (
    difference,
    per_population,
    ratio_if_positive,
    sentinels_to_null,
    strip,
    to_double,
    to_long,
    weighted_sum,
)
from siftmark.operators.growth import cagr_name, with_growth
from siftmark.operators.joins import fill_from_lookup, lookup_join
from siftmark.operators.latest import latest_valid
from siftmark.operators.rank import percent_ranks
from siftmark.operators.reconcile import MAPPED_METHODS, label_lookup, resolve_codes
from siftmark.operators.reshape import unpivot_periods
from siftmark.operators.topk import top_k
from siftmark.sources.readers import period_columns, resolve_headers
from siftmark.spec import ISO2_HEADERS, ISO3_HEADERS, NAME_HEADERS, MarketSpec

SCORES = ["size_score", "growth_score", "population_score", "import_openness_score"]
COMPOSITE = "composite_score"
PER_CAPITA_KG = "per_capita_kg_per_person"
PER_CAPITA_BAGS = "per_capita_bags_per_1000"
IMPORT_SHARE = "import_dependency_ratio"


# Clean layer

def clean_codes(raw: DataFrame) -> DataFrame:
    """Reference codes: columns found by header candidates, stripped, sentinels to NULL."""
    name, iso3, iso2 = resolve_headers(raw.columns, {"name": NAME_HEADERS, "ISO3": ISO3_HEADERS, "ISO2": ISO2_HEADERS})
    blank = F.lit("")
    return raw.select(
        sentinels_to_null(strip(iso3)).alias("iso3_code"),
        sentinels_to_null(strip(iso2)).alias("iso2_code"),
        sentinels_to_null(strip(name)).alias("english_name"),
        blank.alias("region"), blank.alias("sub_region"), blank.alias("continent"),
    ).filter(F.col("iso3_code").isNotNull())


def code_labels(raw_codes: DataFrame, order: str | Column) -> DataFrame:
    """Label lookup of raw reference codes; of rows with one label the last in ``order`` wins.

    Rows read from files have such an order through ``readers.read_csv(ordered=True)``.
    """
    name, iso3 = resolve_headers(raw_codes.columns, {"name": NAME_HEADERS, "ISO3": ISO3_HEADERS})
    return label_lookup(raw_codes, name, iso3, order)


def clean_long_fact(
    raw: DataFrame,
    labels: DataFrame,
    spec: MarketSpec,
    headers: Mapping[str, str] | None = None,
    **mapping_options,
) -> DataFrame:
    """Long fact with codes attached and values typed; rows that lack a key or value are dropped.

    ``headers`` maps raw header -> column of the result.
    """
    headers = headers or {
        "Country_Name": spec.name, "Market_Year": spec.period, "Attribute_ID": spec.attribute_id,
        "Attribute_Description": spec.attribute, "Value": spec.value, "Unit_Description": spec.unit,
    }
    renamed = raw.select(*[F.col(f"`{h}`").alias(c) for h, c in headers.items()])
    coded = resolve_codes(renamed, spec.name, labels, code=spec.entity, **mapping_options)
    typed = coded.filter(F.col("match_method").isin(*MAPPED_METHODS)).withColumns({
        spec.period: to_long(spec.period),
        spec.attribute_id: to_long(spec.attribute_id),
        spec.value: to_double(spec.value),
    })
    needed = [spec.entity, spec.value, spec.period, spec.attribute_id]
    return typed.na.drop(subset=needed).select(
        spec.entity, spec.name, spec.period, spec.attribute_id, spec.attribute, spec.value, spec.unit
    )


def clean_population(
    wide: DataFrame, codes: DataFrame, spec: MarketSpec, name: str = "Country Name", code: str = "Country Code"
) -> DataFrame:
    """Wide period columns to long rows with a number, for entities in the reference codes."""
    periods = period_columns(wide.columns)
    long = unpivot_periods(wide, [name, code], periods, spec.population_period, spec.population)
    typed = long.select(
        F.col(f"`{name}`").alias(spec.name),
        F.col(f"`{code}`").alias(spec.entity),
        F.col(spec.population_period).cast("bigint").alias(spec.population_period),
        to_double(spec.population).alias(spec.population),
    ).na.drop(subset=[spec.population_period, spec.population, spec.entity])
    valid = codes.select(F.col("iso3_code").alias(spec.entity)).distinct()
    return lookup_join(typed, valid, spec.entity, "left_semi")


# Dimension and facts

def dim_entity(
    codes: DataFrame,
    spec: MarketSpec,
    region_lookup: DataFrame | None = None,
    lookup_value: str = "continent",
    name: str = "english_name",
    key: str = "iso3_code",
) -> DataFrame:
    """Entity dimension; region and continent are filled together from the lookup where one is missing."""
    dim = codes.filter(F.col(key).isNotNull()).select(
        F.col(key).alias(spec.entity), F.col(name).alias(spec.name), "iso2_code",
        *[F.nullif(F.col(c).cast("string"), F.lit("")).alias(c)
          for c in (spec.region, spec.sub_region, spec.continent)],
    )
    if region_lookup is None:
        return dim
    return fill_from_lookup(dim, region_lookup, spec.entity, lookup_value, [spec.region, spec.continent])


def fact_population(population: DataFrame, spec: MarketSpec) -> DataFrame:
    return population.filter(F.col(spec.entity).isNotNull() & F.col(spec.population).isNotNull()).select(
        spec.entity, spec.population_period, spec.population
    )


# Views

def _with_population(fact: DataFrame, population: DataFrame, spec: MarketSpec) -> DataFrame:
    people = population.select(
        spec.entity, F.col(spec.population_period).alias(spec.period), spec.population
    )
    return fact.select(*spec.keys, *spec.core_measures).join(people, spec.keys, "left")


def _derived(spec: MarketSpec) -> list[Column]:
    c, p = spec.consumption, spec.population
    return [
        per_population(c, p, spec.kg_per_unit).alias(PER_CAPITA_KG),
        per_population(c, p, spec.bags_per_unit_1000).alias(PER_CAPITA_BAGS),
        difference(spec.imports, spec.exports).alias(spec.net_imports),
        ratio_if_positive(spec.imports, c).alias(IMPORT_SHARE),
    ]


def entity_period_metrics(
    fact: DataFrame, dim: DataFrame, population: DataFrame, spec: MarketSpec
) -> DataFrame:
    """Fact with dimension attributes, population and the four derived metrics."""
    attributes = dim.select(spec.entity, spec.name, spec.region, spec.sub_region, spec.continent)
    joined = lookup_join(_with_population(fact, population, spec), attributes, spec.entity, "inner")
    return joined.select(
        spec.entity, spec.name, spec.region, spec.sub_region, spec.continent, spec.period,
        *spec.core_measures, spec.population, *_derived(spec),
    )


def _latest_with_growth(rows: DataFrame, spec: MarketSpec) -> DataFrame:
    """Growth and latest period from the same exchange on the entity."""
    valid = F.col(spec.consumption).isNotNull() & F.col(spec.population).isNotNull()
    return latest_valid(with_growth(rows, spec), spec.entity, spec.period, valid)


def latest_snapshot(metrics: DataFrame, spec: MarketSpec) -> DataFrame:
    """Each entity's latest period with consumption and population, with its growth."""
    return _latest_with_growth(metrics, spec).drop(spec.sub_region)


def market_snapshot(
    fact: DataFrame, dim: DataFrame, population: DataFrame, spec: MarketSpec
) -> DataFrame:
    """``latest_snapshot`` of ``entity_period_metrics``, straight from the facts.

    The dimension is joined after the series are reduced to one row per entity, so its
    text columns are neither shuffled nor sorted with the series, and rows without
    consumption, which no result depends on, go before the shuffle.
    """
    series = _with_population(fact.filter(F.col(spec.consumption).isNotNull()), population, spec)
    latest = _latest_with_growth(series, spec)
    attributes = dim.select(spec.entity, spec.name, spec.region, spec.continent)
    joined = lookup_join(latest, attributes, spec.entity, "inner")
    return joined.select(
        spec.entity, spec.name, spec.region, spec.continent, spec.period,
        *spec.core_measures, spec.population, *_derived(spec), *[cagr_name(n) for n in spec.lags],
    )


def global_trends(fact: DataFrame, spec: MarketSpec) -> DataFrame:
    """Totals per period and the number of entities with a row."""
    return fact.groupBy(spec.period).agg(
        F.sum(spec.consumption).alias("total_consumption"),
        F.sum(spec.production).alias("total_production"),
        F.sum(spec.imports).alias(spec.total_imports),
        F.sum(spec.exports).alias(spec.total_exports),
        F.count_distinct(spec.entity).alias(spec.reporting),
    )


def ranking_base(snapshot: DataFrame, spec: MarketSpec, regions: Sequence[str] | None = None) -> DataFrame:
    """Rows that take part in the ranking. The filter comes before the ranks."""
    base = snapshot.filter(
        F.col(spec.consumption).isNotNull() & F.col(spec.population).isNotNull() & (F.col(spec.consumption) > 0)
    )
    return base if regions is None else base.filter(F.col(spec.region).isin(*regions))


def component_metrics(spec: MarketSpec) -> dict[str, Column]:
    """Metric behind each score: size, growth (unknown counts as -1), population, import share (unknown as 0)."""
    return {
        "size_score": F.col(spec.consumption),
        "growth_score": F.coalesce(F.col(cagr_name(spec.lags[0])), F.lit(-1.0)),
        "population_score": F.col(spec.population),
        "import_openness_score": F.coalesce(F.col(IMPORT_SHARE), F.lit(0.0)),
    }


def component_scores(
    snapshot: DataFrame, spec: MarketSpec, *, regions: Sequence[str] | None = None,
    choices: Mapping[str, Sequence[str] | None] | None = None,
) -> DataFrame:
    """The four percent-rank scores within the (optionally region-filtered) set.

    With ``choices`` (name -> regions, None for all) every row is tagged with the choices it belongs
    to and ranked within each of them, for all choices in one pass; the name is in ``scenario``.
    """
    columns = [
        spec.entity, spec.name, spec.region, spec.continent, spec.period, spec.consumption,
        PER_CAPITA_KG, cagr_name(spec.lags[0]), spec.population, IMPORT_SHARE,
    ]
    base = ranking_base(snapshot, spec, regions).select(*columns)
    if choices is None:
        return percent_ranks(base, component_metrics(spec))
    member = [F.lit(name) if chosen is None else F.when(F.col(spec.region).isin(*chosen), F.lit(name)) for name, chosen in choices.items()]
    tagged = base.select(F.explode(F.array_compact(F.array(*member))).alias("scenario"), *columns)
    return percent_ranks(tagged, component_metrics(spec), within=["scenario"])


def market_attractiveness(
    snapshot: DataFrame,
    spec: MarketSpec,
    weights: Sequence[float] | None = None,
    *,
    regions: Sequence[str] | None = None,
) -> DataFrame:
    """Ranking set with component scores and their weighted sum."""
    scored = component_scores(snapshot, spec, regions=regions)
    return scored.withColumn(COMPOSITE, weighted_sum(SCORES, weights or spec.weights))


def top_candidates(attractiveness: DataFrame, spec: MarketSpec, k: int | None = None) -> DataFrame:
    return top_k(attractiveness, COMPOSITE, k or spec.top_k, [spec.entity])


def rank_position(df: DataFrame, spec: MarketSpec) -> DataFrame:
    """Number the rows of a short top-k list."""
    w = Window.orderBy(F.col(COMPOSITE).desc(), spec.entity)
    return df.withColumn("position", F.row_number().over(w).cast("bigint"))

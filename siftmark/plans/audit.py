"""Data-quality results and checks.

Detail frames hold the findings; ``check_*`` functions reduce them to rows
(check_id, status, measured, threshold, details). Checks over the same input share one
aggregate pass. ``scorecard`` rates the union of all check rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftmark.functions.columns import gap_pct, null_or_zero, sum_of
from siftmark.operators.content import content_differences
from siftmark.operators.growth import cagr_name
from siftmark.operators.joins import lookup_join, orphans
from siftmark.operators.rank import component_leaders
from siftmark.operators.reshape import unpivot_measures
from siftmark.operators.setops import union_keys
from siftmark.operators.topk import mode, top_k
from siftmark.plans.recommend import distinct_lists
from siftmark.plans.warehouse import (
    COMPOSITE,
    PER_CAPITA_BAGS,
    PER_CAPITA_KG,
    component_metrics,
    ranking_base,
)
from siftmark.sources.scratch import written
from siftmark.spec import MarketSpec

CODE_PATTERN = "^[A-Z]{3}$"


class Rule(NamedTuple):
    """One check over an aggregate row: passes where ``passed`` holds."""

    check_id: str
    measured: Column
    threshold: float
    passed: Column
    details: str
    otherwise: str = "FAIL"


def check_rows(aggregate: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule from a one-row aggregate."""
    rows = [
        F.struct(
            F.lit(r.check_id).alias("check_id"),
            F.when(r.passed, "PASS").otherwise(r.otherwise).alias("status"),
            r.measured.cast("double").alias("measured"),
            F.lit(float(r.threshold)).alias("threshold"),
            F.lit(r.details).alias("details"),
        )
        for r in rules
    ]
    return aggregate.select(F.inline(F.array(*rows)))


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def check_empty(findings: DataFrame, check_id: str, details: str, otherwise: str = "FAIL") -> DataFrame:
    """Passes when there are no findings; measures how many there are."""
    n = F.col("n")
    return check_rows(count_rows(findings), [Rule(check_id, n, 0, n == 0, details, otherwise)])


def pct_of(part: Column, total: Column) -> Column:
    return F.when(total > 0, part / total * 100.0).otherwise(0.0)


# Grain, keys and reconciliation

def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups with more than one row; counts are combined before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def key_report(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Primary-key report: rows, rows with a NULL key, duplicated keys."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return groups.agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(has_null, F.col("n"))), F.lit(0)).alias("null_keys"),
        F.count_if(~has_null & (F.col("n") > 1)).alias("duplicate_keys"),
    ).withColumn("valid", (F.col("null_keys") == 0) & (F.col("duplicate_keys") == 0))


def check_keys(table: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    bad = F.col("null_keys") + F.col("duplicate_keys")
    return check_rows(key_report(df, keys, table), [
        Rule(f"K-{table}", bad, 0, bad == 0, "primary key is unique and not null"),
    ])


def all_orphans(facts: Sequence[DataFrame], dim: DataFrame, key: str) -> DataFrame:
    """Keys of any fact without a dimension row."""
    found = [orphans(f, dim, key) for f in facts]
    return reduce(lambda a, b: union_keys(a, b, key), found)


def invalid_codes(df: DataFrame, code: str, pattern: str = CODE_PATTERN) -> DataFrame:
    return df.select(code).filter(~F.col(code).rlike(pattern)).distinct()


def compare_key_counts(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows per key in two layers, for all keys of either; NULL keys are compared too."""
    left = a.groupBy(key).agg(F.count(F.lit(1)).alias("left_rows"), F.lit(0).cast("bigint").alias("right_rows"))
    right = b.groupBy(key).agg(F.lit(0).cast("bigint").alias("left_rows"), F.count(F.lit(1)).alias("right_rows"))
    return (
        left.unionByName(right).groupBy(key)
        .agg(F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows"))
        .withColumn("equal", F.col("left_rows") == F.col("right_rows"))
    )


def check_content(left: DataFrame, right: DataFrame, keys: Sequence[str], check_id: str = "A1-content") -> DataFrame:
    """Two layers hold the same rows; measures the keys that differ."""
    return check_empty(content_differences(left, right, keys), check_id, "content matches between layers")


def check_layers(layers: Mapping[str, tuple[DataFrame, DataFrame]], check_id: str = "A1") -> DataFrame:
    """Row counts of two layers agree for every table."""
    parts = []
    for source, target in layers.values():
        parts += [source.agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("bigint").alias("m")),
                  target.agg(F.lit(0).cast("bigint").alias("n"), F.count(F.lit(1)).alias("m"))]
    tagged = [p.withColumn("t", F.lit(i // 2)) for i, p in enumerate(parts)]
    sums = reduce(DataFrame.unionByName, tagged).groupBy("t").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    unequal = sums.agg(F.count_if(F.col("n") != F.col("m")).alias("unequal"))
    n = F.col("unequal")
    return check_rows(unequal, [Rule(check_id, n, 0, n == 0, "row counts match between layers")])


def pivot_differences(
    long: DataFrame, fact: DataFrame, spec: MarketSpec, measures: Mapping[str, str] | None = None
) -> DataFrame:
    """Cells where the pivoted fact differs from any source value, over all keys and attributes.

    Source cells are reduced to their smallest and largest value first, so colliding rows
    show as a difference. Both sides are stacked and grouped, which replaces a full outer join.
    """
    measures = dict(spec.measures if measures is None else measures)
    cell = [spec.entity, spec.period, spec.attribute]
    source = (
        long.filter(F.col(spec.entity).isNotNull() & F.col(spec.attribute).isin(*measures))
        .select(*cell, F.col(spec.value).alias("source"), F.lit(None).cast("double").alias("pivoted"))
    )
    pivoted = unpivot_measures(fact, spec, measures).select(
        *cell, F.lit(None).cast("double").alias("source"), F.col(spec.value).alias("pivoted")
    )
    cells = source.unionByName(pivoted).groupBy(*cell).agg(
        F.min("source").alias("source_min"), F.max("source").alias("source_max"),
        F.max("pivoted").alias("pivoted"),
    )
    equal = F.col("source_min").eqNullSafe(F.col("pivoted")) & F.col("source_max").eqNullSafe(F.col("pivoted"))
    return cells.filter(~equal)


# Coverage of the wide fact

def coverage_profile(
    fact: DataFrame, population: DataFrame, spec: MarketSpec, since: int
) -> DataFrame:
    """Null counts, period range and population coverage of the fact, in one pass over one join."""
    people = population.select(
        spec.entity, F.col(spec.population_period).alias(spec.period), spec.population
    )
    joined = fact.select(*spec.keys, *spec.core_measures).join(people, spec.keys, "left")
    columns = [*spec.keys, *spec.core_measures, spec.population]
    recent = F.col(spec.period) >= since
    return joined.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns],
        F.min(spec.period).alias("min_period"), F.max(spec.period).alias("max_period"),
        F.count_if(recent).alias("recent_rows"),
        F.count_if(recent & F.col(spec.population).isNotNull()).alias("recent_matched"),
    )


def check_coverage(
    fact: DataFrame,
    population: DataFrame,
    spec: MarketSpec,
    *,
    since: int = 2000,
    starts_by: int = 2010,
    reaches: int = 2020,
    max_null_pct: float = 50.0,
    min_match_pct: float = 90.0,
) -> DataFrame:
    profile = coverage_profile(fact, population, spec, since)
    key_nulls = F.col(f"{spec.entity}_nulls") + F.col(f"{spec.period}_nulls")
    null_pct = pct_of(F.col(f"{spec.consumption}_nulls"), F.col("total_rows"))
    match_pct = pct_of(F.col("recent_matched"), F.col("recent_rows"))
    fact_rows = check_rows(profile, [
        Rule("A4", null_pct, max_null_pct, (key_nulls == 0) & (null_pct <= max_null_pct), "null density of the fact"),
        Rule("A5-fact", F.col("max_period"), reaches,
             (F.col("min_period") <= starts_by) & (F.col("max_period") >= reaches), "period coverage of the fact"),
        Rule("A6", match_pct, min_match_pct, match_pct >= min_match_pct, "population coverage of recent rows"),
    ])
    p = spec.population_period
    ranges = population.agg(F.min(p).alias("lo"), F.max(p).alias("hi"))
    return fact_rows.unionByName(check_rows(ranges, [
        Rule("A5-population", F.col("hi"), reaches,
             (F.col("lo") <= starts_by) & (F.col("hi") >= reaches), "period coverage of the population"),
    ]))


# Business sanity

def balance_gaps(fact: DataFrame, spec: MarketSpec, entities: Sequence | None = None) -> DataFrame:
    """Supply against use in each entity's latest period, with the gap in percent of supply."""
    have = set(fact.columns)
    supply = [c for c in (spec.opening, spec.production, spec.imports, *spec.other_imports) if c in have]
    use = [c for c in (spec.exports, *spec.other_exports, spec.consumption, spec.closing) if c in have]
    rows = fact if entities is None else fact.filter(F.col(spec.entity).isin(*entities))
    sides = rows.select(*spec.keys, sum_of(supply).alias("supply"), sum_of(use).alias("use"))
    latest = sides.groupBy(spec.entity).agg(
        F.max(spec.period).alias(spec.period),
        F.max_by("supply", spec.period).alias("supply"), F.max_by("use", spec.period).alias("use"),
    )
    return latest.withColumn("gap_pct", gap_pct("supply", "use"))


def check_balance(gaps: DataFrame, max_gap: float = 15.0) -> DataFrame:
    worst = F.col("worst")
    return check_rows(gaps.agg(F.max("gap_pct").alias("worst")), [
        Rule("B1", worst, max_gap, worst.isNull() | (worst < max_gap), "balance identity on the latest rows"),
    ])


def formula_agreement(snapshot: DataFrame, spec: MarketSpec, tolerance: float = 0.2) -> DataFrame:
    """Per-capita kilograms from consumption against the value derived back from the bags metric."""
    kg = F.col(spec.consumption) * F.lit(spec.kg_per_unit) / F.col(spec.population)
    back = F.col(PER_CAPITA_BAGS) / 1000.0 * F.lit(spec.kg_per_unit / 1000.0)
    rows = snapshot.filter(F.col(spec.population) > 0).select(
        spec.entity, kg.alias("kg_direct"), back.alias("kg_from_bags")
    )
    off = F.abs(F.col("kg_from_bags") - F.col("kg_direct")) / F.greatest(F.col("kg_direct"), F.lit(0.001))
    return rows.withColumn("agrees", F.coalesce(off <= tolerance, F.lit(True)))


def per_capita_outside(snapshot: DataFrame, bounds: DataFrame, spec: MarketSpec) -> DataFrame:
    """Entities outside half their low and twice their high bound.

    ``bounds`` has (entity, low, high, upper_only); with ``upper_only`` the value must be
    below ``high`` itself.
    """
    joined = lookup_join(formula_agreement(snapshot, spec), bounds, spec.entity, "inner")
    kg = F.col("kg_direct")
    bad = F.when(F.col("upper_only"), kg >= F.col("high")).otherwise(
        (kg < F.col("low") / 2.0) | (kg > F.col("high") * 2.0)
    )
    return joined.filter(bad | ~F.col("agrees"))


def latest_leaders(fact: DataFrame, spec: MarketSpec, measure: str, k: int = 5) -> DataFrame:
    """Top k entities by a measure in the latest period of the fact.

    One pass: rows of the latest period come first in the order, so the k first rows hold
    all that is wanted, and only they are compared with their own latest period.
    """
    first = (
        fact.select(spec.period, spec.entity, measure)
        .orderBy(F.desc(spec.period), F.desc_nulls_last(measure), spec.entity).limit(k)
    )
    latest = F.max(spec.period).over(Window.partitionBy())
    return first.withColumn("_latest", latest).filter(F.col(spec.period) == F.col("_latest")).select(spec.entity, measure)


def check_leads(fact: DataFrame, spec: MarketSpec, check_id: str, entity, measure: str, within: int) -> DataFrame:
    top = latest_leaders(fact, spec, measure, within)
    hit = top.agg(F.count_if(F.col(spec.entity) == F.lit(entity)).alias("n"))
    n = F.col("n")
    return check_rows(hit, [Rule(check_id, n, 1, n >= 1, f"{entity} is in the top {within} by {measure}")])


def trade_gaps(fact: DataFrame, spec: MarketSpec, periods: int = 3) -> DataFrame:
    """Total imports and exports of the latest periods and their gap in percent of imports.

    One pass over the fact; the latest periods are picked from the totals, one row per period.
    """
    have = set(fact.columns)
    imports = [c for c in (spec.imports, *spec.other_imports) if c in have]
    exports = [c for c in (spec.exports, *spec.other_exports) if c in have]
    totals = fact.groupBy(spec.period).agg(
        F.sum(sum_of(imports)).alias("total_imports"), F.sum(sum_of(exports)).alias("total_exports")
    )
    latest = F.max(spec.period).over(Window.partitionBy())
    return (
        totals.withColumn("_latest", latest)
        .filter(F.col(spec.period) > F.col("_latest") - periods)
        .drop("_latest")
        .withColumn("gap_pct", gap_pct("total_imports", "total_exports"))
    )


def trade_gap_stability(gaps: DataFrame) -> DataFrame:
    """Spread of the gaps and whether exports exceed imports in every period."""
    return gaps.agg(
        F.count(F.lit(1)).alias("periods"),
        (F.max("gap_pct") - F.min("gap_pct")).alias("gap_spread"),
        F.coalesce(F.every(F.col("total_exports") > F.col("total_imports")), F.lit(False)).alias("exports_lead"),
    )


def check_trade_gap(gaps: DataFrame, max_spread: float = 10.0) -> DataFrame:
    spread = F.coalesce(F.col("gap_spread"), F.lit(999.0))
    return check_rows(trade_gap_stability(gaps), [
        Rule("B5", spread, max_spread, F.col("exports_lead") & (spread <= max_spread), "trade gap is one-sided and stable"),
    ])


def check_weights_matter(tops: DataFrame, spec: MarketSpec) -> DataFrame:
    n = F.col("distinct_lists")
    return check_rows(distinct_lists(tops, spec), [
        Rule("B6", n, 2, n > 1, "ranking reacts to the weights"),
    ])


def ranking_leaders(snapshot: DataFrame, spec: MarketSpec, direction: str = "highest") -> DataFrame:
    return component_leaders(
        ranking_base(snapshot, spec), spec.entity, component_metrics(spec), direction=direction
    )


def check_no_single_leader(leaders: DataFrame, spec: MarketSpec, limit: int = 3) -> DataFrame:
    n = F.col("n")
    return check_rows(mode(leaders, spec.entity), [
        Rule("B7", n, limit, n < limit, "no entity leads most components"),
    ])


# Snapshot and ranking

def growth_outliers(snapshot: DataFrame, spec: MarketSpec, limit: float = 0.5) -> DataFrame:
    """Rows whose growth is beyond the limit on either side."""
    growth = F.col(cagr_name(spec.lags[0]))
    return snapshot.filter(F.abs(growth) > limit).select(
        spec.entity, spec.name, spec.population, cagr_name(spec.lags[0])
    )


def snapshot_profile(snapshot: DataFrame, spec: MarketSpec, large: float = 50_000_000.0) -> DataFrame:
    """Counts over the snapshot that several checks share."""
    growth = F.col(cagr_name(spec.lags[0]))
    outlier = F.abs(growth) > 0.5
    return snapshot.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(spec.population).alias("with_population"),
        F.count(PER_CAPITA_KG).alias("with_per_capita"),
        F.count_if(outlier).alias("growth_outliers"),
        F.count_if(outlier & (F.coalesce(F.col(spec.population), F.lit(0.0)) > large)).alias("large_outliers"),
    )


def check_snapshot(snapshot: DataFrame, spec: MarketSpec, min_pct: float = 95.0) -> DataFrame:
    pop = pct_of(F.col("with_population"), F.col("total"))
    kg = pct_of(F.col("with_per_capita"), F.col("total"))
    n, large = F.col("growth_outliers"), F.col("large_outliers")
    return check_rows(snapshot_profile(snapshot, spec), [
        Rule("C1", n, 0, n == 0, "no extreme growth", "WARN"),
        Rule("C1-large", large, 0, large == 0, "no extreme growth among large entities", "WARN"),
        Rule("T0-population", pop, min_pct, pop > min_pct, "snapshot population coverage"),
        Rule("T0-per-capita", kg, min_pct, kg > min_pct, "snapshot per-capita coverage"),
    ])


def missing_production(fact: DataFrame, spec: MarketSpec, entities: Sequence, periods: int = 5) -> DataFrame:
    """Rows of core producers in the latest periods without production.

    One pass: totals per period, each with the named producers that lack production in it
    (no more than there are names), and the latest period is taken over these few rows.
    """
    wanted = F.col(spec.entity).isin(*entities) & null_or_zero(spec.production)
    by_period = fact.groupBy(spec.period).agg(
        F.collect_list(F.when(wanted, F.struct(spec.entity, spec.production))).alias("_rows"))
    latest = F.max(spec.period).over(Window.partitionBy())
    recent = by_period.withColumn("_latest", latest).filter(F.col(spec.period) > F.col("_latest") - periods)
    return recent.select(spec.period, F.explode("_rows").alias("_row")).select(
        F.col(f"_row.{spec.entity}").alias(spec.entity), spec.period, F.col(f"_row.{spec.production}").alias(spec.production))


def check_ranking(
    attractiveness: DataFrame, spec: MarketSpec, *, fresh_from: int = 2023, min_spread: float = 0.05
) -> DataFrame:
    """Freshness of the first ten, score spread, missing scores and ties among the first three."""
    attractiveness = written(attractiveness.select(*spec.keys, COMPOSITE))
    top10 = top_k(attractiveness, COMPOSITE, 10, [spec.entity])
    stale = top10.agg(F.count_if(F.col(spec.period) < fresh_from).alias("stale"))
    spread = attractiveness.agg(
        F.coalesce(F.max(COMPOSITE) - F.min(COMPOSITE), F.lit(0.0)).alias("spread"),
        F.count_if(F.col(COMPOSITE).isNull()).alias("missing"),
    )
    top3 = top_k(attractiveness, COMPOSITE, 3, [spec.entity]).agg(F.count_distinct(COMPOSITE).alias("scores"))
    return (
        check_rows(stale, [
            Rule("C4", F.col("stale"), 0, F.col("stale") == 0, "first ten use recent data", "WARN"),
        ]).unionByName(check_rows(spread, [
            Rule("C5", F.col("spread"), min_spread, F.col("spread") > min_spread, "scores are spread out", "WARN"),
            Rule("G6-scores", F.col("missing"), 0, F.col("missing") == 0, "no market without a score"),
        ])).unionByName(check_rows(top3, [
            Rule("F6", F.col("scores"), 3, F.col("scores") >= 3, "first three scores differ", "WARN"),
        ]))
    )


def check_findings(
    findings: DataFrame, check_id: str, details: str, name: str, otherwise: str = "FAIL", show: int = 5
) -> DataFrame:
    """As ``check_empty``, with the first names of the findings in the details."""
    first = findings.select(F.col(name).alias("name")).orderBy("name").limit(show)
    listed = first.agg(F.array_join(F.transform(F.array_sort(F.collect_list("name")), lambda x: x.cast("string")), ", ").alias("names"))
    both = count_rows(findings).withColumn("names", F.lit("")).unionByName(listed.select(F.lit(0).cast("bigint").alias("n"), "names"))
    one = both.agg(F.sum("n").alias("n"), F.max("names").alias("names"))
    status = F.when(F.col("n") == 0, "PASS").otherwise(otherwise)
    shown = F.concat(F.lit(details), F.when(F.col("n") > 0, F.concat(F.lit(": "), "names")).otherwise(""))
    return one.select(F.lit(check_id).alias("check_id"), status.alias("status"), F.col("n").cast("double").alias("measured"),
                      F.lit(0.0).alias("threshold"), shown.alias("details"))


# Load, mapping and cleaning

def check_mapping(counts: DataFrame, min_mapped: int = 70, max_unmapped: int = 15) -> DataFrame:
    """Enough names mapped, few unmapped; input is ``method_counts`` of the mapping."""
    method = F.col("match_method")
    sums = counts.agg(
        F.coalesce(F.sum(F.when(method.isin("manual_override", "exact_match"), F.col("names"))), F.lit(0)).alias("mapped"),
        F.coalesce(F.sum(F.when(method == "unmapped", F.col("names"))), F.lit(0)).alias("unmapped"),
    )
    return check_rows(sums, [
        Rule("M1-mapped", F.col("mapped"), min_mapped, F.col("mapped") >= min_mapped, "mapped names"),
        Rule("M1-unmapped", F.col("unmapped"), max_unmapped, F.col("unmapped") <= max_unmapped, "unmapped names"),
    ])


def check_table(
    prefix: str,
    df: DataFrame,
    *,
    key: str,
    value: str | None = None,
    period: str | None = None,
    min_rows: int = 0,
    max_rows: int | None = None,
    min_keys: int = 0,
    starts_from: int | None = None,
    reaches: int | None = None,
) -> DataFrame:
    """Row count, distinct keys, missing keys and values, and period range, in one aggregate."""
    # Grouping by key first combines the counts per task; a count distinct would not.
    parts = [F.count(F.lit(1)).alias("n")]
    if value:
        parts.append(F.count_if(F.col(value).isNull()).alias("null_values"))
    if period:
        parts += [F.min(period).alias("lo"), F.max(period).alias("hi")]
    total = [F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(key).alias("keys"),
             F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_keys")]
    if value:
        total.append(F.coalesce(F.sum("null_values"), F.lit(0)).alias("null_values"))
    if period:
        total += [F.min("lo").alias("lo"), F.max("hi").alias("hi")]
    n, keys = F.col("n"), F.col("keys")
    in_band = n >= min_rows if max_rows is None else n.between(min_rows, max_rows)
    rules = [
        Rule(f"{prefix}-rows", n, min_rows, in_band, "row count"),
        Rule(f"{prefix}-keys", keys, min_keys, keys >= min_keys, "distinct keys"),
        Rule(f"{prefix}-null-keys", F.col("null_keys"), 0, F.col("null_keys") == 0, "no missing key"),
    ]
    if value:
        rules.append(Rule(f"{prefix}-null-values", F.col("null_values"), 0, F.col("null_values") == 0, "no missing value"))
    if period:
        ok = F.lit(True)
        if starts_from is not None:
            ok = ok & (F.col("lo") >= starts_from)
        if reaches is not None:
            ok = ok & (F.col("hi") >= reaches)
        rules.append(Rule(f"{prefix}-periods", F.col("hi"), reaches or 0, ok, "period range"))
    return check_rows(df.groupBy(key).agg(*parts).agg(*total), rules)


def check_members(members: DataFrame, check_id: str, *, need: str = "all") -> DataFrame:
    """All (or any) of the expected members are present; input is ``expected_members``."""
    n, total = F.col("found"), F.col("total")
    passed = n == total if need == "all" else n >= 1
    sums = members.agg(F.count_if("present").alias("found"), F.count(F.lit(1)).alias("total"))
    return check_rows(sums, [Rule(check_id, n, 1, passed, f"expected members present ({need})")])


def check_any_value(fact: DataFrame, spec: MarketSpec, check_id: str, entity, measure: str, n: int = 5) -> DataFrame:
    """One of the entity's latest n rows has the measure."""
    rows = fact.filter(F.col(spec.entity) == F.lit(entity)).select(spec.period, measure)
    latest = rows.orderBy(F.col(spec.period).desc()).limit(n)
    return check_rows(latest.agg(F.count(measure).alias("n")), [
        Rule(check_id, F.col("n"), 1, F.col("n") >= 1, f"{entity} has recent {measure}"),
    ])


def check_latest_values(
    df: DataFrame, key: str, period: str, value: str, minimums: Mapping[object, float], check_id: str
) -> DataFrame:
    """The latest value of each named entity exceeds its minimum; an entity without rows fails."""
    latest = df.filter(F.col(key).isin(*minimums)).groupBy(key).agg(F.max_by(value, period).alias("v"))
    one = latest.agg(*[F.max(F.when(F.col(key) == F.lit(e), F.col("v"))).alias(f"v{i}") for i, e in enumerate(minimums)])
    return check_rows(one, [
        Rule(f"{check_id}-{e}", F.col(f"v{i}"), low, F.col(f"v{i}") > low, f"latest {value} of {e}")
        for i, (e, low) in enumerate(minimums.items())
    ])


def check_minimums(tables: Mapping[str, tuple[DataFrame, int]], check_id: str) -> DataFrame:
    """Every table or view has at least so many rows."""
    n = F.col("n")
    return union_checks([
        check_rows(count_rows(df), [Rule(f"{check_id}-{name}", n, least, n >= least, f"rows of {name}")])
        for name, (df, least) in tables.items()
    ])


def check_band(df: DataFrame, key: str, entity: object, value: str, low: float, high: float, check_id: str) -> DataFrame:
    """The entity has a row, and its value is within the band."""
    one = df.filter(F.col(key) == F.lit(entity)).agg(F.max(value).alias("v"))
    return check_rows(one, [Rule(check_id, F.col("v"), low, F.col("v").between(low, high), f"{value} of {entity} up to {high:g}")])


def check_any_member(top: DataFrame, key: str, expected: Sequence[object], check_id: str) -> DataFrame:
    """At least one of the expected entities is in a short list."""
    n = F.col("n")
    return check_rows(top.agg(F.count_if(F.col(key).isin(*expected)).alias("n")), [
        Rule(check_id, n, 1, n >= 1, "an expected entity is among the first"),
    ])


def check_references(tables: Mapping[str, DataFrame], codes: DataFrame, key: str, check_id: str) -> DataFrame:
    """Codes of each table that the reference does not have, with the first of them."""
    return union_checks([
        check_findings(orphans(df, codes, key), f"{check_id}-{name}", f"codes of {name} are in the reference", key)
        for name, df in tables.items()
    ])


def check_rose(pair: DataFrame, check_id: str = "G5") -> DataFrame:
    """The latest total exceeds the earlier one; input is ``compare_back``."""
    change = F.max(F.col("latest") - F.col("earlier")).alias("change")
    return check_rows(pair.agg(change), [
        Rule(check_id, F.col("change"), 0, F.col("change") > 0, "total rose over the lag"),
    ])


# Query behaviour

def check_edges(
    ranked: DataFrame, absent_region: DataFrame, single_period: DataFrame, absent_entity: DataFrame
) -> DataFrame:
    """Edge filters: a full ranking, an unknown region, one period, an unknown entity."""
    n = F.col("n")
    return (
        check_rows(count_rows(ranked), [Rule("E1-ranking", n, 1, n >= 1, "no filter gives rows", "WARN")])
        .unionByName(check_rows(count_rows(absent_region), [
            Rule("E1-region", n, 0, n == 0, "an unknown region gives no rows")]))
        .unionByName(check_rows(count_rows(single_period), [
            Rule("E1-period", n, 1, n == 1, "one period gives one row", "WARN")]))
        .unionByName(check_rows(count_rows(absent_entity), [
            Rule("E1-entity", n, 0, n == 0, "an unknown entity gives no rows")]))
    )


def check_range(trends: DataFrame, spec: MarketSpec, wide: tuple[int, int], narrow: tuple[int, int]) -> DataFrame:
    """A wider period range has more rows and starts earlier; both in one pass."""
    p = F.col(spec.period)
    in_wide, in_narrow = p.between(*wide), p.between(*narrow)
    sums = trends.agg(
        F.count_if(in_wide).alias("w"), F.count_if(in_narrow).alias("s"),
        F.min(F.when(in_wide, p)).alias("wp"), F.min(F.when(in_narrow, p)).alias("sp"),
    )
    return check_rows(sums, [
        Rule("T1-rows", F.col("w") - F.col("s"), 0, F.col("w") > F.col("s"), "a wider range has more rows"),
        Rule("T1-start", F.col("sp") - F.col("wp"), 0, F.col("wp") < F.col("sp"), "a wider range starts earlier"),
    ])


def check_region_growth(metrics: DataFrame, spec: MarketSpec, early: int, late: int) -> DataFrame:
    """Regional totals of two periods differ, and their sum grows; both periods in one pass."""
    p, c = F.col(spec.period), F.col(spec.consumption)
    totals = metrics.filter(p.isin(early, late)).groupBy(spec.region).agg(
        F.sum(F.when(p == early, c)).alias("early"), F.sum(F.when(p == late, c)).alias("late")
    )
    sums = totals.agg(
        F.sum("early").alias("early"), F.sum("late").alias("late"),
        F.count_if(~F.col("early").eqNullSafe(F.col("late"))).alias("changed"),
    )
    return check_rows(sums, [
        Rule("T1-total", F.col("late") - F.col("early"), 0, F.col("late") > F.col("early"), "regional total grows"),
        Rule("T1-regions", F.col("changed"), 1, F.col("changed") >= 1, "regional totals change"),
    ])


def check_region_filter(tops: DataFrame, spec: MarketSpec, regions: Mapping[str, str]) -> DataFrame:
    """Scenarios restricted to a region hold only it, the unrestricted one holds more, and no two lists are equal.

    ``regions`` maps scenario -> its region; input is ``region_scenarios``.
    """
    wrong = reduce(lambda a, b: a | b, [
        (F.col("scenario") == s) & ~F.col(spec.region).eqNullSafe(F.lit(r)) for s, r in regions.items()
    ])
    first = next(iter(regions.values()))
    open_rows = ~F.col("scenario").isin(*regions)
    sums = tops.agg(
        F.count_if(wrong).alias("wrong"),
        F.count_if(open_rows & ~F.col(spec.region).eqNullSafe(F.lit(first))).alias("other"),
    )
    lists = distinct_lists(tops, spec)
    return check_rows(sums, [
        Rule("T2-region", F.col("wrong"), 0, F.col("wrong") == 0, "the region filter holds"),
        Rule("T2-open", F.col("other"), 1, F.col("other") >= 1, "without a filter other regions appear"),
    ]).unionByName(check_rows(lists, [
        Rule("T2-lists", F.col("distinct_lists"), len(regions) + 1,
             F.col("distinct_lists") == F.col("scenarios"), "the lists differ by region"),
    ]))


def check_scenarios(
    tops: DataFrame, spec: MarketSpec, *, size: str = "Size-heavy", growth: str = "Growth-heavy",
    expected: Sequence = (),
) -> DataFrame:
    """Every weight scenario gives its own list; growth lifts an entity that size does not."""
    rows = distinct_lists(tops, spec)
    entities = tops.filter(F.col("scenario").isin(size, growth)).groupBy(spec.entity).agg(
        F.count_if(F.col("scenario") == size).alias("in_size"),
        F.count_if(F.col("scenario") == growth).alias("in_growth"),
    )
    lifted = entities.agg(F.count_if((F.col("in_growth") > 0) & (F.col("in_size") == 0)).alias("lifted"),
                          F.count_if((F.col("in_size") > 0) & F.col(spec.entity).isin(*expected)).alias("known"))
    rules = [Rule("T3-lifted", F.col("lifted"), 1, F.col("lifted") >= 1, "growth weights lift another entity")]
    if expected:
        rules.append(Rule("T3-size", F.col("known"), 1, F.col("known") >= 1, "size weights bring a known entity"))
    return check_rows(rows, [
        Rule("T3-lists", F.col("distinct_lists"), 2, F.col("distinct_lists") == F.col("scenarios"),
             "every scenario has its own list"),
    ]).unionByName(check_rows(lifted, rules))


def headline_outside(headlines: DataFrame, bounds: DataFrame, spec: MarketSpec) -> DataFrame:
    """Headline rows below the minimum population or outside the per-capita bounds.

    ``bounds`` has (entity, min_population, low, high).
    """
    joined = lookup_join(headlines, bounds, spec.entity, "inner")
    people, kg = F.col(spec.population), F.col(PER_CAPITA_KG)
    good = (people > F.col("min_population")) & kg.between(F.col("low"), F.col("high"))
    return joined.filter(~F.coalesce(good, F.lit(False)))


def check_headline(headlines: DataFrame, spec: MarketSpec, entity, latest_allowed: int) -> DataFrame:
    """The entity's headline row has a population and is not later than allowed."""
    rows = headlines.filter(F.col(spec.entity) == F.lit(entity)).agg(
        F.max(spec.period).alias("period"), F.count(spec.population).alias("n")
    )
    return check_rows(rows, [
        Rule("T0-headline", F.col("period"), latest_allowed,
             (F.col("n") >= 1) & (F.col("period") <= latest_allowed), "headline row has a population"),
    ])


def series_completeness(metrics: DataFrame, spec: MarketSpec) -> DataFrame:
    """Rows, period range and share of known consumption per entity."""
    return metrics.groupBy(spec.entity).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(spec.period).alias("min_period"), F.max(spec.period).alias("max_period"),
        (F.avg(F.col(spec.consumption).isNotNull().cast("int")) * 100.0).alias("known_pct"),
    )


def check_series(
    completeness: DataFrame, spec: MarketSpec, entity, *, min_rows: int = 50, starts_by: int = 1970,
    reaches: int = 2024, min_known: float = 90.0,
) -> DataFrame:
    one = completeness.filter(F.col(spec.entity) == F.lit(entity)).agg(
        *[F.max(c).alias(c) for c in ("rows", "min_period", "max_period", "known_pct")]
    )
    return check_rows(one, [
        Rule("T5-rows", F.col("rows"), min_rows, F.col("rows") >= min_rows, "series length"),
        Rule("T5-start", F.col("min_period"), starts_by, F.col("min_period") <= starts_by, "series start"),
        Rule("T5-end", F.col("max_period"), reaches, F.col("max_period") >= reaches, "series end"),
        Rule("T5-known", F.col("known_pct"), min_known, F.col("known_pct") >= min_known, "known values"),
    ])


# Rating

def union_checks(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def store_checks(checks: DataFrame, folder: str, build: str) -> None:
    """Keep check rows under the id of a build; rows of other builds stay."""
    checks.write.mode("overwrite").parquet(f"{folder}/build={build}")


def stored_checks(spark: SparkSession, folder: str, build: str | None = None) -> DataFrame:
    """Check rows as stored, of one build or of all."""
    rows = spark.read.parquet(folder).withColumn("build", F.col("build").cast("string"))
    return rows if build is None else rows.filter(F.col("build") == build).drop("build")


def scorecard(checks: DataFrame) -> DataFrame:
    """Counts by status and the confidence they give."""
    by = F.col("status")
    counts = checks.agg(
        F.count_if(by == "PASS").alias("passed"), F.count_if(by == "WARN").alias("warned"),
        F.count_if(by == "FAIL").alias("failed"), F.count(F.lit(1)).alias("total"),
    )
    failed, warned, passed, total = (F.col(c) for c in ("failed", "warned", "passed", "total"))
    return counts.withColumns({
        "confidence": F.when(failed >= 4, "LOW").when((failed > 0) | (warned >= 6), "MEDIUM").otherwise("HIGH"),
        "pass_confidence": F.when(passed == total, "HIGH").when(passed >= total - 2, "MEDIUM").otherwise("LOW"),
    })

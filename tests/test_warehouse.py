import random

import pytest
from pyspark.sql import functions as F

from siftmark.operators.reshape import (
    category_matches,
    choose_attributes,
    pivot_measures,
    pivot_present,
    unpivot_measures,
)
from siftmark.plans import feeds
from siftmark.plans import recommend as rec
from siftmark.plans import warehouse as wh
from siftmark.spec import MarketSpec
from util import SPEC, rows

LONG = "iso3_code string, market_year bigint, attribute_description string, value double"
POPULATION = "iso3_code string, year bigint, population double"
DIM = "iso3_code string, country_name string, region string, sub_region string, continent string"


def test_pivot_edges(spark):
    df = spark.createDataFrame([
        ("A", 2000, "Production", 3.0), ("A", 2000, "Production", 8.0),  # colliding rows: the largest
        ("B", 2000, "Total Supply", 1.0),  # only an attribute that is no measure: the row stays
        ("C", 2000, "Production", None),  # no value at all: the row goes
        (None, 2000, "Production", 1.0),
    ], LONG)
    fact = pivot_measures(df, SPEC)
    assert rows(fact.select("iso3_code", "production", "bean_imports")) == [("A", 8.0, None), ("B", None, None)]
    assert fact.columns == ["iso3_code", "market_year", *SPEC.measure_columns]


def test_pivot_by_preference(spark):
    df = spark.createDataFrame([("A", 1, "Imports", 1.0), ("A", 1, "Production", 2.0)], LONG)
    report = pivot_present(df, SPEC, {"imports": ["Bean Imports", "Imports"], "production": ["Production"], "stocks": ["Ending Stocks"]})
    assert report.kept == {"imports": "Imports", "production": "Production"}
    assert report.dropped == ["stocks"]
    assert rows(report.fact) == [("A", 1, 1.0, 2.0)]


def test_pivot_roundtrip(spark):
    df = spark.createDataFrame([("A", 1, "Production", 2.0), ("A", 1, "Bean Imports", 0.0), ("B", 2, "Production", 1.0)], LONG)
    assert rows(unpivot_measures(pivot_measures(df, SPEC), SPEC, SPEC.measures)) == rows(df)


def test_attribute_choice(spark):
    present = ["Arabica Production", "Production", "Bean Imports", "Imports", "Exports", "Domestic Consumption"]
    assert choose_attributes(present) == {
        "consumption": "Domestic Consumption", "production": "Production", "imports": "Bean Imports", "exports": "Exports",
    }
    with pytest.raises(ValueError):
        choose_attributes(["Production"])
    df = spark.createDataFrame([("A", 1, a, 1.0) for a in present], LONG)
    assert rows(category_matches(df, SPEC, ["imports", "production"])) == [
        ("imports", "Bean Imports"), ("imports", "Imports"), ("production", "Arabica Production"), ("production", "Production"),
    ]


@pytest.fixture(scope="module")
def warehouse(spark):
    """Entities with gaps, zeros, missing populations and missing dimension rows."""
    rng = random.Random(11)
    long, people, dims = [], [], []
    names = list(SPEC.measures)
    for n in range(60):
        e = f"E{n:02d}"
        if n % 20 != 19:
            region = None if n % 9 == 0 else ["Asia", "Africa", "Europe"][n % 3]
            dims.append((e, f"Name {e}", region, None, region))
        for year in range(2005, 2026):
            if rng.random() < 0.15:
                continue
            for a in names:
                if rng.random() < 0.8:
                    long.append((e, year, a, rng.choice([0.0, float(rng.randrange(1, 5000))])))
            if year <= 2024 and rng.random() < 0.9:
                people.append((e, year, float(rng.randrange(1, 50)) * 1e6))
    return (
        pivot_measures(spark.createDataFrame(long, LONG), SPEC),
        spark.createDataFrame(dims, DIM), spark.createDataFrame(people, POPULATION),
    )


def test_snapshot_straight_from_facts_equals_the_view(spark, warehouse):
    fact, dim, population = warehouse
    view = wh.latest_snapshot(wh.entity_period_metrics(fact, dim, population, SPEC), SPEC)
    direct = wh.market_snapshot(fact, dim, population, SPEC)
    assert direct.columns == view.columns
    assert rows(direct) == rows(view)


def test_snapshot_period(spark):
    fact = spark.createDataFrame(
        [("A", 2023, 1.0), ("A", 2024, 2.0), ("A", 2025, 3.0), ("Z", 2020, 0.0)], "iso3_code string, market_year bigint, domestic_consumption double"
    ).withColumns({c: F.lit(None).cast("double") for c in ("production", "bean_imports", "bean_exports")})
    dim = spark.createDataFrame([("A", "a", "R", None, "R"), ("Z", "z", "R", None, "R")], DIM)
    population = spark.createDataFrame([("A", y, 10.0) for y in (2023, 2024)] + [("Z", 2020, 5.0)], POPULATION)
    snapshot = wh.market_snapshot(fact, dim, population, SPEC)
    assert rows(snapshot.select("iso3_code", "market_year", "consumption_cagr_5y")) == [("A", 2024, None), ("Z", 2020, None)]
    ranked = wh.market_attractiveness(snapshot, SPEC)
    assert [r.iso3_code for r in ranked.collect()] == ["A"]  # zero consumption is not ranked


@pytest.fixture(scope="module")
def snapshot(warehouse):
    fact, dim, population = warehouse
    return wh.market_snapshot(fact, dim, population, SPEC).cache()


def test_region_filter(snapshot):
    every = rec.recommend(snapshot, SPEC, k=1000)
    asia = rec.recommend(snapshot, SPEC, regions=["Asia"], k=1000)
    known = rec.recommend(snapshot, SPEC, regions=["Asia", "Africa", "Europe"], k=1000)
    assert {r.region for r in asia.collect()} == {"Asia"}
    asia_names = {r.iso3_code for r in asia.collect()}
    assert asia_names < {r.iso3_code for r in known.collect()} < {r.iso3_code for r in every.collect()}
    assert known.filter("region IS NULL").count() == 0 < every.filter("region IS NULL").count()
    assert rec.recommend(snapshot, SPEC, regions=[]).count() == 0
    # The ranks are those of the filtered set
    assert asia.agg(F.min("size_score"), F.max("size_score")).first() == (0.0, 1.0)


def test_weights(snapshot):
    assert rec.normalise_weights((0, 0, 0, 0)) == (0, 0, 0, 0)
    order = lambda w: [r.iso3_code for r in rec.recommend(snapshot, SPEC, weights=w).collect()]
    assert order((2, 2, 2, 2)) == order((0.25,) * 4)
    zero = rec.recommend(snapshot, SPEC, weights=(0, 0, 0, 0)).collect()
    assert {r.composite_score for r in zero} == {0.0}
    assert [r.iso3_code for r in zero] == sorted(r.iso3_code for r in zero)


def test_scenarios_equal_single_recommendations(snapshot):
    from siftmark.spec import WEIGHT_SCENARIOS

    tops = rec.weight_scenarios(snapshot, SPEC).collect()
    for name, weights in WEIGHT_SCENARIOS.items():
        got = [r.iso3_code for r in sorted(tops, key=lambda r: r.position) if r.scenario == name]
        assert got == [r.iso3_code for r in rec.recommend(snapshot, SPEC, weights=weights, k=3).collect()]
    regions = rec.region_scenarios(snapshot, SPEC, {"all": None, "asia": ["Asia"]}).collect()
    got = [r.iso3_code for r in sorted(regions, key=lambda r: r.position) if r.scenario == "asia"]
    assert got == [r.iso3_code for r in rec.recommend(snapshot, SPEC, regions=["Asia"], k=3).collect()]


def test_cards_need_three_markets(snapshot):
    top = rec.recommend(snapshot, SPEC)
    assert [r.position for r in rec.recommendation_cards(top, SPEC).collect()] == [1, 2, 3]
    assert rec.recommendation_cards(top.limit(2), SPEC).count() == 0
    assert rec.display_table(top, SPEC).count() == 20


def test_trends(spark, warehouse):
    fact, dim, population = warehouse
    trends = wh.global_trends(fact, SPEC)
    assert trends.filter("market_year = 2025").first().reporting_countries > 0
    wide, narrow = feeds.trend_range(trends, SPEC, 2010, 2025), feeds.trend_range(trends, SPEC, 2020, 2025)
    assert {r.market_year for r in narrow.collect()} < {r.market_year for r in wide.collect()}
    row = feeds.endpoint_growth(trends, SPEC, 2010, 2020).first()
    totals = {r.market_year: r.total_consumption for r in trends.collect()}
    assert row.growth_pct == pytest.approx(((totals[2020] / totals[2010]) ** (1 / 10) - 1) * 100)
    assert feeds.endpoint_growth(trends, SPEC, 2020, 2020).count() == 0
    metrics = wh.entity_period_metrics(fact, dim, population, SPEC)
    known = feeds.region_totals(metrics, SPEC, 2020)
    unknown = feeds.region_totals(metrics, SPEC, 2020, keep_unknown=True)
    assert {r.region for r in unknown.collect()} - {r.region for r in known.collect()} == {None}


def test_endpoint_growth_is_zero_when_undefined(spark):
    trends = spark.createDataFrame(
        [(2000, 0.0, 1), (2001, 5.0, 2)], "market_year bigint, total_consumption double, reporting_countries bigint"
    )
    row = feeds.endpoint_growth(trends, SPEC, 2000, 2001).first()
    assert (row.growth_pct, row.reporting_countries) == (0.0, 2)


def test_other_column_names(spark):
    """Roles are arguments: the same operators on another table layout."""
    spec = MarketSpec(entity="k", period="t", attribute="a", value="v", measures={"x": "consumption"}, consumption="consumption")
    df = spark.createDataFrame([(1, 5, "x", 2.0)], "k int, t int, a string, v double")
    assert rows(pivot_measures(df, spec)) == [(1, 5, 2.0)]

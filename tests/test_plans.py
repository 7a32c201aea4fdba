"""Shapes of the physical plans that matter at scale."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from siftmark.catalog import inputs as bind
from siftmark.catalog.queries import QUERIES
from siftmark.operators import latest
from siftmark.operators.joins import lookup_join
from siftmark.operators.reshape import pivot_measures
from siftmark.plans import audit, feeds
from siftmark.plans import recommend as rec
from siftmark.plans import warehouse as wh
from util import plan

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def supplier(spark):
    return bind.supplier_inputs(spark, SF_DIR)


def test_pivot_reads_its_columns_and_combines_before_the_shuffle(supplier):
    text = plan(supplier.fact)
    assert "partial_max" in text and text.count("Exchange") == text.count("hashpartitioning") == 1
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double,l_returnflag:string,l_linestatus:string,l_shipdate" in text


def test_entity_filter_reaches_the_scan(supplier):
    metrics = wh.entity_period_metrics(supplier.fact, supplier.dim, supplier.population, supplier.spec)
    assert "EqualTo(l_suppkey,7)" in plan(feeds.entity_series(metrics, supplier.spec, 7))


def test_snapshot_uses_one_exchange_for_growth_and_latest_period(supplier):
    i = supplier
    series = wh._latest_with_growth(wh._with_population(i.fact, i.population, i.spec), i.spec)
    by_entity_only = [x for x in plan(series).splitlines() if "hashpartitioning" in x and "period" not in x]
    assert len(by_entity_only) == 1


def test_snapshot_joins_names_after_the_series_are_reduced(supplier):
    i = supplier
    text = plan(wh.market_snapshot(i.fact, i.dim, i.population, i.spec))
    above_windows = text[: text.index("Window")]
    assert "BroadcastHashJoin [entity_key" in above_windows and "Inner" in above_windows


def test_large_ranking_has_no_single_task(supplier):
    i = supplier
    snapshot = wh.market_snapshot(i.fact, i.dim, i.population, i.spec)
    assert "SinglePartition" not in plan(wh.market_attractiveness(snapshot, i.spec))


def test_top_lists_are_limited_before_the_shuffle(supplier):
    i = supplier
    snapshot = wh.market_snapshot(i.fact, i.dim, i.population, i.spec)
    assert "WindowGroupLimit" in plan(rec.weight_scenarios(snapshot, i.spec))
    assert "WindowGroupLimit" in plan(QUERIES["latest_n_rows"](i.fact.sparkSession, SF_DIR))
    assert "TakeOrderedAndProject" in plan(rec.recommend(snapshot, i.spec))
    leaders = plan(audit.latest_leaders(i.fact, i.spec, "production"))
    assert "TakeOrderedAndProject" in leaders and leaders.count("FileScan") == 1
    assert "WindowGroupLimit" in plan(latest.headline_rows(i.fact, "entity_key", "period", "production"))
    assert plan(audit.trade_gaps(i.fact, i.spec)).count("FileScan") == 1


def test_no_cartesian_products(spark):
    for name in ("weight_scenarios", "region_scenarios", "trade_gaps", "expected_members", "headline_outside"):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_lookup_join_reads_each_input_once(spark):
    """No hint, no job and no second read, whatever the size of the lookup."""
    facts = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    for size in (10, 10_000_000_000):
        lookup = spark.range(size).select(F.col("id").alias("k"), F.lit("v").alias("v"))
        text = plan(lookup_join(facts, lookup, "k"))
        assert text.count("Range (") == 2 and text.count("Join") == 1


def test_hot_entity_is_combined_before_the_shuffle(spark):
    """One entity with a third of all rows leaves each map task as one row per period."""
    long = spark.range(0, 30_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("entity_key"),
        (F.col("id") % 12).alias("period"), F.lit("A/F").alias("attribute"), F.col("id").cast("double").alias("value"),
    )
    fact = pivot_measures(long, bind.SUPPLIER)
    assert fact.filter("entity_key = -1").count() <= 12
    assert "HashAggregate" in plan(fact)

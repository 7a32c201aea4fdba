"""The given tables in the roles of a market-screening feed.

=========  ===========================  ==================  ==========================
binding    entity / period              attribute           population
=========  ===========================  ==================  ==========================
nation     nation of the customer/year  order priority      ordering customers
balance    nation of the customer/year  priority and status ordering customers
supplier   supplier/month               return and status   lines shipped
customer   customer/year                order priority      orders placed
=========  ===========================  ==================  ==========================

Populations and facts cover every period of their tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftmark.operators.reshape import pivot_measures
from siftmark.spec import MarketSpec

_COLUMNS = dict(
    entity="entity_key", name="entity_name", period="period", attribute="attribute",
    value="value", unit="unit", population_period="census_period",
    consumption="consumption", production="production", imports="imports", exports="exports",
    opening="opening_stocks", closing="closing_stocks",
    other_imports=("roast_imports", "soluble_imports"),
    other_exports=("roast_exports", "soluble_exports"),
    net_imports="net_imports", total_imports="total_imports", total_exports="total_exports",
    reporting="reporting_entities", region_members="entities",
)

PRIORITY_MEASURES = {
    "1-URGENT": "consumption", "2-HIGH": "production", "3-MEDIUM": "imports",
    "4-NOT SPECIFIED": "exports", "5-LOW": "closing_stocks",
}
BALANCE_MEASURES = {
    "1-URGENT/F": "consumption", "1-URGENT/O": "production", "2-HIGH/F": "imports",
    "2-HIGH/O": "exports", "3-MEDIUM/F": "closing_stocks", "3-MEDIUM/O": "opening_stocks",
    "4-NOT SPECIFIED/F": "roast_imports", "4-NOT SPECIFIED/O": "roast_exports",
    "5-LOW/F": "soluble_imports", "5-LOW/O": "soluble_exports",
}
FLAG_MEASURES = {
    "A/F": "consumption", "A/O": "production", "N/F": "imports",
    "N/O": "exports", "R/F": "closing_stocks", "R/O": "opening_stocks",
}

NATION = MarketSpec(**_COLUMNS, measures=PRIORITY_MEASURES)
BALANCE = MarketSpec(**_COLUMNS, measures=BALANCE_MEASURES)
SUPPLIER = MarketSpec(**_COLUMNS, measures=FLAG_MEASURES)
CUSTOMER = MarketSpec(**_COLUMNS, measures=PRIORITY_MEASURES, lags=(1, 3))


@dataclass
class Inputs:
    spec: MarketSpec
    long: DataFrame
    dim: DataFrame
    population: DataFrame
    entities: DataFrame

    @property
    def fact(self) -> DataFrame:
        return pivot_measures(self.long, self.spec)


# Stated, so that no job has to read file footers before a query is planned.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def year(c: str) -> Column:
    return F.year(c).cast("bigint")


def month(c: str) -> Column:
    return (F.year(c) * 12 + F.month(c)).cast("bigint")


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey)


def nation_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regions(spark, sf_dir).select(
        F.col("n_nationkey").cast("bigint").alias("entity_key"), F.col("n_name").alias("entity_name"),
        F.col("r_name").alias("region"), F.lit(None).cast("string").alias("sub_region"),
        F.col("r_name").alias("continent"),
    )


def _orders_by_nation(spark: SparkSession, sf_dir: str, attribute: Column) -> DataFrame:
    """Orders summed per customer first, so that a customer with very many orders is no hot join key."""
    sums = table(spark, sf_dir, "orders").groupBy(
        "o_custkey", year("o_orderdate").alias("period"), attribute.alias("attribute")
    ).agg(F.sum("o_totalprice").alias("value"))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("bigint").alias("entity_key")
    )
    return sums.join(customers, "o_custkey")


def _nation_inputs(spark: SparkSession, sf_dir: str, spec: MarketSpec, attribute: Column) -> Inputs:
    per_customer = _orders_by_nation(spark, sf_dir, attribute)
    long = per_customer.groupBy("entity_key", "period", "attribute").agg(
        F.round(F.sum("value"), 2).alias("value")
    ).withColumn("unit", F.lit("price"))
    population = (
        per_customer.groupBy("entity_key", F.col("period").alias("census_period"))
        .agg(F.count_distinct("o_custkey").cast("double").alias("population"))
    )
    return Inputs(spec, long, nation_dim(spark, sf_dir), population, table(spark, sf_dir, "nation"))


def nation_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return _nation_inputs(spark, sf_dir, NATION, F.col("o_orderpriority"))


def balance_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return _nation_inputs(
        spark, sf_dir, BALANCE, F.concat_ws("/", "o_orderpriority", "o_orderstatus")
    )


def supplier_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """Line items as they are: several rows may share (entity, period, attribute), and the pivot takes the largest."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("entity_key"), month("l_shipdate").alias("period"),
        F.concat_ws("/", "l_returnflag", "l_linestatus").alias("attribute"),
        F.col("l_extendedprice").alias("value"), F.lit("price").alias("unit"),
    )
    dim = table(spark, sf_dir, "supplier").join(
        _regions(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")
    ).select(
        F.col("s_suppkey").alias("entity_key"), F.col("s_name").alias("entity_name"),
        F.col("r_name").alias("region"), F.col("n_name").alias("sub_region"),
        F.col("r_name").alias("continent"),
    )
    population = (
        lines.groupBy("entity_key", F.col("period").alias("census_period"))
        .agg(F.count(F.lit(1)).cast("double").alias("population"))
    )
    return Inputs(SUPPLIER, lines, dim, population, table(spark, sf_dir, "supplier"))


def customer_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """Orders as they are; customers of one market segment have no region."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("entity_key"), year("o_orderdate").alias("period"),
        F.col("o_orderpriority").alias("attribute"), F.col("o_totalprice").alias("value"),
        F.lit("price").alias("unit"),
    )
    region = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("r_name"))
    dim = table(spark, sf_dir, "customer").join(
        _regions(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(
        F.col("c_custkey").alias("entity_key"), F.col("c_name").alias("entity_name"),
        region.alias("region"), F.col("n_name").alias("sub_region"), region.alias("continent"),
    )
    population = (
        orders.groupBy("entity_key", F.col("period").alias("census_period"))
        .agg(F.count(F.lit(1)).cast("double").alias("population"))
    )
    return Inputs(CUSTOMER, orders, dim, population, table(spark, sf_dir, "customer"))

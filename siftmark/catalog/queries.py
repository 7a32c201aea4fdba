"""Registered queries: each reads whole tables of ``sf_dir`` and returns a lazy DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftmark.catalog import inputs as bind
from siftmark.catalog.inputs import Inputs
from siftmark.functions.columns import contains_any
from siftmark.operators import latest, setops, topk
from siftmark.operators import profile as profiles
from siftmark.operators.content import content_differences
from siftmark.operators.growth import cagr_name, growth_metrics
from siftmark.operators.joins import lookup_join
from siftmark.operators.latest import compare_back
from siftmark.operators.profile import attribute_profile
from siftmark.operators.rank import percent_ranks
from siftmark.operators.reconcile import method_counts, name_mapping
from siftmark.operators.reshape import attributes_present, category_matches, choose_attributes, pivot_present
from siftmark.plans import audit, feeds
from siftmark.plans import recommend as rec
from siftmark.plans import warehouse as wh
from siftmark.plans.build import RawFiles, build, current_views
from siftmark.sources.readers import FILE_ORDER, block_bytes, read_csv, read_csv_after_preamble, read_table, setting
from siftmark.sources.scratch import scratch_folder, written
from siftmark.sources.writers import export_tables, normalise_for_export, register_views, write_profile
from siftmark.spec import SUSPICIOUS_TOKENS, MarketSpec

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def round_growth(df: DataFrame, spec: MarketSpec) -> DataFrame:
    """Growth rounded as in the SQL counterpart: powers differ in the last digit between engines."""
    return df.withColumns({cagr_name(n): F.round(cagr_name(n), 9) for n in spec.lags})


def metrics_of(i: Inputs) -> DataFrame:
    return wh.entity_period_metrics(i.fact, i.dim, i.population, i.spec)


def snapshot_of(i: Inputs) -> DataFrame:
    snapshot = wh.market_snapshot(i.fact, i.dim, i.population, i.spec)
    return round_growth(snapshot, i.spec)


def round_score(df: DataFrame) -> DataFrame:
    return df.withColumn(wh.COMPOSITE, F.round(wh.COMPOSITE, 9))


# Ranking

@query
def top_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.nation_inputs(spark, sf_dir)
    scored = round_score(wh.market_attractiveness(snapshot_of(i), i.spec))
    return wh.top_candidates(scored, i.spec)


@query
def market_attractiveness(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.customer_inputs(spark, sf_dir)
    return round_score(wh.market_attractiveness(snapshot_of(i), i.spec))


@query
def market_attractiveness_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ranking; kept under its name from when small sets were ranked apart."""
    i = bind.customer_inputs(spark, sf_dir)
    return round_score(wh.market_attractiveness(snapshot_of(i), i.spec))


@query
def percent_rank_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks of every line item: one metric with few ties, two with very many."""
    lines = bind.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount"
    )
    ranked = percent_ranks(
        lines, {"price_rank": "l_extendedprice", "quantity_rank": "l_quantity", "discount_rank": "l_discount"},
    )
    return ranked.withColumns({c: F.round(c, 9) for c in ("price_rank", "quantity_rank", "discount_rank")})


@query
def recommend_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.customer_inputs(spark, sf_dir)
    return round_score(rec.recommend(
        snapshot_of(i), i.spec, regions=["ASIA", "EUROPE"], weights=(2.0, 1.0, 1.0, 0.0)
    ))


def scenario_tops(i: Inputs) -> DataFrame:
    return rec.weight_scenarios(snapshot_of(i), i.spec)


@query
def weight_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_score(scenario_tops(bind.customer_inputs(spark, sf_dir)))


@query
def scenario_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.customer_inputs(spark, sf_dir)
    return rec.ranked_lists(scenario_tops(i), i.spec)


@query
def scenario_distinct_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.customer_inputs(spark, sf_dir)
    return rec.distinct_lists(scenario_tops(i), i.spec)


REGION_CHOICES = {"all": None, "asia": ["ASIA"], "africa": ["AFRICA"]}


def region_tops(i: Inputs) -> DataFrame:
    return rec.region_scenarios(snapshot_of(i), i.spec, REGION_CHOICES)


@query
def region_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_score(region_tops(bind.customer_inputs(spark, sf_dir)))


@query
def component_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.customer_inputs(spark, sf_dir)
    return audit.ranking_leaders(snapshot_of(i), i.spec)


@query
def component_leaders_lowest(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.customer_inputs(spark, sf_dir)
    return audit.ranking_leaders(snapshot_of(i), i.spec, "lowest")


@query
def recommend_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.nation_inputs(spark, sf_dir)
    top = rec.recommend(snapshot_of(i), i.spec)
    return rec.recommendation_cards(top, i.spec, {"NATION_7": "A note of its own."})


@query
def display_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.customer_inputs(spark, sf_dir)
    return rec.display_table(rec.recommend(snapshot_of(i), i.spec), i.spec)


# Facts and views

@query
def pivot_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind.supplier_inputs(spark, sf_dir).fact


@query
def pivot_generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pivot by preference lists; one measure has no attribute in the data and is left out."""
    i = bind.balance_inputs(spark, sf_dir)
    targets = {
        "consumption": ["0-ABSENT", "1-URGENT/F"], "production": ["1-URGENT/O"],
        "re_exports": ["9-ABSENT/F"], "pending": ["1-URGENT/P", "2-HIGH/P"],
    }
    return pivot_present(i.long, i.spec, targets).fact


@query
def entity_period_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics_of(bind.supplier_inputs(spark, sf_dir))


@query
def growth_metrics_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.nation_inputs(spark, sf_dir)
    return round_growth(growth_metrics(i.fact, i.spec), i.spec)


@query
def growth_metrics_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.supplier_inputs(spark, sf_dir)
    return round_growth(growth_metrics(i.fact, i.spec), i.spec)


@query
def growth_exact_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.supplier_inputs(spark, sf_dir)
    return round_growth(growth_metrics(i.fact, i.spec, exact_period=True), i.spec)


@query
def snapshot_from_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot taken from the metrics view, as a user of a stored view would."""
    i = bind.supplier_inputs(spark, sf_dir)
    return round_growth(wh.latest_snapshot(metrics_of(i), i.spec), i.spec)


@query
def snapshot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_of(bind.supplier_inputs(spark, sf_dir))


TOTALS = ("total_consumption", "total_production", "total_imports", "total_exports")


def trends_of(i: Inputs) -> DataFrame:
    return wh.global_trends(i.fact, i.spec).withColumns({c: F.round(c, 2) for c in TOTALS})


@query
def global_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends_of(bind.supplier_inputs(spark, sf_dir)).orderBy("period")


@query
def trend_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.nation_inputs(spark, sf_dir)
    rows = feeds.trend_range(trends_of(i), i.spec, 1997, 2001)
    return rows.withColumns({c: F.round(c, 5) for c in ("consumption_thousands", "production_thousands")})


@query
def overview_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.nation_inputs(spark, sf_dir)
    row = feeds.endpoint_growth(trends_of(i), i.spec, 1995, 2000)
    return row.withColumns({"latest_thousands": F.round("latest_thousands", 5), "growth_pct": F.round("growth_pct", 7)})


@query
def overview_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.nation_inputs(spark, sf_dir)
    return feeds.kpi_cards(overview_kpi(spark, sf_dir), i.spec)


@query
def trend_vs_five_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.nation_inputs(spark, sf_dir)
    return compare_back(trends_of(i), i.spec.period, "total_consumption", 5)


@query
def region_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.customer_inputs(spark, sf_dir)
    totals = feeds.region_totals(metrics_of(i), i.spec, 2000)
    return totals.withColumn("total_consumption", F.round("total_consumption", 2)).orderBy(F.desc("total_consumption"))


@query
def region_totals_with_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.customer_inputs(spark, sf_dir)
    totals = feeds.region_totals(metrics_of(i), i.spec, 2000, keep_unknown=True)
    return totals.withColumn("total_consumption", F.round("total_consumption", 2))


@query
def comparison_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.customer_inputs(spark, sf_dir)
    return feeds.comparison_feed(snapshot_of(i), i.spec, ["ASIA", "AMERICA", "AFRICA"])


@query
def headline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.customer_inputs(spark, sf_dir)
    return latest.headline_rows(metrics_of(i), i.spec.entity, i.spec.period, i.spec.population)


@query
def deep_dive_headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.supplier_inputs(spark, sf_dir)
    return feeds.deep_dive_headlines(metrics_of(i), i.spec)


@query
def entity_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.supplier_inputs(spark, sf_dir)
    return feeds.entity_series(metrics_of(i), i.spec, 7).orderBy("period")


@query
def opportunity_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.supplier_inputs(spark, sf_dir)
    return feeds.opportunity_lines(snapshot_of(i), i.spec)


@query
def selector_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the controls offer: regions, entities and the period bounds."""
    i = bind.customer_inputs(spark, sf_dir)
    regions = feeds.region_choices(i.dim, i.spec).select(F.lit("region").alias("control"), F.col("region").alias("choice"))
    entities = feeds.entity_choices(snapshot_of(i), i.spec).select(F.lit("entity"), F.col("entity_name"))
    bounds = feeds.period_bounds(i.fact, i.spec).select(
        F.lit("period"), F.concat_ws("-", F.col("first_period"), F.col("last_period"))
    )
    return regions.union(entities).union(bounds)


@query
def latest_n_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.supplier_inputs(spark, sf_dir)
    return latest.latest_n(i.fact, i.spec.entity, i.spec.period, 3)


@query
def top_n_nulls_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.supplier_inputs(spark, sf_dir)
    return audit.latest_leaders(i.fact, i.spec, "production", 5)


@query
def sparsest_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.customer_inputs(spark, sf_dir)
    return topk.sparsest(i.fact, i.spec.entity)


@query
def abs_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.supplier_inputs(spark, sf_dir)
    found = audit.growth_outliers(snapshot_of(i), i.spec, 0.05)
    return found.orderBy(F.abs(cagr_name(5)).desc(), "entity_key")


@query
def sampled_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.sample_keys(bind.table(spark, sf_dir, "orders"), "o_custkey", 3)


@query
def unordered_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any ten rows; which ones is left open, so they are counted."""
    return audit.count_rows(bind.table(spark, sf_dir, "orders").limit(10))


# Cleaning and reconciliation

ALIASED = (2, 7, 12, 17, 22)
PADDED = (0, 5, 10, 15, 20)
OVERRIDES = {f"Alias NATION_{k}": f"N{k:02d}" for k in ALIASED}
EXCLUDED = ("World",)


def reference_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation codes with the headers of a raw code file."""
    return bind.table(spark, sf_dir, "nation").select(
        F.format_string("N%02d", "n_nationkey").alias("ISO3 CODE"),
        F.format_string("%02d", "n_nationkey").alias("ISO2 CODE"),
        F.concat(F.lit(" "), "n_name").alias("LABEL EN"),
    )


def raw_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text row per order, with the nation named as sources tend to: padded, lower-cased, by an alias,
    as an aggregate, or by an unknown name."""
    key = F.col("c_nationkey")
    nation = F.concat(F.lit("NATION_"), key)
    name = (
        F.when(key.isin(3, 8), "World")
        .when(key == 4, "Nowhere")
        .when(key.isin(*ALIASED), F.concat(F.lit("Alias "), nation))
        .when(key.isin(*PADDED), F.concat(F.lit("  "), F.lower(nation), F.lit(" ")))
        .otherwise(nation)
    )
    customers = bind.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), name.alias("Country_Name")
    )
    orders = bind.table(spark, sf_dir, "orders")
    bad_value = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    rows = lookup_join(orders, customers, "o_custkey", "inner")
    return rows.select(
        "Country_Name",
        F.year("o_orderdate").cast("string").alias("Market_Year"),
        F.substring("o_orderpriority", 1, 1).alias("Attribute_ID"),
        F.col("o_orderpriority").alias("Attribute_Description"),
        F.when(bad_value, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("Value"),
        F.lit("(1000 UNITS)").alias("Unit_Description"),
    )


def cleaned_long(raw: DataFrame, codes: DataFrame, order: str | Column = "ISO3 CODE") -> DataFrame:
    return wh.clean_long_fact(raw, wh.code_labels(codes, order), RAW, overrides=OVERRIDES, excluded=EXCLUDED)


RAW = MarketSpec()


@query
def clean_long_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned_long(raw_long(spark, sf_dir), reference_codes(spark, sf_dir))


@query
def name_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_mapping(
        raw_long(spark, sf_dir), "Country_Name", wh.code_labels(reference_codes(spark, sf_dir), "ISO3 CODE"),
        overrides=OVERRIDES, excluded=EXCLUDED,
    )


@query
def mapping_method_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return method_counts(name_reconciliation(spark, sf_dir))


@query
def attribute_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes that match a category word, and the one chosen for each category."""
    long = bind.table(spark, sf_dir, "orders").select(
        F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("attribute")
    )
    words = {"urgent": ("1-URGENT X", "1-URGENT O", "1-URGENT F"), "low": ("5-LOW P",)}
    chosen = choose_attributes(attributes_present(long, bind.NATION, [a for names in words.values() for a in names]), words)
    matches = category_matches(long, bind.NATION, list(words))
    picked = F.create_map(*[F.lit(x) for item in chosen.items() for x in item])
    return matches.withColumn("chosen", F.col("attribute") == picked[F.col("category")])


@query
def dim_region_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = bind.table(spark, sf_dir, "customer")
    codes = customer.select(
        F.col("c_custkey").cast("string").alias("iso3_code"), F.col("c_name").alias("english_name"),
        F.substring("c_mktsegment", 1, 2).alias("iso2_code"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_mktsegment")).alias("region"),
        F.lit("").alias("sub_region"),
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise("X").alias("continent"),
    )
    i = bind.customer_inputs(spark, sf_dir)
    lookup = i.dim.filter(F.col("continent") != "EUROPE").select(
        F.col("entity_key").cast("string").alias("iso3_code"), "continent"
    )
    return wh.dim_entity(codes, RAW, lookup)


def wide_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per customer as text, one column per year that has an order."""
    orders = bind.table(spark, sf_dir, "orders").select("o_custkey", bind.year("o_orderdate").alias("y"))
    years = sorted(r.y for r in orders.select("y").distinct().collect() if r.y is not None)
    wide = orders.groupBy("o_custkey").agg(*[F.count_if(F.col("y") == y).alias(str(y)) for y in years])
    return wide.select(
        F.concat(F.lit("Customer "), F.col("o_custkey")).alias("Country Name"),
        F.col("o_custkey").cast("string").alias("Country Code"), F.lit("orders").alias("Indicator"),
        *[F.when(F.col(str(y)) > 0, F.col(str(y)).cast("string")).alias(str(y)) for y in years],
    )


def automobile_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = bind.table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "AUTOMOBILE")
    return customer.select(F.col("c_custkey").cast("string").alias("iso3_code"))


@query
def unpivot_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide to long, kept for the customers of one market segment (the valid codes)."""
    return wh.clean_population(wide_population(spark, sf_dir), automobile_codes(spark, sf_dir), RAW)


@query
def csv_roundtrip_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the three raw files as CSV, read them as raw sources, clean them, and total them per entity."""
    folder = scratch_folder(spark)
    raw_long(spark, sf_dir).write.option("header", True).csv(f"{folder}/long")
    reference_codes(spark, sf_dir).write.option("header", True).option("sep", ";").csv(f"{folder}/codes")
    wide = wide_population(spark, sf_dir)
    wide.write.csv(f"{folder}/wide/rows")
    header = ",".join(f'"{c}"' for c in wide.columns)
    preamble = ['"Data Source","Orders"', " ", '"Last Updated","2001"', " ", header]
    spark.createDataFrame([(x,) for x in preamble], "value string").coalesce(1).write.text(f"{folder}/wide/head")

    codes = read_csv(spark, f"{folder}/codes", sep=";", ordered=True)
    long = cleaned_long(read_csv(spark, f"{folder}/long"), codes, F.struct(*FILE_ORDER))
    population = wh.clean_population(
        read_csv_after_preamble(spark, f"{folder}/wide/*", header_path=f"{folder}/wide/head"),
        automobile_codes(spark, sf_dir), RAW,
    )
    parts = [
        wh.clean_codes(codes).groupBy("iso3_code").agg(F.count(F.lit(1)).alias("rows"), F.lit(0.0).alias("total"))
        .withColumn("source", F.lit("codes")),
        long.groupBy("iso3_code").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("value"), 2).alias("total"))
        .withColumn("source", F.lit("long")),
        population.groupBy("iso3_code").agg(F.count(F.lit(1)).alias("rows"), F.sum("population").alias("total"))
        .withColumn("source", F.lit("population")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def label_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each label has a code in a small first file and another in a larger second one, which wins."""
    folder = scratch_folder(spark)
    codes, suppliers = reference_codes(spark, sf_dir), bind.table(spark, sf_dir, "supplier")
    old = codes.withColumn("ISO3 CODE", F.concat(F.lit("OLD"), "ISO2 CODE"))
    more = suppliers.select(
        F.concat(F.lit("S"), "s_suppkey").alias("ISO3 CODE"), F.lit("S").alias("ISO2 CODE"), F.col("s_name").alias("LABEL EN"))
    for part, rows in (("1", old), ("2", codes.unionByName(more))):
        rows.coalesce(1).write.option("header", True).option("sep", ";").csv(f"{folder}/part-{part}")
    raw = read_csv(spark, f"{folder}/part-*", sep=";", ordered=True)
    labels = wh.code_labels(raw, F.struct(*FILE_ORDER))
    return labels.select(F.col("_label").alias("label"), F.col("_label_code").alias("code"))


#: Stored bytes of a table that one task writes as text; texts may be several times as long.
WRITE_BLOCK = 32 << 20


@query
def csv_quoted_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks, written as CSV and read in blocks: what differs from the source, by language.

    There is one file for each WRITE_BLOCK bytes of the table, so small tables are one file.
    """
    docs = bind.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), "lang", F.concat(F.lit('say "so", '), "text", F.lit('\n""\r\nend')).alias("text"))
    path = f"{scratch_folder(spark)}/texts"
    with setting(spark, "spark.sql.files.minPartitionNum", "1"), block_bytes(spark, WRITE_BLOCK):
        docs.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    found = written(read_csv(spark, path, ordered=True, block=100_000))
    several = found.agg(F.min("_block") < F.max("_block")).first()[0]
    changed = content_differences(docs, found.drop(*FILE_ORDER), ["lang", "doc_id"]).groupBy("lang").agg(F.count(F.lit(1)).alias("differing"))
    rows = found.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("text")).alias("characters"))
    return rows.join(changed, "lang", "left").withColumns({"differing": F.coalesce("differing", F.lit(0)), "several_blocks": F.lit(several)})


def nation_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordering customers per nation as text, one column per year."""
    per_year = bind.nation_inputs(spark, sf_dir).population
    years = sorted(r[0] for r in per_year.select("census_period").distinct().collect())
    code = F.format_string("N%02d", "entity_key")
    wide = per_year.groupBy("entity_key").agg(*[F.sum(F.when(F.col("census_period") == y, F.col("population"))).alias(str(y)) for y in years])
    return wide.select(F.concat(F.lit("NATION_"), "entity_key").alias("Country Name"), code.alias("Country Code"),
                       *[F.col(str(y)).cast("string").alias(str(y)) for y in years])


@query
def layer_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files to a published build; every catalog table of it, and views over it, read by their names."""
    folder = scratch_folder(spark)
    raw_long(spark, sf_dir).write.option("header", True).csv(f"{folder}/raw/long")
    reference_codes(spark, sf_dir).write.option("header", True).option("sep", ";").csv(f"{folder}/raw/codes")
    wide = nation_population(spark, sf_dir)
    lines = ['"Data Source","Orders"', " ", '"Last Updated","2001"', " ", ",".join(f'"{c}"' for c in wide.columns)]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{folder}/raw/wide/head")
    wide.write.csv(f"{folder}/raw/wide/rows")
    spec = MarketSpec(measures=dict(zip(bind.PRIORITY_MEASURES, [*RAW.core_measures, RAW.closing])), lags=(1, 3))
    files = RawFiles(f"{folder}/raw/long", f"{folder}/raw/wide/*", f"{folder}/raw/codes", population_head=f"{folder}/raw/wide/head")
    database = "siftmark_" + uuid.uuid4().hex
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{folder}/catalog'")
    names = list(build(spark, files, f"{folder}/warehouse", spec, database=database))
    register_views(views := current_views(spark, f"{folder}/warehouse", spec))
    counted = [audit.count_rows(read_table(spark, f"`{database}`.`{n}`"), "rows").withColumn("table_name", F.lit(n)) for n in names]
    counted += [audit.count_rows(read_table(spark, v), "rows").withColumn("table_name", F.lit(v)) for v in views]
    return audit.union_checks(counted)


@query
def population_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wh.fact_population(unpivot_population(spark, sf_dir), RAW)


# Profiles

@query
def attribute_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.supplier_inputs(spark, sf_dir)
    return attribute_profile(i.long, i.spec)["attribute_counts"]


@query
def attribute_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.supplier_inputs(spark, sf_dir)
    return attribute_profile(i.long, i.spec)["attribute_entities"]


@query
def period_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.supplier_inputs(spark, sf_dir)
    return attribute_profile(i.long, i.spec)["period_range"]


@query
def top_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.supplier_inputs(spark, sf_dir)
    return attribute_profile(i.long, i.spec)["top_entities"]


@query
def attribute_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.supplier_inputs(spark, sf_dir)
    return attribute_profile(i.long, i.spec)["attribute_units"]


@query
def dataset_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.dataset_profile(bind.table(spark, sf_dir, "orders"))


@query
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.distinct_values(bind.table(spark, sf_dir, "orders"), "o_orderpriority")


@query
def suspicious_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names that contain one of the tokens."""
    return profiles.suspicious_names(bind.table(spark, sf_dir, "part"), "p_name", ["ring", "BOLT", "union"])


@query
def token_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per language whose whole text contains one of the aggregate tokens."""
    docs = bind.table(spark, sf_dir, "documents")
    return docs.groupBy("lang").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(contains_any("text", SUSPICIOUS_TOKENS)).alias("matching")
    )


# Data quality

@query
def duplicate_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.duplicate_groups(bind.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, and customers of orders, that do not appear as event users."""
    customers = bind.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity_key"))
    ordering = bind.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("entity_key"))
    users = bind.table(spark, sf_dir, "events").select(F.col("user_id").alias("entity_key"))
    return audit.all_orphans([customers, ordering], users, "entity_key")


@query
def key_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of orders and line items: in both, and on one side only."""
    orders = bind.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    lines = bind.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"))
    both = setops.common_keys(orders, lines, "k").withColumn("side", F.lit("both"))
    sides = setops.same_keys(orders, lines, "k").union(both)
    return sides.groupBy("side").agg(F.count(F.lit(1)).alias("keys"))


@query
def null_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.supplier_inputs(spark, sf_dir)
    return audit.coverage_profile(i.fact, i.population, i.spec, 1998 * 12 + 1)


@query
def join_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.customer_inputs(spark, sf_dir)
    rows = audit.check_coverage(i.fact, i.population, i.spec, since=1999, starts_by=1996, reaches=2001)
    return rows.withColumn("measured", F.round("measured", 4))


@query
def key_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {"lineitem": ["l_orderkey", "l_linenumber"], "orders": ["o_orderkey"], "customer": ["c_custkey"],
            "labels": ["doc_id"], "conversations": ["conv_id", "turn"]}
    reports = [audit.key_report(bind.table(spark, sf_dir, t), k, t) for t, k in keys.items()]
    return audit.union_checks(reports)


@query
def invalid_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.invalid_codes(bind.table(spark, sf_dir, "part"), "p_brand", "^Brand#[0-9]$")


@query
def expected_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.customer_inputs(spark, sf_dir)
    return setops.expected_members(snapshot_of(i), "region", ["ASIA", "EUROPE", "ATLANTIS"])


@query
def freshness_and_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.customer_inputs(spark, sf_dir)
    scored = round_score(wh.market_attractiveness(snapshot_of(i), i.spec))
    return audit.check_ranking(scored, i.spec, fresh_from=2000)


def lacking_production(fact: DataFrame, spec: MarketSpec) -> DataFrame:
    return audit.missing_production(fact, spec, [1, 2, 3, 5, 8], 24)


@query
def missing_production(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.supplier_inputs(spark, sf_dir)
    return lacking_production(i.fact, i.spec)


@query
def balance_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.balance_inputs(spark, sf_dir)
    gaps = audit.balance_gaps(i.fact, i.spec)
    return gaps.withColumns({"supply": F.round("supply", 2), "use": F.round("use", 2), "gap_pct": F.round("gap_pct", 6)})


@query
def trade_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.balance_inputs(spark, sf_dir)
    totals = {"total_imports": F.round("total_imports", 2), "total_exports": F.round("total_exports", 2)}
    return audit.trade_gaps(i.fact, i.spec).withColumns(totals).withColumn("gap_pct", F.round("gap_pct", 6))


@query
def trade_gap_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.balance_inputs(spark, sf_dir)
    return audit.trade_gap_stability(audit.trade_gaps(i.fact, i.spec)).withColumn("gap_spread", F.round("gap_spread", 6))


@query
def formula_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.supplier_inputs(spark, sf_dir)
    rows = audit.formula_agreement(snapshot_of(i), i.spec)
    return rows.withColumn("kg_from_bags", F.round("kg_from_bags", 3)).withColumn("kg_direct", F.round("kg_direct", 3))


def outside_per_capita(spark: SparkSession, sf_dir: str, snapshot: DataFrame, spec: MarketSpec) -> DataFrame:
    bounds = bind.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("entity_key"), F.lit(5e8).alias("low"), (F.col("s_acctbal") * 1e5).alias("high"),
        (F.col("s_acctbal") < 2000).alias("upper_only"),
    )
    return audit.per_capita_outside(snapshot, bounds, spec).select("entity_key", "upper_only", "agrees")


@query
def per_capita_outside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers whose per-capita value misses bounds taken from their account balance."""
    i = bind.supplier_inputs(spark, sf_dir)
    return outside_per_capita(spark, sf_dir, snapshot_of(i), i.spec)


def outside_headline(spark: SparkSession, sf_dir: str, metrics: DataFrame, spec: MarketSpec) -> DataFrame:
    bounds = bind.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("entity_key"), F.lit(5.0).alias("min_population"), F.lit(3e8).alias("low"),
        (F.col("s_acctbal") * 1e5).alias("high"),
    )
    heads = latest.headline_rows(metrics, "entity_key", "period", "population")
    return audit.headline_outside(heads, bounds, spec).select("entity_key", "period", "population")


@query
def headline_outside(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.supplier_inputs(spark, sf_dir)
    return outside_headline(spark, sf_dir, metrics_of(i), i.spec)


@query
def pivot_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells whose source rows are not all equal to the pivoted value: colliding line items."""
    i = bind.supplier_inputs(spark, sf_dir)
    return audit.pivot_differences(i.long, i.fact, i.spec)


@query
def layer_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per order key in orders and in line items."""
    orders = bind.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    lines = bind.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"))
    return audit.compare_key_counts(orders, lines, "k")


@query
def layer_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against a copy in which one row has another value, one is missing and one is new."""
    orders = bind.table(spark, sf_dir, "orders")
    first, last = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    price = F.when(F.col("o_orderkey") == last, F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice"))
    copy = orders.filter(F.col("o_orderkey") != first).withColumn("o_totalprice", price)
    new = orders.filter(F.col("o_orderkey") == last).withColumn("o_orderkey", F.col("o_orderkey") + 1)
    return content_differences(orders, written(copy.unionByName(new)), ["o_orderkey"])


@query
def series_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.supplier_inputs(spark, sf_dir)
    return audit.series_completeness(metrics_of(i), i.spec).withColumn("known_pct", F.round("known_pct", 6))


@query
def export_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.customer_inputs(spark, sf_dir)
    tables = {"dim": i.dim, "fact": i.fact, "population": i.population}
    return export_tables(tables, scratch_folder(spark))


@query
def export_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values as exported: those that are no finite number become NULL."""
    kind, value = F.col("event_type"), F.col("value")
    odd = F.when(kind == "error", F.lit(float("nan"))).when(kind == "signup", F.lit(float("-inf"))).otherwise(value)
    return normalise_for_export(bind.table(spark, sf_dir, "events").select("event_id", "event_type", odd.alias("value")))


@query
def profile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every part of the attribute profile, and count the rows of each as read back."""
    i = bind.supplier_inputs(spark, sf_dir)
    parts, folder = attribute_profile(i.long, i.spec), scratch_folder(spark)
    write_profile(parts, folder)
    counts = [audit.count_rows(read_table(spark, f"{folder}/{p}"), "rows").withColumn("part", F.lit(p)) for p in parts]
    return audit.union_checks(counts)


def stored(i: Inputs) -> Inputs:
    return Inputs(i.spec, written(i.long), i.dim, written(i.population), i.entities)


def audit_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Check rows over the nation, balance and customer bindings.

    Tables that several checks read are written first, as a warehouse build does.
    """
    nat, bal = stored(bind.nation_inputs(spark, sf_dir)), bind.balance_inputs(spark, sf_dir)
    cus = bind.customer_inputs(spark, sf_dir)
    customers = written(snapshot_of(cus))
    scored = round_score(wh.market_attractiveness(customers, cus.spec))
    fact, balances = written(nat.fact), written(bal.fact)
    metrics = written(wh.entity_period_metrics(fact, nat.dim, nat.population, nat.spec))
    trends = wh.global_trends(fact, nat.spec).withColumns({c: F.round(c, 2) for c in TOTALS})
    lines, stored_orders = bind.table(spark, sf_dir, "lineitem"), written(cus.long)
    mapping = mapping_method_counts(spark, sf_dir)
    return [
        audit.check_layers({"orders": (stored_orders, bind.table(spark, sf_dir, "orders"))}),
        audit.check_content(stored_orders, cus.long, ["entity_key", "period"]),
        audit.check_empty(audit.duplicate_groups(lines, ["l_orderkey", "l_linenumber"]), "A2", "no duplicate grain"),
        audit.check_empty(audit.all_orphans([fact, nat.population.select("entity_key")], nat.dim, "entity_key"), "A3", "no orphans"),
        audit.check_coverage(fact, nat.population, nat.spec, since=1996, starts_by=1996, reaches=2001),
        audit.check_empty(audit.pivot_differences(nat.long, fact, nat.spec), "A7", "pivot equals source cells"),
        audit.check_balance(audit.balance_gaps(balances, bal.spec).withColumn("gap_pct", F.round("gap_pct", 6))),
        audit.check_leads(fact, nat.spec, "B3", 7, "production", 20),
        audit.check_trade_gap(audit.trade_gaps(balances, bal.spec).withColumn("gap_pct", F.round("gap_pct", 6))),
        audit.check_no_single_leader(audit.ranking_leaders(customers, cus.spec), cus.spec),
        audit.check_ranking(scored, cus.spec, fresh_from=2000),
        audit.check_mapping(mapping, 15, 5),
        audit.check_table("N1", fact, key="entity_key", value="consumption", period="period",
                          min_rows=100, min_keys=25, starts_from=1995, reaches=2001),
        audit.check_members(setops.expected_members(nat.dim, "region", ["ASIA", "EUROPE"]), "G2"),
        audit.check_any_value(fact, nat.spec, "G3", 3, "consumption"),
        audit.check_rose(compare_back(trends, "period", "total_consumption", 5)),
        audit.check_range(trends, nat.spec, (1995, 2001), (1998, 2001)),
        audit.check_region_growth(metrics, nat.spec, 1996, 2000),
        audit.check_headline(latest.headline_rows(metrics, "entity_key", "period", "population"), nat.spec, 3, 2001),
        audit.check_series(audit.series_completeness(metrics, nat.spec), nat.spec, 3,
                           min_rows=7, starts_by=1995, reaches=2001, min_known=90.0),
    ]


@query
def audit_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.union_checks(audit_parts(spark, sf_dir)).withColumn("measured", F.round("measured", 4))


def detail_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Status rows of the checks whose findings are queries of their own, with the first names.

    The facts are pivoted once, and what several checks read is stored.
    """
    i = bind.supplier_inputs(spark, sf_dir)
    fact, population = written(i.fact), written(i.population)
    metrics = written(wh.entity_period_metrics(fact, i.dim, population, i.spec))
    snapshot = written(round_growth(wh.market_snapshot(fact, i.dim, population, i.spec), i.spec))
    unmapped = name_reconciliation(spark, sf_dir).filter("match_method = 'unmapped'")
    growth = F.abs(F.col(cagr_name(i.spec.lags[0])))
    return [
        audit.check_findings(outside_per_capita(spark, sf_dir, snapshot, i.spec), "B2", "per capita within bounds", "entity_key"),
        audit.check_leads(fact, i.spec, "B4", 7, "imports", 20),
        audit.check_findings(snapshot.filter(growth > 0.5), "C1-names", "no extreme growth", "entity_key", "WARN"),
        audit.check_findings(lacking_production(fact, i.spec), "C2", "core producers report production", "entity_key", "WARN"),
        audit.check_findings(invalid_codes(spark, sf_dir), "E5", "codes have the right form", "p_brand"),
        audit.check_findings(outside_headline(spark, sf_dir, metrics, i.spec), "T4", "headlines within bounds", "entity_key"),
        audit.check_findings(unmapped, "M1-names", "every name is mapped", "Country_Name", "WARN"),
        audit.check_table("G2", i.dim, key="entity_key", min_rows=5, min_keys=5),
        audit.check_table("G4", population, key="entity_key", value="population", min_rows=100),
        audit.check_table("G5", snapshot, key="entity_key", value="consumption", min_rows=5),
    ]


@query
def detail_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.union_checks(detail_parts(spark, sf_dir))


def build_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Checks of the cleaned sources and of the built views: sizes, magnitudes, bands, references, expected members."""
    i = stored(bind.nation_inputs(spark, sf_dir))
    fact, entity = written(i.fact), i.spec.entity
    snapshot = written(round_growth(wh.market_snapshot(fact, i.dim, i.population, i.spec), i.spec))
    scored = written(round_score(wh.market_attractiveness(snapshot, i.spec)))
    views = {
        "metrics": (wh.entity_period_metrics(fact, i.dim, i.population, i.spec), 100), "growth": (growth_metrics(fact, i.spec), 100),
        "snapshot": (snapshot, 20), "trends": (wh.global_trends(fact, i.spec), 6), "attractiveness": (scored, 20),
    }
    codes = reference_codes(spark, sf_dir).select(F.col("ISO3 CODE").alias("iso3_code"))
    customers = bind.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias(entity))
    referring = {
        "facts": bind.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias(entity)),
        "population": bind.table(spark, sf_dir, "events").select(F.col("user_id").alias(entity)),
    }
    return [
        audit.check_table("N1-population", i.population, key=entity, value="population", period="census_period",
                          min_rows=100, min_keys=25, starts_from=1995, reaches=2001),
        audit.check_table("N1-codes", codes, key="iso3_code", min_rows=25, min_keys=25),
        audit.check_references(referring, customers, entity, "N1"),
        audit.check_latest_values(i.population, entity, "census_period", "population", {3: 1.0, 7: 1.0, 99: 1.0}, "G4"),
        audit.check_minimums(views, "G5"),
        audit.check_band(snapshot, entity, 3, wh.PER_CAPITA_KG, 1e6, 1e12, "G5-band"),
        audit.check_any_member(wh.top_candidates(scored, i.spec), entity, [3, 7, 12, 18, 21, 24], "G6-members"),
    ]


@query
def build_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.union_checks(build_parts(spark, sf_dir))


@query
def scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check row is stored once under the id of its build; the rating only reads what is stored."""
    parts = [audit_checks, detail_checks, build_checks, snapshot_checks, scenario_checks, edge_filters]
    folder = scratch_folder(spark)
    audit.store_checks(audit.union_checks([part(spark, sf_dir) for part in parts]), folder, "current")
    return audit.scorecard(audit.stored_checks(spark, folder, "current"))


@query
def snapshot_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.supplier_inputs(spark, sf_dir)
    return audit.check_snapshot(snapshot_of(i), i.spec)


@query
def scenario_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rankings react to weights and to regions."""
    i = bind.customer_inputs(spark, sf_dir)
    tops, by_region = written(scenario_tops(i)), written(region_tops(i))
    return audit.union_checks([
        audit.check_weights_matter(tops, i.spec),
        audit.check_scenarios(tops, i.spec),
        audit.check_region_filter(by_region, i.spec, {"asia": "ASIA", "africa": "AFRICA"}),
    ])


@query
def edge_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = bind.customer_inputs(spark, sf_dir)
    snapshot = written(snapshot_of(i))
    return audit.check_edges(
        rec.recommend(snapshot, i.spec),
        rec.recommend(snapshot, i.spec, regions=["ATLANTIS"]),
        feeds.trend_range(trends_of(i), i.spec, 2001, 2001),
        feeds.entity_series(metrics_of(i), i.spec, -1),
    )

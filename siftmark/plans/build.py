"""The whole build: raw files -> raw layer -> analytics layer -> views.

    files = RawFiles(long="…/balance.csv", population="…/population.csv", codes="…/codes.csv")
    tables = build(spark, files, "…/warehouse", region_lookup=regions)
    register_views(analytics_views(tables, MarketSpec()))
    spark.sql("SELECT * FROM v_top_market_candidates")
    spark.sql("SELECT * FROM v_country_year_metrics WHERE iso3_code = :code", args={"code": "BRA"})
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftmark.operators.growth import growth_metrics
from siftmark.operators.reshape import pivot_present
from siftmark.plans import warehouse as wh
from siftmark.sources.readers import FILE_ORDER, read_csv, read_csv_after_preamble
from siftmark.sources.versions import TableBuild, current_tables, point_views
from siftmark.spec import MarketSpec

# Names under which the views are registered.
VIEW_NAMES = {
    "metrics": "v_country_year_metrics",
    "growth": "v_country_growth_metrics",
    "snapshot": "v_latest_year_snapshot",
    "trends": "v_global_trends",
    "attractiveness": "v_market_attractiveness",
    "candidates": "v_top_market_candidates",
}


@dataclass(frozen=True)
class RawFiles:
    """The three raw sources: long balance rows, wide population after a preamble, ``;``-separated codes."""

    long: str
    population: str
    codes: str
    preamble_lines: int = 4
    #: The file that starts with the preamble, where the population is a folder.
    population_head: str | None = None


def clean_layer(spark: SparkSession, files: RawFiles, spec: MarketSpec) -> dict[str, DataFrame]:
    raw_codes = read_csv(spark, files.codes, sep=";", ordered=True)
    codes = wh.clean_codes(raw_codes)
    wide = read_csv_after_preamble(spark, files.population, files.preamble_lines, files.population_head)
    return {
        "codes": codes,
        "long": wh.clean_long_fact(read_csv(spark, files.long), wh.code_labels(raw_codes, F.struct(*FILE_ORDER)), spec),
        "population": wh.clean_population(wide, codes, spec),
    }


def build(
    spark: SparkSession,
    files: RawFiles,
    folder: str,
    spec: MarketSpec | None = None,
    region_lookup: DataFrame | None = None,
    database: str | None = None,
) -> dict[str, DataFrame]:
    """Write both layers as a new build of ``folder``, publish it, and return the stored tables.

    Every table is stored once and the next step reads it back, so no step repeats the
    work of an earlier one. Facts are sorted by their keys: filters by entity or period
    skip files and row groups by their statistics. Readers keep the build before until all tables of
    this one are stored (``sources.versions``). With ``database`` the tables are catalog tables too,
    and its views ``<database>.<table>`` show the new build.
    """
    spec = spec or MarketSpec()
    order = {
        "raw_codes": ["iso3_code"],
        "raw_long": [spec.entity, spec.period, spec.attribute_id],
        "raw_population": [spec.entity, spec.population_period],
        "dim": [spec.entity],
        "fact": spec.keys,
        "population": [spec.entity, spec.population_period],
        "attractiveness": [spec.entity],
    }
    target, tables = TableBuild(spark, folder, database), {}

    def store(name: str, df: DataFrame) -> None:
        tables[name] = target.store(name, df, order[name])

    for name, df in clean_layer(spark, files, spec).items():
        store(f"raw_{name}", df)
    targets: dict[str, list[str]] = {}
    for attribute, column in spec.measures.items():
        targets.setdefault(column, []).append(attribute)
    store("dim", wh.dim_entity(tables["raw_codes"], spec, region_lookup))
    store("fact", pivot_present(tables["raw_long"], spec, targets).fact)
    store("population", wh.fact_population(tables["raw_population"], spec))
    snapshot = wh.market_snapshot(tables["fact"], tables["dim"], tables["population"], spec)
    store("attractiveness", wh.market_attractiveness(snapshot, spec))
    target.publish()
    if database:
        point_views(spark, folder, database)
    return tables


def current_views(spark: SparkSession, folder: str, spec: MarketSpec | None = None) -> dict[str, DataFrame]:
    """The views over the tables of the build that was published last."""
    return analytics_views(current_tables(spark, folder), spec)


def analytics_views(
    tables: Mapping[str, DataFrame], spec: MarketSpec | None = None, names: Mapping[str, str] = VIEW_NAMES
) -> dict[str, DataFrame]:
    """The lazy views over stored tables, by the names to register them under.

    No job runs here. Scores need the whole ranking set, so ``build`` stores them with the
    other tables; ``current_views`` has those of the last build.
    """
    spec = spec or MarketSpec()
    fact, dim, population = tables["fact"], tables["dim"], tables["population"]
    views = {
        "metrics": wh.entity_period_metrics(fact, dim, population, spec),
        "growth": growth_metrics(fact, spec),
        "snapshot": wh.market_snapshot(fact, dim, population, spec),
        "trends": wh.global_trends(fact, spec),
        "attractiveness": tables["attractiveness"],
        "candidates": wh.top_candidates(tables["attractiveness"], spec),
    }
    return {names[k]: df for k, df in views.items()}

"""Raw files to registered views, end to end."""

import pytest

from siftmark.plans.build import RawFiles, analytics_views, build, current_views
from siftmark.sources.versions import TableBuild, current_tables, point_views, prune_builds
from siftmark.sources.writers import register_views
from siftmark.spec import BALANCE_MEASURES
from util import plan

COUNTRIES = {"Brazil": "BRA", "Viet Nam": "VNM", "Germany": "DEU", "Namibia": "NAM", "Mexico": "MEX"}
SOURCE_NAMES = {"Vietnam": "VNM", "BRAZIL": "BRA", "Germany ": "DEU", "Mexico": "MEX"}


@pytest.fixture(scope="module")
def views(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    years = range(2010, 2026)
    lines = ["Country_Name,Market_Year,Attribute_ID,Attribute_Description,Value,Unit_Description"]
    for n, name in enumerate([*SOURCE_NAMES, "European Union", "Nowhere"], 1):
        for y in years:
            for i, attribute in enumerate(BALANCE_MEASURES):
                lines.append(f"{name},{y},{i},{attribute},{n * 1000 * 1.05 ** (y - 2010) * (1 + i)},(1000 60 KG BAGS)")
    (folder / "long.csv").write_text("\n".join(lines) + "\n")
    head = ["Country Name", "Country Code", *map(str, range(2010, 2025))]
    wide = ["Data Source,x", "", "Last Updated Date,y", "", ",".join(f'"{h}"' for h in head)]
    wide += [f'"{n}","{c}",' + ",".join(str(1e6 * (i + 1) + y) for y in range(15)) for i, (n, c) in enumerate(COUNTRIES.items())]
    (folder / "population.csv").write_text("\n".join(wide) + "\n")
    codes = ["ISO3 CODE;ISO2 CODE;LABEL EN"] + [f"{c};{c[:2]};{n}" for n, c in COUNTRIES.items()]
    (folder / "codes.csv").write_text("\n".join(codes) + "\n")
    regions = spark.createDataFrame(
        [("BRA", "Americas"), ("VNM", "Asia"), ("DEU", "Europe"), ("MEX", "Americas")], "iso3_code string, continent string"
    )
    files = RawFiles(*(str(folder / f"{n}.csv") for n in ("long", "population", "codes")))
    out = str(tmp_path_factory.mktemp("warehouse"))
    build(spark, files, out, region_lookup=regions)
    tables = build(spark, files, out, region_lookup=regions)  # a second build replaces the first
    register_views(analytics_views(tables))
    return tables | {"folder": out, "files": files}


def test_tables(views):
    assert {r.iso3_code for r in views["dim"].collect()} == set(COUNTRIES.values())
    assert views["dim"].filter("iso3_code = 'NAM' AND region IS NULL").count() == 1
    assert views["fact"].count() == 4 * 16
    assert views["population"].count() == 5 * 15


def test_views(spark, views):
    top = spark.sql("SELECT * FROM v_top_market_candidates").collect()
    assert [r.iso3_code for r in top][0] == "MEX" and len(top) == 4
    assert {r.market_year for r in top} == {2024}
    assert top[0].consumption_cagr_5y == pytest.approx(0.05)
    assert list(spark.table("v_latest_year_snapshot").columns) == [
        "iso3_code", "country_name", "region", "continent", "market_year", "domestic_consumption", "production",
        "bean_imports", "bean_exports", "population", "per_capita_kg_per_person", "per_capita_bags_per_1000",
        "net_bean_imports", "import_dependency_ratio", "consumption_cagr_5y", "consumption_cagr_10y",
    ]
    assert spark.table("v_global_trends").columns == [
        "market_year", "total_consumption", "total_production", "total_bean_imports", "total_bean_exports", "reporting_countries",
    ]
    one = spark.sql(
        "SELECT * FROM v_country_year_metrics WHERE iso3_code = :code AND market_year BETWEEN :a AND :b",
        args={"code": "VNM", "a": 2015, "b": 2025},
    )
    assert one.count() == 11 and one.filter("population IS NULL").count() == 1
    assert spark.table("v_country_growth_metrics").filter("consumption_cagr_10y IS NOT NULL").count() == 4 * 6
    assert spark.table("v_market_attractiveness").count() == 4


def test_scores_are_a_table_of_the_build(spark, views):
    path = views["attractiveness"].inputFiles()[0].rsplit("/", 1)[0]
    before = {r.iso3_code: r.composite_score for r in spark.table("v_market_attractiveness").collect()}
    assert set(before) == {r.iso3_code for r in spark.read.parquet(path).collect()}
    assert "Window" not in plan(views["attractiveness"]) and "Join" not in plan(views["attractiveness"])


def counts(tables):
    return {n: df.count() for n, df in tables.items() if n not in ("folder", "files")}


def test_a_build_that_ends_half_way_leaves_the_old_tables(spark, views, monkeypatch):
    folder, want = views["folder"], counts(views)
    assert counts(current_tables(spark, folder)) == want
    written, store = [], TableBuild.store

    def failing(self, name, df, sort_by=()):
        if name == "fact":
            raise RuntimeError("lost")
        written.append(name)
        return store(self, name, df.limit(1), sort_by)

    monkeypatch.setattr(TableBuild, "store", failing)
    with pytest.raises(RuntimeError, match="lost"):
        build(spark, views["files"], folder)
    assert "dim" in written
    assert counts(current_tables(spark, folder)) == want
    assert current_views(spark, folder)["v_market_attractiveness"].count() == 4


def test_tables_of_one_build_never_mix(spark, tmp_path):
    """Two builds at once: readers have one of them whole; older ones can be removed."""
    folder = str(tmp_path)
    with pytest.raises(LookupError):
        current_tables(spark, folder)
    one, two = TableBuild(spark, folder), TableBuild(spark, folder)
    one.store("a", spark.range(1))
    two.store("a", spark.range(2))
    two.store("b", spark.range(2), sort_by=["id"])
    two.publish()
    one.store("b", spark.range(1))
    assert counts(current_tables(spark, folder)) == {"a": 2, "b": 2}
    reader = current_tables(spark, folder)
    one.publish()
    assert counts(current_tables(spark, folder)) == {"a": 1, "b": 1} and counts(reader) == {"a": 2, "b": 2}
    assert prune_builds(spark, folder, keep=2) == [] and prune_builds(spark, folder, keep=1) == [two.build]
    assert prune_builds(spark, folder, keep=1) == [] and counts(current_tables(spark, folder)) == {"a": 1, "b": 1}


def test_catalog_views_follow_the_published_build(spark, tmp_path):
    spark.sql(f"CREATE DATABASE layers LOCATION '{tmp_path}/db'")
    try:
        for n in (1, 2):
            target = TableBuild(spark, f"{tmp_path}/w", "layers")
            target.store("t", spark.range(n))
            if n == 2:
                assert spark.table("layers.t").count() == 1
            target.publish()
            assert point_views(spark, f"{tmp_path}/w", "layers") == ["t"]
            assert spark.table("layers.t").count() == n
    finally:
        spark.sql("DROP DATABASE layers CASCADE")

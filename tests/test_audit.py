import pytest
from pyspark.sql import functions as F

from siftmark.operators import profile, setops, topk
from siftmark.operators.content import content_differences
from siftmark.operators.reshape import pivot_measures
from siftmark.plans import audit
from siftmark.spec import MarketSpec
from util import SPEC, plan, rows

LONG = "iso3_code string, market_year bigint, attribute_description string, value double"
MEASURES = [
    "beginning_stocks", "production", "bean_imports", "roast_ground_imports", "soluble_imports",
    "bean_exports", "roast_ground_exports", "soluble_exports", "domestic_consumption", "ending_stocks",
]
FACT = "iso3_code string, market_year bigint, " + ", ".join(f"{m} double" for m in MEASURES)


def status(df):
    return {r.check_id: r.status for r in df.collect()}


@pytest.mark.parametrize("closing, gap", [(13.0, 0.0), (0.0, 13 / 118 * 100)])
def test_balance(spark, closing, gap):
    old = ("A", 2000, *[1000.0] * 10)
    new = ("A", 2001, 10.0, 100.0, 5.0, 2.0, 1.0, 40.0, 3.0, 2.0, 60.0, closing)
    gaps = audit.balance_gaps(spark.createDataFrame([old, new], FACT), SPEC)
    row = gaps.first()
    assert row.market_year == 2001 and row.gap_pct == pytest.approx(gap)
    assert status(audit.check_balance(gaps)) == {"B1": "PASS"}
    assert status(audit.check_balance(gaps, max_gap=gap)) == {"B1": "FAIL" if gap >= 0 else "PASS"}


def test_pivot_differences_show_collisions_and_changes(spark):
    long = spark.createDataFrame(
        [("A", 1, "Production", 3.0), ("A", 1, "Production", 8.0), ("B", 1, "Production", 5.0), ("B", 1, "Unknown", 7.0)], LONG
    )
    fact = pivot_measures(long, SPEC)
    assert rows(audit.pivot_differences(long, fact, SPEC)) == [("A", 1, "Production", 3.0, 8.0, 8.0)]
    changed = fact.withColumn("production", F.when(F.col("iso3_code") == "B", 6.0).otherwise(F.col("production")))
    assert audit.pivot_differences(long, changed, SPEC).count() == 2
    lost = fact.filter("iso3_code = 'A'")
    assert ("B", 1, "Production", 5.0, 5.0, None) in rows(audit.pivot_differences(long, lost, SPEC))


def test_grain_and_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "b"), (2, "c")], "k int, s string")
    assert rows(audit.duplicate_groups(df, ["k", "s"])) == [(1, "a", 2)]
    assert rows(audit.key_report(df, ["k"], "t")) == [("t", 5, 1, 1, False)]
    assert rows(audit.key_report(df.limit(0), ["k"], "t")) == [("t", 0, 0, 0, True)]
    assert status(audit.check_keys("t", df.filter("s = 'c'"), ["k"])) == {"K-t": "PASS"}
    assert rows(audit.invalid_codes(df.select(F.col("s").alias("c")), "c", "^[ab]$")) == [("c",)]


def test_layers(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k int")
    assert rows(audit.compare_key_counts(a, b, "k")) == [
        (None, 1, 1, True), (1, 2, 2, True), (2, 1, 0, False), (3, 0, 1, False)
    ]
    assert status(audit.check_layers({"t": (a, b)})) == {"A1": "PASS"}
    assert status(audit.check_layers({"t": (a, b), "u": (a, a.limit(1))})) == {"A1": "FAIL"}


def test_trade_gap(spark):
    fact = spark.createDataFrame(
        [("A", y, 0.0, 0.0, i, 0.0, None, e, 0.0, None, 0.0, 0.0)
         for y, i, e in [(2019, 1.0, 9.0), (2021, 100.0, 120.0), (2022, 100.0, 125.0)]], FACT
    )
    gaps = audit.trade_gaps(fact, SPEC)  # 2020 is missing, 2019 is too old
    assert rows(gaps.select("market_year", "gap_pct")) == [(2021, 20.0), (2022, 25.0)]
    assert status(audit.check_trade_gap(gaps)) == {"B5": "PASS"}
    assert status(audit.check_trade_gap(gaps, max_spread=4)) == {"B5": "FAIL"}
    assert status(audit.check_trade_gap(gaps.limit(0))) == {"B5": "FAIL"}


def test_leaders_of_the_latest_period(spark):
    fact = spark.createDataFrame([("A", 1, 9.0), ("B", 2, None), ("C", 2, 5.0), ("D", 2, 5.0)], "iso3_code string, market_year int, production double")
    assert [r.iso3_code for r in audit.latest_leaders(fact, SPEC, "production", 3).collect()] == ["C", "D", "B"]
    assert status(audit.check_leads(fact, SPEC, "B3", "C", "production", 1)) == {"B3": "PASS"}
    assert status(audit.check_leads(fact, SPEC, "B3", "A", "production", 3)) == {"B3": "FAIL"}


def test_coverage(spark):
    fact = spark.createDataFrame(
        [("A", 1999, 1.0), ("A", 2001, None), ("B", 2021, 1.0)], "iso3_code string, market_year bigint, domestic_consumption double"
    ).withColumns({c: F.lit(1.0) for c in ("production", "bean_imports", "bean_exports")})
    population = spark.createDataFrame([("A", 2001, 5.0)], "iso3_code string, year bigint, population double")
    assert status(audit.check_coverage(fact, population, SPEC)) == {
        "A4": "PASS", "A5-fact": "PASS", "A6": "FAIL", "A5-population": "FAIL"
    }


def test_table_check(spark):
    df = spark.createDataFrame([("A", 1.0, 1960), ("A", None, 2021), (None, 2.0, 2000)], "k string, v double, y int")
    got = status(audit.check_table("N", df, key="k", value="v", period="y", min_rows=3, min_keys=2, starts_from=1960, reaches=2020))
    assert got == {"N-rows": "PASS", "N-keys": "FAIL", "N-null-keys": "FAIL", "N-null-values": "FAIL", "N-periods": "PASS"}
    assert status(audit.check_table("N", df, key="k", max_rows=2))["N-rows"] == "FAIL"


@pytest.mark.parametrize("fail, warn, confidence", [(4, 0, "LOW"), (1, 0, "MEDIUM"), (0, 6, "MEDIUM"), (0, 5, "HIGH")])
def test_scorecard(spark, fail, warn, confidence):
    df = spark.createDataFrame([("FAIL",)] * fail + [("WARN",)] * warn + [("PASS",)] * 3, "status string")
    card = audit.scorecard(df).first()
    assert (card.failed, card.warned, card.passed, card.confidence) == (fail, warn, 3, confidence)


def test_second_rating(spark):
    for missed, rating in [(0, "HIGH"), (2, "MEDIUM"), (3, "LOW")]:
        df = spark.createDataFrame([("PASS",)] * 5 + [("FAIL",)] * missed, "status string")
        assert audit.scorecard(df).first().pass_confidence == rating


def test_outliers_and_snapshot(spark):
    snapshot = spark.createDataFrame(
        [("A", "a", 6e7, 0.6, 1.0), ("B", "b", 1e6, -0.51, 1.0), ("C", "c", 1e6, 0.5, None), ("D", "d", None, None, None)],
        "iso3_code string, country_name string, population double, consumption_cagr_5y double, per_capita_kg_per_person double",
    )
    assert [r.iso3_code for r in audit.growth_outliers(snapshot, SPEC).orderBy("iso3_code").collect()] == ["A", "B"]
    profile_row = audit.snapshot_profile(snapshot, SPEC).first()
    assert (profile_row.growth_outliers, profile_row.large_outliers) == (2, 1)
    assert status(audit.check_snapshot(snapshot, SPEC)) == {"C1": "WARN", "C1-large": "WARN", "T0-population": "FAIL", "T0-per-capita": "FAIL"}


def test_per_capita_bounds(spark):
    snapshot = spark.createDataFrame(
        [("A", 25_000.0, 3e8, 83.3333), ("B", 25_000.0, 3e8, 8.0), ("I", 25_000.0, 3e8, 83.3333)],
        "iso3_code string, domestic_consumption double, population double, per_capita_bags_per_1000 double",
    )
    bounds = spark.createDataFrame([("A", 4.0, 5.0, False), ("B", 4.0, 5.0, False), ("I", 0.0, 5.0, True)],
                                   "iso3_code string, low double, high double, upper_only boolean")
    got = {r.iso3_code: r.agrees for r in audit.per_capita_outside(snapshot, bounds, SPEC).collect()}
    assert got == {"B": False, "I": True}


def test_members_sets_and_samples(spark):
    a = spark.createDataFrame([("x",), ("y",), ("y",)], "k string")
    b = spark.createDataFrame([("y",), ("z",)], "k string")
    assert rows(setops.union_keys(a, b, "k")) == [("x",), ("y",), ("z",)]
    assert rows(setops.minus_keys(a, b, "k")) == [("x",)]
    assert rows(setops.common_keys(a, b, "k")) == [("y",)]
    assert rows(setops.same_keys(a, b, "k")) == [("x", "left"), ("z", "right")]
    members = setops.expected_members(a, "k", ["x", "q"])
    assert rows(members) == [("q", False), ("x", True)]
    assert status(audit.check_members(members, "G2")) == {"G2": "FAIL"}
    assert status(audit.check_members(members, "G6", need="any")) == {"G6": "PASS"}
    assert rows(topk.sample_keys(a.union(b), "k", 2)) == rows(topk.sample_keys(b.union(a).repartition(5), "k", 2))
    assert rows(topk.mode(a, "k")) == [("y", 2)]
    assert rows(topk.sparsest(a, "k")) == [("x", 1)]


def test_ranges_and_regions(spark):
    trends = spark.createDataFrame([(y, float(y)) for y in range(2015, 2026)], "market_year bigint, total_consumption double")
    assert set(status(audit.check_range(trends, SPEC, (2015, 2025), (2020, 2025))).values()) == {"PASS"}
    assert set(status(audit.check_range(trends, SPEC, (2020, 2025), (2020, 2025))).values()) == {"FAIL"}
    metrics = spark.createDataFrame([(r, y, v) for r in ("N", None) for y, v in [(2020, 1.0), (2024, 2.0)]],
                                    "region string, market_year bigint, domestic_consumption double")
    assert set(status(audit.check_region_growth(metrics, SPEC, 2020, 2024)).values()) == {"PASS"}
    assert status(audit.check_region_growth(metrics, SPEC, 2024, 2020))["T1-total"] == "FAIL"


def test_series_and_headline(spark):
    metrics = spark.createDataFrame([("A", y, None if y == 1960 else 1.0, 5.0) for y in range(1960, 2025)],
                                    "iso3_code string, market_year bigint, domestic_consumption double, population double")
    done = audit.series_completeness(metrics, SPEC)
    assert set(status(audit.check_series(done, SPEC, "A")).values()) == {"PASS"}
    assert set(status(audit.check_series(done, SPEC, "B")).values()) == {"FAIL"}
    assert status(audit.check_headline(metrics.filter("market_year = 2024"), SPEC, "A", 2024)) == {"T0-headline": "PASS"}
    assert status(audit.check_headline(metrics.filter("market_year = 2024"), SPEC, "A", 2023)) == {"T0-headline": "FAIL"}


def test_profiles(spark):
    df = spark.createDataFrame([("A", 2000, "P", 1.0, "u"), ("A", 2001, "P", None, "u"), ("B", 2001, "Q", 2.0, "u")],
                               "iso3_code string, market_year bigint, attribute_description string, value double, unit_description string")
    parts = profile.attribute_profile(df, MarketSpec())
    assert rows(parts["attribute_counts"]) == [("P", 2), ("Q", 1)]
    assert rows(parts["period_range"]) == [(2000, 2001, 2)]
    assert [tuple(r) for r in profile.dataset_profile(df, ["value", "iso3_code"]).orderBy("position").collect()] == [
        (0, "value", "double", 3, 2, 2), (1, "iso3_code", "string", 3, 3, 2)
    ]
    names = spark.createDataFrame([("European Union",), ("Brazil",), ("Other",), (None,)], "n string")
    assert rows(profile.suspicious_names(names, "n")) == [("European Union",), ("Other",)]


def test_profile_of_many_types_in_one_scan(spark, tmp_path):
    nan = float("nan")
    data = [(0.0, "a", [1, None], {"k": 1, "l": 2}, (1, None), True), (-0.0, "a", [None, 1], {"l": 2, "k": 1}, (None, 1), None),
            (nan, "", [1], {}, None, True), (nan, None, None, None, (1, None), False)] * 50
    df = spark.createDataFrame(data, "d double, s string, a array<int>, m map<string,int>, t struct<x:int,y:int>, b boolean")
    got = rows(profile.dataset_profile(df).select("column_name", "rows", "non_null", "distinct_values"))
    assert got == [("a", 200, 150, 3), ("b", 200, 150, 2), ("d", 200, 200, 2), ("m", 200, 150, 2), ("s", 200, 150, 2), ("t", 200, 150, 2)]
    df.write.parquet(str(tmp_path / "t"))
    text = plan(profile.dataset_profile(spark.read.parquet(str(tmp_path / "t"))))
    assert text.count("FileScan") == 1
    empty = profile.dataset_profile(df.limit(0))
    assert [tuple(r)[3:] for r in empty.collect()] == [(0, 0, 0)] * 6


def test_build_checks_tell_what_is_missing(spark):
    df = spark.createDataFrame([("A", 2000, 5.0), ("A", 2001, 9.0), ("B", 2001, None), (None, 2001, 1.0)], "k string, p int, v double")
    assert status(audit.check_latest_values(df, "k", "p", "v", {"A": 8.0, "B": 1.0, "Z": 1.0}, "G4")) == {"G4-A": "PASS", "G4-B": "FAIL", "G4-Z": "FAIL"}
    assert status(audit.check_minimums({"a": (df, 4), "b": (df, 5)}, "G5")) == {"G5-a": "PASS", "G5-b": "FAIL"}
    assert status(audit.check_band(df, "k", "A", "v", 8.0, 10.0, "X")) == {"X": "PASS"}
    assert status(audit.check_band(df, "k", "Z", "v", 8.0, 10.0, "X")) == {"X": "FAIL"}
    assert status(audit.check_any_member(df, "k", ["Z", "B"], "Y")) == {"Y": "PASS"}
    assert status(audit.check_any_member(df, "k", ["Z"], "Y")) == {"Y": "FAIL"}
    [row] = audit.check_references({"t": df}, df.filter("k = 'A'"), "k", "N1").collect()
    assert (row.check_id, row.status, row.measured) == ("N1-t", "FAIL", 1.0) and row.details.endswith(": B")


def test_check_rows_are_kept_by_build(spark, tmp_path):
    rule = audit.check_empty(spark.range(3), "A", "none")
    audit.store_checks(rule, str(tmp_path), "one")
    audit.store_checks(rule.unionByName(audit.check_empty(spark.range(0), "B", "none")), str(tmp_path), "two")
    assert audit.stored_checks(spark, str(tmp_path)).count() == 3
    card = audit.scorecard(audit.stored_checks(spark, str(tmp_path), "two"))
    assert tuple(card.first()) == (1, 0, 1, 2, "MEDIUM", "MEDIUM") and "Scan" in plan(card)


CONTENT = [(1, "a", 1.0), (1, "a", 1.0), (2, None, float("nan")), (None, "c", None), (3, "d", 0.0), (4, "e", 5.0)]


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_content_differences(spark, buckets):
    left = spark.createDataFrame(CONTENT, "k int, s string, v double")
    assert content_differences(left, left.select("v", "s", "k").repartition(3), ["k"], buckets).count() == 0
    right = spark.createDataFrame([(1, "a", 1.0), (2, None, float("nan")), (None, "c", 2.0), (3, "d", -0.0), (5, "e", 5.0)], left.schema)
    assert rows(content_differences(left, right, ["k"], buckets)) == [
        (None, 1, 1, "changed"), (1, 2, 1, "changed"), (4, 1, 0, "left only"), (5, 0, 1, "right only")]
    assert rows(content_differences(left.limit(0), left.filter("k = 4"), ["k"], buckets)) == [(4, 0, 1, "right only")]
    swapped = left.withColumn("s", F.when(F.col("k") == 4, None).otherwise(F.col("s")))
    assert rows(content_differences(left, swapped, ["k", "s"], buckets).select("k", "s", "change")) == [(4, None, "right only"), (4, "e", "left only")]


def test_content_needs_the_same_columns(spark):
    df = spark.range(3)
    with pytest.raises(ValueError, match="different columns"):
        content_differences(df, df.withColumnRenamed("id", "k"), ["id"])

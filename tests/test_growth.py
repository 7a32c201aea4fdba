import random

import pytest

from siftmark.operators import latest
from siftmark.operators.growth import growth_metrics, with_growth
from siftmark.operators.latest import compare_back
from siftmark.spec import MarketSpec
from util import SPEC, rows

SCHEMA = "iso3_code string, market_year bigint, domestic_consumption double"


def test_rows_back_and_exact_periods_differ_on_gaps(spark):
    periods = [1995, 1996, 1998, 2000, 2001, 2002]
    df = spark.createDataFrame([("A", p, float(p - 1990)) for p in periods], SCHEMA)
    by_row = {r.market_year: r.consumption_5y_ago for r in growth_metrics(df, SPEC).collect()}
    exact = {r.market_year: r.consumption_5y_ago for r in growth_metrics(df, SPEC, exact_period=True).collect()}
    assert {p: v for p, v in by_row.items() if v is not None} == {2002: 5.0}
    assert {p: v for p, v in exact.items() if v is not None} == {2000: 5.0, 2001: 6.0}


def test_lag_skips_zero_and_unknown(spark):
    values = [1.0, 0.0, 2.0, 3.0, None, 4.0, 5.0, 6.0]
    df = spark.createDataFrame([("A", 2000 + i, v) for i, v in enumerate(values)], SCHEMA)
    last = max(growth_metrics(df, SPEC).collect(), key=lambda r: r.market_year)
    assert last.consumption_5y_ago == 1.0
    assert last.consumption_cagr_5y == pytest.approx(6 ** 0.2 - 1)
    assert last.consumption_10y_ago is None and last.consumption_cagr_10y is None


def test_one_pass_equals_the_join(spark):
    """LAG ... IGNORE NULLS against a left join with the filtered growth series."""
    rng = random.Random(3)
    spec = MarketSpec(lags=(1, 3))
    data = [
        (e, p, rng.choice([None, 0.0, -1.0, 1.0, 2.0, 5.0]))
        for e in "ABCDEFGH" for p in range(1990, 2020) if rng.random() < 0.7
    ]
    df = spark.createDataFrame(data, SCHEMA)
    joined = df.join(
        growth_metrics(df, spec).select("iso3_code", "market_year", "consumption_cagr_1y", "consumption_cagr_3y"),
        ["iso3_code", "market_year"], "left",
    )
    assert rows(with_growth(df, spec)) == rows(joined)


def test_headline_prefers_rows_with_population(spark):
    df = spark.createDataFrame(
        [("A", 2023, 1.0), ("A", 2024, 2.0), ("A", 2025, None), ("B", 2020, None), ("B", 2021, None)],
        "e string, p int, pop double",
    )
    assert rows(latest.headline_rows(df, "e", "p", "pop")) == [("A", 2024, 2.0), ("B", 2021, None)]


def test_latest_n(spark):
    df = spark.createDataFrame([("A", p) for p in range(5)] + [("B", 9)], "e string, p int")
    assert rows(latest.latest_n(df, "e", "p", 2)) == [("A", 3), ("A", 4), ("B", 9)]


def test_compare_back(spark):
    df = spark.createDataFrame([(p, float(p)) for p in range(2000, 2007)], "p int, v double")
    row = compare_back(df, "p", "v", 5).first()
    assert (row.p, row.latest, row.earlier, row.rose) == (2006, 2006.0, 2001.0, True)
    assert compare_back(df, "p", "v", 50).count() == 0


def test_first_and_last(spark):
    df = spark.createDataFrame([(2, 20.0), (1, 10.0), (3, 30.0)], "p int, v double")
    assert latest.first_and_last(df, "p", ["v"]).first().asDict() == {
        "first_p": 1, "last_p": 3, "first_v": 10.0, "last_v": 30.0, "periods": 3
    }

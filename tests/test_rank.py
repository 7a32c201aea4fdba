import math
import random
import re
from bisect import bisect_left

import pytest
from pyspark.sql import functions as F

from siftmark.operators.rank import component_leaders, percent_ranks
from util import plan, rows


def brute(values):
    """PERCENT_RANK ascending, NaN above infinity, NULL last."""
    key = [(2, 0.0) if v is None else (1, 0.0) if math.isnan(v) else (0, v) for v in values]
    ordered = sorted(key)
    n = len(values)
    return [bisect_left(ordered, k) / (n - 1) if n > 1 else 0.0 for k in key]


CASES = {
    "ties": [10.0, 20.0, 20.0, 40.0],
    "one": [7.0],
    "equal": [5.0, 5.0, 5.0],
    "signed zero": [0.0, -0.0, 1.0, -1.0],
    "unknown": [None, 1.0, float("nan"), float("inf"), float("-inf"), None, 1.0],
    "only unknown": [None, None],
    "two values": [1.0, 2.0],
}


@pytest.mark.parametrize("name", CASES)
def test_cases(spark, name):
    values = CASES[name]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    got = [r["p"] for r in percent_ranks(df, {"p": "v"}).orderBy("id").collect()]
    assert got == pytest.approx(brute(values))


def test_empty(spark):
    df = spark.createDataFrame([], "id int, v double")
    assert percent_ranks(df, {"p": "v"}).count() == 0
    assert percent_ranks(df, {"p": "v"}, within=["id"]).count() == 0


@pytest.mark.parametrize("partitions", [1, 9])
def test_ranks_equal_brute_force_under_skew(spark, partitions):
    """A third of the rows share one value, another metric has three values only."""
    rng = random.Random(5)
    data = [
        (i, -1.0 if rng.random() < 0.34 else rng.gauss(0, 1), float(rng.randrange(3)),
         None if rng.random() < 0.2 else round(rng.expovariate(1), 2))
        for i in range(5000)
    ]
    df = spark.createDataFrame(data, "id int, a double, b double, c double")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        out = percent_ranks(df, {"pa": "a", "pb": "b", "pc": "c"}).orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for i, c in enumerate("abc"):
        assert [r[f"p{c}"] for r in out] == pytest.approx(brute([d[i + 1] for d in data]))


@pytest.mark.parametrize("least", [1, 60, 91, 1000])
def test_frequent_values_are_not_shuffled_by_value(spark, monkeypatch, least):
    """Whatever counts as frequent, ranks are the same; frequent values meet their rows by broadcast."""
    monkeypatch.setattr("siftmark.operators.rank.FREQUENT", least)
    values = [1.0] * 300 + [None] * 90 + [float("nan")] * 60 + [float(i) for i in range(150)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    ranked = percent_ranks(df, {"p": "v"})
    assert [r.p for r in ranked.orderBy("id").collect()] == pytest.approx(brute(values))
    text = plan(ranked)
    assert text.count("BroadcastExchange") >= 3 and "LeftAnti" in text


def test_groups_are_ranked_apart(spark):
    rng = random.Random(8)
    data = [(i, rng.choice(["x", "y", None]), None if rng.random() < 0.1 else float(rng.randrange(9))) for i in range(400)]
    data += [(1000, "alone", 3.0), (1001, "equal", float("nan")), (1002, "equal", float("nan"))]
    df = spark.createDataFrame(data, "id int, g string, v double")
    got = {r.id: r.p for r in percent_ranks(df, {"p": "v"}, within=["g"]).collect()}
    for g in {d[1] for d in data}:
        ids = [d[0] for d in data if d[1] == g]
        assert [got[i] for i in ids] == pytest.approx(brute([d[2] for d in data if d[1] == g]))


def test_one_plan_for_every_size(spark):
    """Nothing in the plan depends on the number of rows, and no task holds all of them."""
    def shape(n):
        text = plan(percent_ranks(spark.range(n).select("id", F.col("id").cast("double").alias("v")), {"p": "v", "q": "id"}))
        assert "SinglePartition" not in text
        return re.sub(r"#\d+L?|file:\S+|plan_id=\d+|\(\d+ paths\)", "", text)

    # which side of a join Spark itself broadcasts is up to the bytes of that side
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, -1)
    try:
        assert shape(10) == shape(1_000_000)
    finally:
        spark.conf.set(name, before)


def test_ranks_across_ranges(spark):
    df = spark.range(1000).select("id", F.col("id").cast("double").alias("v"))
    assert [r["p"] for r in percent_ranks(df, {"p": "v"}).orderBy("id").collect()] == pytest.approx([i / 999 for i in range(1000)])


def test_output_columns_and_repeated_rows(spark):
    df = spark.createDataFrame([(1.0, "a", 9), (1.0, "a", 9), (2.0, None, 9)], "v double, s string, p int")
    out = percent_ranks(df, {"p": "v", "q": -F.col("v")})
    assert out.columns == ["v", "s", "p", "q"]
    assert rows(out) == [(1.0, "a", 0.0, 0.5), (1.0, "a", 0.0, 0.5), (2.0, None, 1.0, 0.0)]


def test_leaders(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("b", 3.0, 5.0), ("c", 3.0, None)], "e string, x double, y double")
    assert rows(component_leaders(df, "e", {"x": "x", "y": "y"})) == [("x", "b"), ("y", "a")]
    assert rows(component_leaders(df, "e", {"x": "x", "y": "y"}, direction="lowest")) == [("x", "a"), ("y", "a")]


def test_infinities_and_nan_have_places_of_their_own(spark):
    values = [float("nan"), float("inf"), float("-inf"), 1.0, None, float("inf"), -1.7e308, 1.7e308]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    got = {r.id: r.p for r in percent_ranks(df, {"p": "v"}).collect()}
    assert got == pytest.approx({2: 0, 6: 1 / 7, 3: 2 / 7, 7: 3 / 7, 1: 4 / 7, 5: 4 / 7, 0: 6 / 7, 4: 1})

import random

import pytest

from siftmark.operators.joins import fill_from_lookup, lookup_join, orphans
from siftmark.operators.reconcile import label_lookup, method_counts, name_mapping, resolve_codes
from util import rows


@pytest.fixture(scope="module")
def labels(spark):
    codes = spark.createDataFrame(
        [(1, "Brazil", "BRA"), (2, "Viet Nam", "VNM"), (3, "brazil ", "BRX"), (4, None, "ZZZ"), (5, "Empty", " "), (6, "Egypt", "XXX")],
        "n int, label string, code string",
    )
    return label_lookup(codes, "label", "code", "n")


def test_precedence(spark, labels):
    names = ["Other", "Vietnam", " BRAZIL ", "Nowhere", "Vietnam ", "Empty", "Egypt", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: (r.iso3_code, r.match_method) for r in resolve_codes(df, "name", labels).collect()}
    assert got == {
        "Other": (None, "excluded"),
        "Vietnam": ("VNM", "manual_override"),
        " BRAZIL ": ("BRX", "exact_match"),  # the later label row wins
        "Nowhere": (None, "unmapped"),
        "Vietnam ": (None, "unmapped"),  # overrides match exactly
        "Empty": (None, "unmapped"),
        "Egypt": ("EGY", "manual_override"),  # before the label
        None: (None, "unmapped"),
    }


def test_report_has_one_row_per_name(spark, labels):
    df = spark.createDataFrame([("Brazil",)] * 50 + [("Other",), (None,)], "name string")
    mapping = name_mapping(df, "name", labels)
    assert rows(method_counts(mapping)) == [("exact_match", 1), ("excluded", 1)]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_with_a_hot_key(spark, how):
    """One key holds a third of the facts, some facts have no key or no match."""
    rng = random.Random(1)
    keys = [7 if rng.random() < 0.34 else rng.choice([None, *range(40)]) for _ in range(3000)]
    facts = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int")
    lookup = spark.createDataFrame([(k, f"v{k}") for k in range(0, 30)], "k int, v string")
    expected = rows(facts.join(lookup, "k", how), "i")
    assert rows(lookup_join(facts, lookup, "k", how), "i") == expected


def test_lookup_join_with_two_keys(spark):
    facts = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "a", 3)], "k int, s string, i int")
    lookup = spark.createDataFrame([(1, "a", 10.0), (2, "a", 20.0)], "k int, s string, v double")
    got = lookup_join(facts, lookup, ["k", "s"], "left")
    assert rows(got.select("i", "v")) == [(1, 10.0), (2, None), (3, 20.0)]


def test_backfill_sets_both_from_the_lookup(spark):
    dim = spark.createDataFrame(
        [("A", None, "X"), ("B", "R", None), ("C", "R", "X"), ("D", None, None)], "k string, region string, continent string"
    )
    lookup = spark.createDataFrame([("A", "Asia"), ("B", "Asia"), ("C", "Asia")], "k string, c string")
    filled = fill_from_lookup(dim, lookup, "k", "c", ["region", "continent"])
    assert rows(filled) == [("A", "Asia", "Asia"), ("B", "Asia", "Asia"), ("C", "R", "X"), ("D", None, None)]


def test_orphans(spark):
    facts = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    dim = spark.createDataFrame([("b",), ("b",)], "k string")
    assert rows(orphans(facts, dim, "k")) == [("a",)]

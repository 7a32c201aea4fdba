import pytest

from siftmark.functions import columns as c
from siftmark.functions import labels
from util import SPEC, rows


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) else 'double'}" for k, v in values.items()) or "x int"
    df = spark.createDataFrame([tuple(values.values()) or (1,)], schema)
    return df.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("text, number", [("12.5", 12.5), (" 7 ", 7.0), ("n/a", None), ("", None), ("nan", None)])
def test_to_double(spark, text, number):
    assert one(spark, c.to_double("x"), x=text) == number


@pytest.mark.parametrize("text, number", [("2020", 2020), ("2020.0", 2020), (" 7", 7), ("2020.5", None), ("x", None), ("", None)])
def test_to_long(spark, text, number):
    assert one(spark, c.to_long("x"), x=text) == number


def test_strip_takes_all_whitespace(spark):
    text = "\t   Brazil 　\n"
    assert one(spark, c.strip("x"), x=text) == text.strip() == "Brazil"
    assert one(spark, c.match_key("x"), x=text) == "brazil"


def test_sentinels(spark):
    for text, kept in [("nan", None), ("None", None), ("", None), ("NA", "NA")]:
        assert one(spark, c.sentinels_to_null("x"), x=text) == kept


def test_per_capita(spark):
    kg = c.per_population("m", "p", 60_000.0)
    assert one(spark, kg, m=25_000.0, p=300_000_000.0) == 5.0
    assert one(spark, c.per_population("m", "p", 1e6), m=25_000.0, p=3e8) == pytest.approx(83.3333, abs=1e-4)
    assert one(spark, kg, m=25_000.0, p=0.0) is None
    assert one(spark, kg, m=25_000.0, p=None) is None


def test_cagr(spark):
    assert one(spark, c.cagr("a", "b", 5), a=161.051, b=100.0) == pytest.approx(0.10)
    assert one(spark, c.cagr("a", "b", 5), a=161.051, b=0.0) is None
    assert one(spark, c.cagr("a", "b", 5), a=161.051, b=None) is None


def test_ratio_and_gap(spark):
    assert one(spark, c.ratio_if_positive("a", "b"), a=3.0, b=2.0) == 1.5
    assert one(spark, c.ratio_if_positive("a", "b"), a=3.0, b=0.0) is None
    assert one(spark, c.gap_pct("a", "b"), a=0.0, b=0.5) == 50.0


def test_export_value(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "x double")
    assert [r[0] for r in df.select(c.export_value("x", "double")).collect()] == [1.5, None, None, None, None]


def test_labels(spark):
    assert one(spark, labels.pct("x"), x=0.1234) == "12.3%"
    assert one(spark, labels.pct("x", 0), x=1.0) == "100%"
    assert one(spark, labels.millions("x"), x=117_300_000.0) == "117M"
    assert one(spark, labels.number("x"), x=1234567.4) == "1,234,567"
    assert one(spark, labels.number("x", 2), x=4.6) == "4.60"
    for label in (labels.pct("x"), labels.millions("x"), labels.number("x")):
        assert one(spark, label, x=None) == "N/A"


def test_narrative_leaves_out_unknown_parts(spark):
    df = spark.createDataFrame([(1, 0.106, 0.54), (2, None, 1.0), (3, 0.1, None)], "r int, g double, i double")
    text = [r[0] for r in df.select(labels.narrative("r", "g", "i")).collect()]
    assert text[0].endswith("5Y CAGR at 10.6%. Import dependency near 54%.")
    assert text[0].startswith("Scale leader")
    assert "CAGR" not in text[1] and text[1].endswith("near 100%.")
    assert text[2].startswith("Attractive demand") and "Import" not in text[2]


def test_reason_counts_unknown_as_zero(spark):
    df = spark.createDataFrame(
        [("Egypt", 1500.0, 117e6, None, 1.0)],
        "country_name string, domestic_consumption double, population double, g double, i double",
    )
    assert df.select(labels.reason(SPEC, "g", "i")).first()[0] == (
        "Egypt: size=1,500, growth=0.0%, pop=117M, import_dep=100%"
    )


def test_notes(spark):
    df = spark.createDataFrame([("A",), ("B",)], "n string")
    assert rows(df.select(labels.note_for("n", {"A": "own"}))) == sorted([("own",), (labels.DEFAULT_NOTE,)])
    assert df.select(labels.note_for("n", {})).distinct().count() == 1

"""Latest, first and last rows of a series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_valid(rows: DataFrame, entity: str, period: str, valid: Column) -> DataFrame:
    """Rows of each entity's latest period among the rows that are ``valid``.

    Written as a window over the entity so that it shares the exchange and sort of a lag
    that ran before it; no self-join.
    """
    candidates = F.when(valid, F.col(period))
    latest = F.max(candidates).over(Window.partitionBy(entity))
    return rows.withColumn("_latest", latest).filter(F.col(period) == F.col("_latest")).drop("_latest")


def headline_rows(rows: DataFrame, entity: str, period: str, companion: str) -> DataFrame:
    """One row per entity: the latest with ``companion`` known, else the latest."""
    return _first_n(rows, entity, [F.col(companion).isNotNull().desc(), F.col(period).desc()], 1)


def latest_n(rows: DataFrame, entity: str, period: str, n: int) -> DataFrame:
    """The latest n rows of every entity."""
    return _first_n(rows, entity, [F.col(period).desc()], n)


def _first_n(rows: DataFrame, entity: str, order: Sequence[Column], n: int) -> DataFrame:
    """First n rows per entity.

    The rank limit is applied in every map task first, so at most n rows per entity and
    task are shuffled.
    """
    w = Window.partitionBy(entity).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def first_and_last(rows: DataFrame, period: str, values: Sequence[str]) -> DataFrame:
    """One row with the first and last period and the values there."""
    cells = [F.min(period).alias(f"first_{period}"), F.max(period).alias(f"last_{period}")]
    for v in values:
        cells += [F.min_by(v, period).alias(f"first_{v}"), F.max_by(v, period).alias(f"last_{v}")]
    return rows.agg(*cells, F.count(F.lit(1)).alias("periods"))


def compare_back(rows: DataFrame, period: str, value: str, n: int) -> DataFrame:
    """Latest row of a per-period table against the row n before it; no row if there is none.

    The input has one row per period, so the window over all of it is small.
    """
    w = Window.orderBy(period)
    pair = rows.select(F.col(period), F.col(value).alias("latest"), F.lag(value, n).over(w).alias("earlier"),
                       F.lag(period, n).over(w).alias(f"earlier_{period}"))
    return (
        pair.orderBy(F.col(period).desc()).limit(1)
        .filter(F.col(f"earlier_{period}").isNotNull())
        .withColumn("rose", F.col("latest") > F.col("earlier"))
    )

"""Growth over earlier rows of an entity's series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftmark.functions.columns import cagr
from siftmark.spec import MarketSpec


def ago(spec: MarketSpec, n: int) -> str:
    return f"consumption_{n}y_ago"


def cagr_name(n: int) -> str:
    return f"consumption_cagr_{n}y"


def _positive(spec: MarketSpec) -> Column:
    c = F.col(spec.consumption)
    return F.when(c > 0, c)


def growth_metrics(fact: DataFrame, spec: MarketSpec, *, exact_period: bool = False) -> DataFrame:
    """Earlier values and compound growth per entity over rows with positive consumption.

    The default counts rows back, so a gap in the series makes the span longer;
    ``exact_period`` looks up the value exactly n periods earlier instead.
    The input is at (entity, period) grain, so one window group holds at most one row per
    period however many source rows the entity has.
    """
    series = fact.select(*spec.keys, spec.consumption).filter(F.col(spec.consumption) > 0)
    w = Window.partitionBy(spec.entity).orderBy(spec.period)
    lags = {}
    for n in spec.lags:
        if exact_period:
            lags[ago(spec, n)] = F.max(spec.consumption).over(w.rangeBetween(-n, -n))
        else:
            lags[ago(spec, n)] = F.lag(spec.consumption, n).over(w)
    out = series.withColumns(lags)
    return out.withColumns({cagr_name(n): cagr(spec.consumption, ago(spec, n), n) for n in spec.lags})


def with_growth(rows: DataFrame, spec: MarketSpec) -> DataFrame:
    """Add growth to frames that also keep rows without positive consumption.

    Equal to a left join with ``growth_metrics`` on (entity, period), but in one window
    pass: LAG ... IGNORE NULLS over the positive values skips the rows that
    ``growth_metrics`` filters out.
    """
    over = f"OVER (PARTITION BY `{spec.entity}` ORDER BY `{spec.period}`)"
    lagged = rows.withColumn("_positive", _positive(spec)).withColumns({
        f"_ago_{n}": F.expr(f"LAG(_positive, {n}) IGNORE NULLS {over}") for n in spec.lags
    })
    return lagged.withColumns({
        cagr_name(n): F.when(F.col("_positive").isNotNull(), cagr("_positive", f"_ago_{n}", n))
        for n in spec.lags
    }).drop("_positive", *[f"_ago_{n}" for n in spec.lags])

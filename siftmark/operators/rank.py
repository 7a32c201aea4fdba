"""PERCENT_RANK over a whole set or within groups, and leading entities.

Ranks come from the distinct values, never from sorted rows: occurrences are counted by (group, metric,
value), combined before the shuffle; the distinct values are range-partitioned in order; each range
has a running count of its own, and the totals of the ranges before it are added. One plan serves sets of any
size, and a frequent value is one row of the sorted table. Where rows meet their values, frequent ones are broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftmark.sources.scratch import written

#: Occurrences from which a value is frequent: a table has at most its cells divided by this of them.
FREQUENT = 100_000


def percent_ranks(df: DataFrame, ranks: Mapping[str, str | Column], *, within: Sequence[str] = ()) -> DataFrame:
    """Add one PERCENT_RANK column per entry of ``ranks`` (output name -> metric).

    Ascending, NaN above infinity, NULLs last, ties share the lowest rank, a single row gets 0.
    ``within`` names columns whose values form groups that are ranked apart, all in the same pass.
    The rows are written to the shared folder with a number once, and so are the ordered distinct
    values; only numbers, groups and values are shuffled by value, the other columns once, by
    number. Rows with a frequent value (FREQUENT occurrences) get its rank where they are read, so that no
    task holds all rows of a value that many share. Starts these writes while it is called.
    """
    cells = [
        F.struct(F.lit(i).alias("metric"), (F.col(m) if isinstance(m, str) else m).cast("double").alias("value"))
        for i, m in enumerate(ranks.values())
    ]
    group = F.struct(*[F.col(c) for c in within]) if within else F.lit(0)
    rows = written(df.withColumns({
        "_row": F.monotonically_increasing_id(), "_group": group, "_cells": F.array(*cells),
    }))
    long = rows.select("_row", "_group", F.inline("_cells"))
    places = written(value_ranks(long, ["_group", "metric"], "value"))
    keys = ["_group", "metric", "value"]
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys]
    frequent = F.col("n") >= FREQUENT
    often, seldom = F.broadcast(places.filter(frequent)).alias("p"), places.filter(~frequent).alias("p")
    found = ["l._row", "l.metric", "p.share"]
    rest = long.alias("l").join(often, same, "left_anti").alias("l")
    placed = long.alias("l").join(often, same).select(*found).unionByName(rest.join(seldom, same).select(*found))
    # a row's cells meet in the reduce tasks only: row numbers hardly repeat in a task before, and would fill its memory
    wide = placed.repartition("_row").groupBy("_row").agg(*[
        F.max(F.when(F.col("metric") == i, F.col("share"))).alias(name) for i, name in enumerate(ranks)
    ])
    return rows.drop("_group", "_cells", *ranks).join(wide, "_row").select(
        *[c for c in df.columns if c not in ranks], *ranks)


def value_ranks(long: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """``share``: the PERCENT_RANK of every distinct value of each group of a long frame; ``n``: its occurrences."""
    counts = long.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("n"))
    order = [*groups, F.col(value).asc_nulls_last()]
    ranged = written(
        counts.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    # one row a range and group: as many as there are partitions, and groups
    totals = ranged.groupBy(*groups, "_range").agg(F.sum("n").alias("_in_range"))
    by_range = Window.partitionBy(*groups).orderBy("_range")
    offsets = totals.select(
        *groups, "_range",
        (F.sum("_in_range").over(by_range) - F.col("_in_range")).alias("_before"),
        F.sum("_in_range").over(Window.partitionBy(*groups)).alias("_all"),
    )
    inside = Window.partitionBy(*groups, "_range").orderBy(F.col(value).asc_nulls_last())
    running = ranged.withColumn("_lower", F.sum("n").over(inside) - F.col("n"))
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}")) for k in [*groups, "_range"]]
    share = F.when(F.col("_all") > 1, (F.col("_before") + F.col("_lower")) / (F.col("_all") - 1).cast("double"))
    return running.alias("r").join(offsets.alias("o"), same).select(
        *[F.col(f"r.{k}") for k in [*groups, value]], "n", F.coalesce(share, F.lit(0.0)).alias("share"))


def component_leaders(
    df: DataFrame, entity: str, metrics: Mapping[str, str | Column], *, direction: str = "highest"
) -> DataFrame:
    """Leading entity per component; ties go to the smaller entity.

    ``direction="lowest"`` picks the entity with the smallest value instead. One global
    aggregate for all components, with partial results per task.
    """
    if direction not in ("highest", "lowest"):
        raise ValueError("direction is 'highest' or 'lowest'")
    leaders = []
    for component, m in metrics.items():
        value = F.col(m) if isinstance(m, str) else m
        key = value if direction == "lowest" else -value
        leaders.append(F.min_by(F.col(entity), F.when(value.isNotNull(), F.struct(key, F.col(entity)))).alias(component))
    one = df.agg(*leaders)
    return one.unpivot([], list(metrics), "component", entity)

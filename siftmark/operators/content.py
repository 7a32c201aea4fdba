"""Tables compared by what they hold, without regard to the order of rows or columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftmark.functions.columns import value_hashes

#: Differences are looked for in the key buckets whose digests differ.
BUCKETS = 4096


def row_hashes(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row; equal rows have equal ones, whatever the order of the columns."""
    types = dict(df.dtypes)
    cells = [value_hashes(c, types[c]) for c in sorted(columns)]
    # a hash over several values leaves nulls out, so each cell is hashed first and a null has a number of its own
    return [F.xxhash64(*[F.coalesce(cell[k], F.lit(i)) for i, cell in enumerate(cells)]) for k in (0, 1)]


def digest_of(first: str, second: str, only: Column | None = None) -> list[Column]:
    """Order-free aggregates of row hashes: rows, sum of 31 bits of the one, exclusive or of the other."""
    def rows(c: Column) -> Column:
        return c if only is None else F.when(only, c)

    return [F.count(rows(F.lit(1))), F.coalesce(F.sum(rows(F.pmod(F.col(first), F.lit(1 << 31)))), F.lit(0)),
            F.coalesce(F.bit_xor(rows(F.col(second))), F.lit(0))]


def content_digest(df: DataFrame) -> DataFrame:
    """One row: ``rows``, ``sum_hash``, ``xor_hash`` of all rows, as a multiset."""
    first, second = row_hashes(df, df.columns)
    names = ("rows", "sum_hash", "xor_hash")
    return df.select(first.alias("h0"), second.alias("h1")).agg(*[c.alias(n) for c, n in zip(digest_of("h0", "h1"), names)])


def content_differences(left: DataFrame, right: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Keys whose rows differ between two tables of the same columns: rows on each side, and the kind of change.

    Digests of a bounded number of key buckets are compared first, combined within each task, so nothing but
    them is shuffled for the parts that agree. Only rows of buckets that differ are then grouped by key. Rows that
    repeat count, NULL keys are keys too.
    """
    if sorted(left.dtypes) != sorted(right.dtypes):
        raise ValueError(f"the tables have different columns: {sorted(set(left.dtypes) ^ set(right.dtypes))}")
    if clash := {"h0", "h1", "_left", "_bucket"} & set(left.columns):
        raise ValueError(f"columns with names in use: {sorted(clash)}")

    def hashed(df: DataFrame, is_left: bool) -> DataFrame:
        first, second = row_hashes(df, df.columns)
        key, _ = row_hashes(df, keys)
        return df.select(*keys, first.alias("h0"), second.alias("h1"), F.lit(is_left).alias("_left"), F.pmod(key, F.lit(buckets)).alias("_bucket"))

    both = hashed(left, True).unionByName(hashed(right, False))
    sides = [digest_of("h0", "h1", F.col("_left")), digest_of("h0", "h1", ~F.col("_left"))]
    named = [c.alias(f"{side}{k}") for side, parts in zip(("left", "right"), sides) for k, c in enumerate(parts)]
    differ = (F.col("left0") != F.col("right0")) | (F.col("left1") != F.col("right1")) | (F.col("left2") != F.col("right2"))
    # at most ``buckets`` rows
    changed = both.groupBy("_bucket").agg(*named).filter(differ).select("_bucket")
    found = both.join(F.broadcast(changed), "_bucket", "left_semi").groupBy(*keys).agg(*named).filter(differ)
    change = F.when(F.col("right0") == 0, "left only").when(F.col("left0") == 0, "right only").otherwise("changed")
    return found.select(*keys, F.col("left0").alias("left_rows"), F.col("right0").alias("right_rows"), change.alias("change"))

"""Column expressions: cleaning, guarded ratios and market formulas.

Everything here is a built-in expression, so it stays inside whole-stage codegen.
ANSI mode raises on bad casts and on division by zero; every parse goes through
``try_cast`` and every division is guarded.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that str.strip() removes.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    return F.trim(col(c), F.lit(WHITESPACE))


def match_key(c: str | Column) -> Column:
    """Key for case-insensitive, whitespace-insensitive name matching."""
    return F.lower(strip(c))


def sentinels_to_null(c: str | Column, sentinels: Sequence[str] = ("nan", "None", "")) -> Column:
    return F.when(~col(c).isin(*sentinels), col(c))


def to_double(c: str | Column) -> Column:
    """Number or NULL; text that is not a number, and NaN, become NULL."""
    return F.nanvl(strip(c).try_cast("double"), F.lit(None).cast("double"))


def to_long(c: str | Column) -> Column:
    """Integer or NULL; accepts text such as ``2020`` and ``2020.0``."""
    return F.regexp_replace(strip(c), r"\.0+$", "").try_cast("bigint")


def contains_any(c: str | Column, tokens: Iterable[str]) -> Column:
    lowered = F.lower(col(c))
    return reduce(lambda a, b: a | b, [lowered.contains(t.lower()) for t in tokens])


def null_or_zero(c: str | Column) -> Column:
    return col(c).isNull() | (col(c) == 0)


def zero_if_null(c: str | Column) -> Column:
    return F.coalesce(col(c), F.lit(0.0))


def per_population(measure: str | Column, population: str | Column, factor: float) -> Column:
    m, p = col(measure), col(population)
    return F.when((p > 0) & m.isNotNull(), m * F.lit(factor) / p)


def difference(a: str | Column, b: str | Column) -> Column:
    return col(a) - col(b)


def ratio_if_positive(num: str | Column, den: str | Column) -> Column:
    n, d = col(num), col(den)
    return F.when((d > 0) & n.isNotNull(), n / d)


def cagr(now: str | Column, before: str | Column, periods: float | Column) -> Column:
    """Compound growth per period; NULL unless the earlier value is positive."""
    n, b = col(now), col(before)
    exponent = F.lit(1.0) / periods if isinstance(periods, Column) else F.lit(1.0 / periods)
    return F.when(b > 0, F.pow(n / b, exponent) - F.lit(1.0))


def gap_pct(a: str | Column, b: str | Column, floor: float = 1.0) -> Column:
    """Gap between a and b as a percentage of a, where a counts as at least ``floor``."""
    return F.abs(col(a) - col(b)) / F.greatest(col(a), F.lit(floor)) * F.lit(100.0)


def sum_of(columns: Sequence[str | Column]) -> Column:
    """Null-safe row-wise sum."""
    return reduce(lambda a, b: a + b, [zero_if_null(c) for c in columns], F.lit(0.0))


def weighted_sum(columns: Sequence[str], weights: Sequence[float]) -> Column:
    terms = [F.lit(float(w)) * F.col(c) for c, w in zip(columns, weights, strict=True)]
    return reduce(lambda a, b: a + b, terms)


def export_value(c: str | Column, dtype: str) -> Column:
    """Value as written to an export: NaN and infinities become NULL."""
    x = col(c)
    if dtype in ("double", "float"):
        return F.when(~(F.isnan(x) | (F.abs(x) == F.lit(float("inf")))), x)
    return x


def value_hashes(c: str, kind: str) -> list[Column]:
    """Two hashes of a value; both null for null. Nested values are hashed as text that shows their nulls, maps in the order of their keys."""
    value = F.array_sort(F.map_entries(c)) if kind.startswith("map<") else F.col(c)
    if kind.startswith(("map<", "array<", "struct<")):
        value = F.to_json(value, {"ignoreNullFields": "false"})
    return [F.when(value.isNotNull(), F.xxhash64(*salt, value)) for salt in ([], [F.lit("second")])]

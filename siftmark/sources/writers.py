"""Writing tables and exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftmark.functions.columns import export_value
from siftmark.operators.content import content_digest
from siftmark.sources.readers import read_csv
from siftmark.sources.scratch import written


def in_order(df: DataFrame, sort_by: Sequence[str]) -> DataFrame:
    """Rows range-partitioned and sorted, so that file and row-group statistics prune filters on these columns.

    Give it the whole grain, so that no key value is hot.
    """
    return df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by) if sort_by else df


def write_table(df: DataFrame, path: str, sort_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Replace the table at ``path``, its rows in the order of ``sort_by``."""
    writer = in_order(df, sort_by).write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(
            header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    writer.save(path)


def save_as_table(df: DataFrame, name: str, path: str | None = None, sort_by: Sequence[str] = ()) -> None:
    """Replace a catalog table; with ``path`` its files are there and stay when it is dropped."""
    writer = in_order(df, sort_by).write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def register_views(views: Mapping[str, DataFrame]) -> None:
    """Name the frames as temporary views; the optimizer inlines them where they are used."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def normalise_for_export(df: DataFrame) -> DataFrame:
    """NaN and infinities to NULL."""
    return df.select(*[export_value(c, t).alias(c) for c, t in df.dtypes])


def export_text(df: DataFrame) -> DataFrame:
    """Every column as export text: numbers at 15 significant digits, NULL stays NULL."""
    clean = normalise_for_export(df)
    return clean.select(*[
        (significant_digits(c) if t in ("double", "float") else F.col(c).cast("string")).alias(c)
        for c, t in clean.dtypes
    ])


def significant_digits(c: str, digits: int = 15) -> Column:
    """Double rounded to ``digits`` significant digits, as shortest text without exponent padding."""
    x = F.col(c)
    # %e always carries the wanted number of significant digits; reading it back gives the
    # nearest double, whose text form has no trailing zeros.
    rounded = F.format_string(f"%.{digits - 1}e", x).try_cast("double")
    whole = (rounded == F.floor(rounded)) & (F.abs(rounded) < F.lit(1e15))
    return F.when(whole, rounded.cast("bigint").cast("string")).otherwise(rounded.cast("string"))


def export_tables(tables: Mapping[str, DataFrame], folder: str) -> DataFrame:
    """Export every table as CSV, read it back, and compare rows and values with the live table.

    Each table is computed once. Values are compared by content after the text is read back with the declared types:
    numbers at 15 digits, NaN and infinities as NULL, text with quotes, separators and line breaks as it was.
    """
    found = []
    for name, df in tables.items():
        live = written(export_text(df))
        write_table(live, f"{folder}/{name}", fmt="csv")
        back = read_csv(df.sparkSession, f"{folder}/{name}", keep_empty=True)
        is_live, digest = F.col("_live"), F.struct("rows", "sum_hash", "xor_hash")
        both = reduce(DataFrame.unionByName, [
            content_digest(typed(side, df)).withColumn("_live", F.lit(k == 0)) for k, side in enumerate((live, back))])
        found.append(both.agg(
            F.lit(name).alias("table_name"), F.sum(F.when(is_live, F.col("rows"))).alias("live_rows"),
            F.sum(F.when(~is_live, F.col("rows"))).alias("exported_rows"),
            (F.min("rows") == F.max("rows")).alias("equal"), (F.min(digest) == F.max(digest)).alias("equal_values")))
    return reduce(DataFrame.unionByName, found)


def typed(text: DataFrame, like: DataFrame) -> DataFrame:
    """Text columns as the types of another frame."""
    return text.select(*[F.col(c).try_cast(t).alias(c) for c, t in like.dtypes])


def write_profile(profile: Mapping[str, DataFrame], folder: str) -> None:
    """Write each part of a profile as a table of its own."""
    for name, df in profile.items():
        write_table(df, f"{folder}/{name}")

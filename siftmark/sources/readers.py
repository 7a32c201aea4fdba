"""Raw CSV readers. All columns arrive as text; types are set by explicit ``try_cast``."""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import AbstractContextManager, contextmanager, nullcontext

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftmark.sources.scratch import written

# Header, raw and analytics layers as tables.
CODES_SCHEMA = (
    "iso3_code string, iso2_code string, english_name string, "
    "region string, sub_region string, continent string"
)
LONG_FACT_SCHEMA = (
    "iso3_code string, country_name string, market_year bigint, attribute_id bigint, "
    "attribute_description string, value double, unit_description string"
)
POPULATION_SCHEMA = "country_name string, iso3_code string, year bigint, population double"


#: Place of a row: file, start of its block, running number in the task.
FILE_ORDER = ["_file", "_block", "_row"]
CSV_OPTIONS = {"quote": '"', "escape": '"'}
#: Bytes of small file blocks that one task reads.
TASK_BYTES = 32 << 20
#: What Spark's parser gives for a quoted empty field, so that it differs from a missing one.
EMPTY = "\u0001"


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files with their place, split at line feeds only.

    Spark packs blocks of files into tasks by size, so a running number alone follows
    neither the names nor the places of the files.
    """
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for a while."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def block_bytes(spark: SparkSession, size: int) -> AbstractContextManager[None]:
    """Files are read in blocks of at most so many bytes."""
    return setting(spark, "spark.sql.files.maxPartitionBytes", str(size))


def in_fewer_tasks(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """The same blocks of files, those that are small read one after another by a task instead of by a task each.

    A task gets no more than TASK_BYTES of blocks of the greatest size, and every core still gets some. Places stay as they are.
    """
    size = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    blocks = lines._jdf.rdd().getNumPartitions()
    tasks = max(-(-blocks * size // TASK_BYTES), 2 * spark.sparkContext.defaultParallelism)
    return lines.coalesce(tasks) if tasks < blocks else lines


def quote_count(c: str) -> Column:
    return F.length(c) - F.length(F.replace(F.col(c), F.lit('"'), F.lit("")))


def block_quotes(lines: DataFrame) -> DataFrame:
    """One row per file block: whether it starts inside a quoted field, and whether a field of it crosses a line end.

    The parity of the quotes in all blocks before it says where a block starts, as doubled
    quotes don't change it. The result has one row for each block of each file.
    """
    odd = F.pmod(quote_count("value"), F.lit(2))
    blocks = lines.groupBy("_file", "_block").agg(F.sum(odd).alias("_odd"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("_odd").over(before), F.lit(0)) % 2 == 1
    return blocks.select("_file", "_block", inside.alias("_inside"), (F.col("_odd") > 0).alias("_crosses"))


def _block_records(inside_blocks: dict[str, set[int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Joins the lines of each block to records and marks those that begin or end in another block.

    Lines come in the order of the scan. A task keeps its last unfinished record only.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        kept_inside = False
        for last, batch in _with_last(batches):
            lines = pa.Table.from_batches([batch]) if batch is not None else None
            if kept is not None:
                lines = pa.concat_tables([kept, lines]).combine_chunks() if lines is not None else kept
            if lines is None or not lines.num_rows:
                continue
            names = lines["_file"].combine_chunks().dictionary_encode()
            file, block = names.indices.to_numpy(), lines["_block"].to_numpy()
            new = np.append(True, (file[1:] != file[:-1]) | (block[1:] != block[:-1]))
            first = np.flatnonzero(new)
            inside_of = [inside_blocks.get(name, ()) for name in names.dictionary.to_pylist()]
            state = np.array([int(block[k]) in inside_of[file[k]] for k in first], np.int64)
            if kept is not None:  # the first lines go on from the batch before
                state[0] = kept_inside
            of = np.cumsum(new) - 1
            odd = lines["_odd"].to_numpy().astype(np.int64)
            seen = np.cumsum(odd) - odd
            inside = (state[of] + seen - seen[first][of]) % 2
            starts = np.flatnonzero(new | (inside == 0))
            ends = np.append(starts[1:], lines.num_rows)
            closed = (inside[ends - 1] + odd[ends - 1]) % 2 == 0
            if not last:  # the last record may go on in the next batch
                kept, kept_inside = lines.slice(starts[-1]), bool(inside[starts[-1]])
                starts, ends, closed = starts[:-1], ends[:-1], closed[:-1]
            if not len(starts):
                continue
            bounds = pa.array(np.append(starts, ends[-1]).astype(np.int32))
            text = pc.binary_join(pa.ListArray.from_arrays(bounds, lines["value"].combine_chunks().cast(pa.string())), "\n")
            yield pa.record_batch({
                "value": text, **{c: lines[c].combine_chunks().take(pa.array(starts)) for c in FILE_ORDER},
                "_begins": pa.array(inside[starts] == 0), "_ends": pa.array(closed),
            })

    return run


def _with_last(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch | None]]:
    for batch in batches:
        yield False, batch
    yield True, None


def csv_records(spark: SparkSession, path: str, block: int | None = None) -> tuple[DataFrame, bool]:
    """(value, _file, _block, _row): CSV records as text, where quoted fields may hold line breaks; and whether any does.

    Files are read in blocks by many tasks. Quote parities tell each block whether it starts inside
    a quoted field; it joins its own lines to records, and what a block holds of a record
    that began in an earlier one is handed back to it. Only these pieces, at most two a block,
    are shuffled. Line feeds inside quotes stay, and so do carriage returns; a record whose quote never closes
    reaches to the end of its file. If no line of the input has an open quote, records are the lines. With ``block`` the
    files, and not what is stored on the way, are read in blocks of so many bytes.
    """
    with nullcontext() if block is None else block_bytes(spark, block):
        return _csv_records(spark, path)


def _csv_records(spark: SparkSession, path: str) -> tuple[DataFrame, bool]:
    lines = in_fewer_tasks(spark, file_lines(spark, path))
    blocks = written(block_quotes(lines))
    if blocks.filter("_crosses").isEmpty():
        return lines, False
    # one row a file, with no more than one number a block
    inside = {r["_file"]: set(r["_blocks"]) for r in blocks.filter("_inside").groupBy("_file").agg(F.collect_list("_block").alias("_blocks")).collect()}
    marked = lines.withColumn("_odd", F.pmod(quote_count("value"), F.lit(2)))
    schema = "value string, _file string, _block bigint, _row bigint, _begins boolean, _ends boolean"
    found = written(marked.mapInArrow(_block_records(inside), schema))
    whole = F.col("_begins") & F.col("_ends")
    place = F.struct("_block", "_row")
    before = Window.partitionBy("_file").orderBy("_block", "_row")
    pieces = found.filter(~whole)
    # a file's pieces are put in order by their places alone: one task gets no texts but those of its records
    starts = pieces.select(*FILE_ORDER, F.last(F.when(F.col("_begins"), place), ignorenulls=True).over(before).alias("_start"))
    joined = pieces.select("value", *FILE_ORDER).join(starts, FILE_ORDER).groupBy("_file", "_start").agg(F.array_sort(F.collect_list(F.struct("_block", "_row", "value"))).alias("_parts"))
    joined = joined.select(F.array_join("_parts.value", "\n").alias("value"), "_file", "_start._block", "_start._row")
    return found.filter(whole).select("value", *FILE_ORDER).unionByName(joined), True


def parse_records(records: DataFrame, names: Sequence[str], sep: str = ",", options: Mapping[str, str] = CSV_OPTIONS) -> DataFrame:
    """Fields of CSV records by the names of the header, with the place of the record."""
    schema = ", ".join(f"`{n}` string" for n in names)
    text = F.regexp_replace("value", "\r$", "")
    row = F.from_csv(text, schema, {**options, "sep": sep, "multiLine": "true", "maxCharsPerColumn": "-1"})
    return records.filter(F.trim(text) != "").select(row.alias("row"), *FILE_ORDER).select("row.*", *FILE_ORDER)


def header_names(record: str, sep: str = ",") -> list[str]:
    names = next(csv.reader([record.rstrip("\r").lstrip("\ufeff")], delimiter=sep))
    return [n if n else f"_unnamed_{i}" for i, n in enumerate(names)]


def read_csv(spark: SparkSession, path: str, sep: str = ",", ordered: bool = False, keep_empty: bool = False, block: int | None = None) -> DataFrame:
    """CSV with a header line; columns are taken by name, so extra columns do no harm.

    Quoted fields may hold line breaks, and files are still read by many tasks: the input
    is looked through once for quotes that stay open at a line end (a job that runs here). If there are none, Spark's own
    reader takes the lines as they are; otherwise records are put together first. ``ordered`` adds the place of each row (``FILE_ORDER``).
    Empty fields are NULL; with ``keep_empty`` quoted ones are empty text. With ``block`` the files are looked through, and records
    put together, in blocks of so many bytes.
    """
    if keep_empty:
        rows = _read_csv(spark, path, sep, ordered, {**CSV_OPTIONS, "emptyValue": EMPTY}, block)
        fields = [c for c in rows.columns if c not in FILE_ORDER]
        return rows.withColumns({c: F.when(F.col(f"`{c}`") != EMPTY, F.col(f"`{c}`")).when(F.col(f"`{c}`") == EMPTY, F.lit("")) for c in fields})
    return _read_csv(spark, path, sep, ordered, CSV_OPTIONS, block)


def _read_csv(spark: SparkSession, path: str, sep: str, ordered: bool, options: Mapping[str, str], block: int | None) -> DataFrame:
    records, assembled = csv_records(spark, path, block)
    if not assembled:
        rows = spark.read.options(header=True, sep=sep, **options).csv(path)
        return rows.withColumns({
            "_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"),
            "_row": F.monotonically_increasing_id(),
        }) if ordered else rows
    first = records.filter("_block = 0").groupBy("_file").agg(F.min("_row").alias("_first"))
    headed = records.join(F.broadcast(first), "_file")  # one row a file
    is_header = (F.col("_block") == 0) & (F.col("_row") == F.col("_first"))
    [head] = headed.filter(is_header).orderBy("_file").select("value").head(1)
    rows = parse_records(headed.filter(~is_header), header_names(head.value, sep), sep, options)
    return rows if ordered else rows.drop(*FILE_ORDER)


def read_csv_after_preamble(
    spark: SparkSession, path: str, skip: int = 4, header_path: str | None = None
) -> DataFrame:
    """CSV whose header follows ``skip`` preamble lines.

    Only the first ``skip + 1`` lines come to the driver. Spark has no option to skip
    lines, so the rows are parsed from records (``csv_records``). The preamble goes by its place: it is what a
    task numbers first in the first block of the file that starts with it, so a later line
    that repeats one of its lines stays. ``header_path`` names that file when ``path`` is
    a folder. Preamble lines hold no line break; data fields in quotes may.
    """
    records, _ = csv_records(spark, path)
    head = [r.value for r in spark.read.option("lineSep", "\n").text(header_path or path).take(skip + 1)]
    if len(head) <= skip:
        raise ValueError(f"{path} has no header after {skip} preamble lines")
    # where each head line stands first in a block that begins a file: five rows for a file of one preamble
    starts = records.filter((F.col("_block") == 0) & F.col("value").isin(*head)).groupBy("_file", "value").agg(
        F.min("_row").alias("_first"))
    first = starts.groupBy("_file").agg(F.min("_first").alias("_from"), F.collect_set("value").alias("_head"))
    whole = first.filter(F.size("_head") == len(set(head))).select("_file", "_from")
    placed = records.join(F.broadcast(whole), "_file", "left")
    in_head = F.col("_row").between(F.col("_from"), F.col("_from") + skip) & (F.col("_block") == 0)
    return parse_records(placed.filter(~F.coalesce(in_head, F.lit(False))), header_names(head[skip])).drop(*FILE_ORDER)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A registered table or view by name, or a Parquet path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def resolve_headers(columns: Sequence[str], roles: Mapping[str, Sequence[str]]) -> list[str]:
    """The column of each role, by the order of its candidates; tells of all roles without one at once."""
    known = set(columns)
    found = {role: next(filter(known.__contains__, names), None) for role, names in roles.items()}
    missing = sorted(role for role, column in found.items() if column is None)
    if missing:
        raise KeyError(f"no column for {', '.join(missing)} among {sorted(known)}")
    return list(found.values())


def period_columns(columns: Sequence[str]) -> list[str]:
    """Columns whose header is all digits."""
    return [c for c in columns if c.isdigit()]

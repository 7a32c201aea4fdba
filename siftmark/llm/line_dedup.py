"""Line dedup over suffixes of line-id sequences, in built-in functions only.

A document is the sequence of the ids (128-bit hashes) of its lines that hold a word. Suffixes of these
sequences are ranked into classes by prefix doubling: the class of 2k lines at a place is made of the
classes of k lines there and k lines on. A class with one suffix is done, as nothing that is longer can
repeat; the others go into the next round, until no class has two suffixes. The classes of a round are
the LCP intervals of that depth: suffixes with so many leading lines in common. Intervals of at least
MIN_LINES lines give the repeated runs; every suffix in one but the first (least id, then least text
hash, then least place) is a later copy, and the lines that it shares are deleted. Overlapping copies
merge, so whole maximal runs go. For the deletion only class membership is needed, so the order of
suffixes inside a class is not made.

Each round is written to the shared folder. Only suffixes that still repeat take part, counts are
combined before the shuffle, and a class of any size is joined, not gathered.

Defined results: lines split at \\n; lines without a word are never deleted and do not part a run; a null
text is one empty line and stays null in deduped_lines; rows that share id and text are one document and
get the same result; rows that share only the id are ordered by the text's hash; a null id stands first;
extra columns are passed on by deduped_lines and not read otherwise; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftmark.sources.scratch import written

MIN_LINES = 2
SALT = 0x5DEECE66D
KEY = ["_doc", "_fp"]
HAS_WORD = r"[^\x20\x09-\x0D]"


def line_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_doc, _fp, i, a, b): the i-th line with a word of a document, and its 128-bit id."""
    lines = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), lambda x: x.rlike(HAS_WORD))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("_doc"),
                       F.xxhash64(text_col).alias("_fp"), F.posexplode(lines).alias("i", "line"))
    return rows.select(*KEY, "i", F.xxhash64("line").alias("a"), F.xxhash64("line", F.lit(SALT)).alias("b"))


def repeated(rows: DataFrame) -> DataFrame:
    """The suffixes whose class has another one, with `later`: an earlier one is in the class."""
    place = F.struct(*KEY, "i")
    classes = rows.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(place).alias("least")).where("n > 1").drop("n")
    return rows.join(classes, ["a", "b"]).select(*KEY, "i", "a", "b", (place > F.col("least")).alias("later"))


def extended(rows: DataFrame, shift: int) -> DataFrame:
    """Suffixes ranked by their class and the class `shift` lines on."""
    on = rows.select(*KEY, (F.col("i") - shift).alias("i"), F.col("a").alias("a2"), F.col("b").alias("b2"))
    both = rows.drop("later").join(on, [*KEY, "i"])
    return both.select(*KEY, "i", F.xxhash64("a", "a2").alias("a"), F.xxhash64("b", "b2", F.lit(SALT)).alias("b"))


def lcp_intervals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int | None = None) -> dict[int, DataFrame]:
    """For each doubled depth, the suffixes (_doc, _fp, i, later) with that many lines in common with others.

    Stops when no suffix is left, or at the greatest doubled depth that is at most `depth`.
    """
    rows = written(repeated(line_rows(docs, id_col, text_col)).dropDuplicates([*KEY, "i"]))
    out, length = {}, 1
    while not rows.isEmpty():
        out[length] = rows
        if depth is not None and 2 * length > depth:
            break
        rows = written(repeated(extended(rows, length)))
        length *= 2
    return out


def deleted_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES) -> DataFrame:
    """(_doc, _fp, gone, longest): sorted indexes of deleted lines, and the greatest depth of a later copy."""
    levels = lcp_intervals(docs, id_col, text_col)
    base = max((n for n in levels if n <= min_lines), default=0)
    if base * 2 <= min_lines or not base:  # nothing repeats over so many lines
        spark = docs.sparkSession
        return spark.createDataFrame([], "_doc long, _fp long, gone array<int>, longest int")
    whole = levels[base] if base == min_lines else repeated(extended(levels[base], min_lines - base))
    starts = whole.where("later").select(*KEY, "i", F.lit(min_lines).alias("depth"))
    for length, rows in levels.items():
        if length > min_lines:
            starts = starts.unionByName(rows.where("later").select(*KEY, "i", F.lit(length).alias("depth")))
    gone = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.sequence(F.col("i"), F.col("i") + min_lines - 1)))))
    return starts.groupBy(*KEY).agg(gone.alias("gone"), F.max("depth").alias("longest"))


def with_deletions(docs: DataFrame, id_col: str, text_col: str, min_lines: int) -> DataFrame:
    """(row, id, text, lines, gone, longest, kept): the other columns, and the text that is left."""
    gone = deleted_lines(docs, id_col, text_col, min_lines)
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns if c != text_col)).alias("row"), docs[id_col].alias("id"), docs[text_col].alias("text"),
                       F.coalesce(docs[id_col].cast("long"), F.lit(-(1 << 63))).alias("_doc"), F.xxhash64(docs[text_col]).alias("_fp"))
    rows = rows.join(gone, KEY, "left").withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n"))
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    rows = rows.withColumn("solid", F.when(F.col("gone").isNotNull(), F.filter(places, lambda p: F.get("lines", p).rlike(HAS_WORD))))
    left = F.array_except(places, F.transform("gone", lambda k: F.get("solid", k)))
    kept = F.array_join(F.transform(left, lambda p: F.get("lines", p)), "\n")
    return rows.withColumn("kept", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept))


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES) -> DataFrame:
    """Per row: id, n_lines, n_removed, longest_run (greatest doubled depth of a later copy, or 0), kept_text."""
    rows = with_deletions(docs.select(docs[id_col], docs[text_col]), id_col, text_col, min_lines)
    return rows.select(F.col("id").alias(id_col), F.size("lines").cast("long").alias("n_lines"),
                       F.coalesce(F.size("gone").cast("long"), F.lit(0)).alias("n_removed"),
                       F.coalesce("longest", F.lit(0)).cast("long").alias("longest_run"),
                       F.coalesce("kept", F.lit("")).alias("kept_text"))


def deduped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES) -> DataFrame:
    """The rows with their text less later copies, all columns; a document of which no word is left goes."""
    rows = with_deletions(docs, id_col, text_col, min_lines)
    rows = rows.where(F.col("gone").isNull() | F.col("kept").rlike(HAS_WORD))
    return rows.select(*((F.col("kept") if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns))

"""Benchmark decontamination by a prefix-filtered set join, in built-in functions only.

A window is `size` consecutive words of an item, or the whole of a shorter item. A document contains a
window only if it contains all of its words; so for the candidates it is enough to join one necessary
word of each window. Words are ordered by rarity, counted over all documents, and a window's prefix is
its rarest word, which keeps candidates few; windows with a word that no document has are left out.
A document word that equals a prefix gives the only place where the window could stand: it must not
begin before the document nor end after it (positional and length bounds), and the words there are
then compared one by one. Hit words are the union of the windows found.

The index of windows goes to every task if its measured size is at most BROADCAST_BYTES; beyond that
words are joined by a shuffle, and candidates get their document's words by a join on the document.

Defined results: a null text has no words; a null or wordless item has no window and never occurs;
items with the same id count once; every input row gets a row, also if rows repeat or share an id
(rows are told apart by id and text); a null id is an id of its own; without items nothing is hit; extra
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftmark.sources.scratch import written

WINDOW = 10
BROADCAST_BYTES = 64 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else; texts of ASCII only take the quicker way to the same."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    text = lower_ascii(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(text, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def item_windows(items: DataFrame, item_col: str, text_col: str, size: int) -> DataFrame:
    """(words, items) of each distinct window."""
    rows = items.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("w"))
    rows = rows.where(F.size("w") > 0).withColumn("len", F.least(F.size("w"), F.lit(size)))
    at = rows.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1)))
    return (at.select("item", F.slice("w", F.col("at"), F.col("len")).alias("words"))
            .groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items")))


def bounded(df: DataFrame, limit: int) -> bool:
    """Whether the rows of a written table take at most the limit of bytes in memory."""
    width = sum((F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) for c in df.columns), F.lit(128))
    return (df.agg(F.sum(width).alias("n")).first()["n"] or 0) <= limit


def prefix_index(docs: DataFrame, windows: DataFrame, small: bool) -> DataFrame:
    """(token, offset, words, items): each window by its rarest word, counted over all documents."""
    vocabulary = windows.select(F.explode("words").alias("token")).distinct()
    tokens = docs.select(F.explode("_words").alias("token"))
    counts = tokens.join(F.broadcast(vocabulary) if small else vocabulary, "token").groupBy("token").agg(F.count("*").alias("n"))
    each = windows.select("words", "items", F.posexplode("words").alias("offset", "token"))
    each = each.join(counts, "token", "left")
    rarest = each.groupBy("words").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "offset")).alias("p"), F.first("items").alias("items"))
    return rarest.where("p.n > 0").select("p.token", "p.offset", "words", "items")


def window_hits(docs: DataFrame, index: DataFrame, small: bool) -> DataFrame:
    """A row (_id, _fp, n_words, start, end, items) per window found, and one without a window per document row."""
    at, size = F.col("at"), F.size("words")
    in_bounds = (at >= 0) & (at + size <= F.col("n_words"))
    if small:
        # the empty word stands in front of every document and meets the row without a window
        mark = index.sparkSession.range(1).select(F.lit("").alias("token"), F.lit(0).alias("offset"),
                                                  *(F.lit(None).cast(index.schema[c].dataType).alias(c) for c in ("words", "items")))
        rows = docs.select("_id", "_fp", "_words", F.size("_words").alias("n_words"),
                           F.posexplode(F.concat(F.array(F.lit("")), F.col("_words"))).alias("pos", "token"))
        rows = rows.join(F.broadcast(index.unionByName(mark)), "token").withColumn("at", F.col("pos") - 1 - F.col("offset"))
        same = F.slice("_words", F.when(in_bounds, at + 1).otherwise(1), size) == F.col("words")
        rows = rows.where(F.col("words").isNull() | (in_bounds & same))
        found = F.col("words").isNotNull()
        return rows.select("_id", "_fp", "n_words", F.when(found, at).alias("start"), F.when(found, at + size).alias("end"), "items")
    light = docs.select("_id", "_fp", F.size("_words").alias("n_words"), F.posexplode("_words").alias("pos", "token"))
    light = light.join(index, "token").withColumn("at", F.col("pos") - F.col("offset")).where(in_bounds)
    full = docs.select(F.col("_id").alias("_i"), F.col("_fp").alias("_f"), "_words").dropDuplicates(["_i", "_f"])
    light = light.join(full, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_fp") == F.col("_f")))
    light = light.where(F.slice("_words", at + 1, size) == F.col("words"))
    hits = light.select("_id", "_fp", "n_words", at.alias("start"), (at + size).alias("end"), "items")
    none = docs.select("_id", "_fp", F.size("_words").alias("n_words"), F.lit(None).cast("int").alias("start"),
                       F.lit(None).cast("int").alias("end"), F.lit(None).cast(index.schema["items"].dataType).alias("items"))
    return hits.unionByName(none)


def judged(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str,
           size: int, broadcast_bytes: int) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_fp"), words_of(F.col(text_col)).alias("_words"))
    windows = written(item_windows(items, item_col, item_text_col, size))
    small = bounded(windows, broadcast_bytes)
    index = written(prefix_index(rows, windows, small))
    hits = window_hits(rows, index, small)
    spans = F.array_sort(F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", "end"))))
    count = F.aggregate(
        "spans", F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(F.greatest(acc["to"], s["end"]).alias("to"),
                                (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], acc["to"]))).cast("long").alias("n")))
    found = F.array_sort(F.array_distinct(F.flatten("sets")))
    return (hits.groupBy("_id", "_fp")
            .agg(F.max("n_words").cast("long").alias("n_words"), spans.alias("spans"), F.collect_set("items").alias("sets"),
                 F.sum(F.when(F.col("start").isNull(), 1).otherwise(0)).cast("int").alias("copies"))
            .select("_id", "_fp", "copies", "n_words", count["n"].alias("n_hit"), found.alias("items"), "spans"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", size: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per row: id, n_words, n_hit, items (ids of items that occur, sorted as text), spans of hit words.

    Windows and their index are written to the shared folder while the function is called.
    """
    rows = judged(docs, items, id_col, text_col, item_col, item_text_col, size, broadcast_bytes)
    copies = F.explode(F.array_repeat(F.lit(True), F.col("copies")))
    return rows.withColumn("_copy", copies).select(F.col("_id").alias(id_col), "n_words", "n_hit", "items", "spans")


def uncontaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """The rows in which no window occurs, with all their columns."""
    names = {"item_col": "item_id", "item_text_col": "text", "size": WINDOW, "broadcast_bytes": BROADCAST_BYTES} | options
    gone = judged(docs, items, id_col, text_col, **names).where("n_hit > 0").select("_id", "_fp")
    same = docs[id_col].eqNullSafe(gone["_id"]) & (F.xxhash64(docs[text_col]) == gone["_fp"])
    return docs.join(gone, same, "left_anti")

"""Substring dedup by level-wise doubling.

A window of `length` words can only repeat if its halves do. So windows of half the length are looked
at first, and only those found twice are extended to twice that length, where they are compared again.
Doubling ends at `length`: longer repeats consist of repeated windows of that length and would cover
the same words. If no half survives, nothing is extended.

* First level. Each window of `length` words names one of its halves, the one with the least hash; equal
  windows name the same one. Only named halves (about one word in six) are sent around. In each batch
  the first of equal halves stands for the others, so a passage that is everywhere costs one row a batch.
* Second level. Windows whose named half was found twice are extended to the whole length and compared
  by two independent 64-bit hashes. Again the first in a batch stands for the others, which are known to
  be later copies on the spot. A later copy is a window that starts in a document with a larger id, or
  later in the same one.
* Words covered by later copies go.

Rows are dealt by hash or by document, in packets of numbers (packets.py); no group is collected on the
driver, and a part holds one row per batch for the most frequent window.

Defined results: null texts have no words; rows that share id and text are one document and get the same
result; rows that share only the id are ordered by the text's hash; a null id stands before all others;
extra columns are not read; an empty table gives an empty result. Ids must be integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftmark.llm.packets import Gather, empty_packets, part_count, reduce_parts, schema, unpack
from siftmark.llm.textbatch import U64, TextSlice, chain, covered, slices

LENGTH = 20

HALF = {"hash": np.uint64, "doc": np.int64, "text": np.int64, "pos": np.int32, "known": np.int8}
PLACE = {"doc": np.int64, "text": np.int64, "pos": np.int32}
WHOLE = {"hash": np.uint64, "hash2": np.uint64, **PLACE, "known": np.int8}


def named_halves(part: TextSlice, halves: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows, and for each the start of the half with the least hash."""
    windows = np.flatnonzero(part.fits(length))
    if not len(windows):
        return windows, windows
    choices = length - length // 2 + 1
    views = np.lib.stride_tricks.sliding_window_view(halves, choices)
    least = np.concatenate([views[windows[i : i + 200_000]].argmin(axis=1) for i in range(0, len(windows), 200_000)])
    return windows, windows + least


def document_part(docs: np.ndarray, texts: np.ndarray, count: int) -> np.ndarray:
    """The same part as with_keys gives: copies of a text are spread by their ids."""
    return np.mod(docs ^ texts, count).astype(np.int32)


def firsts(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the columns (the last one leads), and where each run of an equal leading one begins."""
    order = np.lexsort(columns)
    lead = columns[-1][order]
    return order, np.append(True, lead[1:] != lead[:-1]) if len(lead) else np.zeros(0, bool)


def with_keys(docs: DataFrame, id_col: str, text_col: str, count: int) -> DataFrame:
    """Id (null first), text hash, text and the part of the document."""
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("_doc"),
        F.xxhash64(text_col).alias("_fp"), F.col(text_col).alias("_text"), F.col(id_col).alias("_id"))
    return rows.withColumn("_part", F.pmod(F.col("_doc").bitwiseXOR(F.col("_fp")), F.lit(count)).cast("int"))


def half_packets(rows: DataFrame, length: int, count: int) -> DataFrame:
    """First level, map side: the named halves, dealt by hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gather = Gather(HALF, count)
        for batch in batches:
            doc, fp = batch.column("_doc").to_numpy(), batch.column("_fp").to_numpy()
            for part in slices(batch.column("_text")):
                halves = chain(part.word_hashes(), length // 2)
                _, named = named_halves(part, halves, length)
                named = np.unique(named)
                if not len(named):
                    continue
                of = part.low + part.doc[named]
                hashes = halves[named]
                order, first = firsts(hashes)
                known = np.ones(len(named), np.int8)
                runs = np.diff(np.append(np.flatnonzero(first), len(named)))
                lead = order[first]
                known[lead] = np.where(runs > 1, 2, 0)
                at = np.where(known == 1, document_part(doc[of], fp[of], count), (hashes % U64(count)).astype(np.int32))
                yield from gather.add(at, hash=hashes, doc=doc[of], text=fp[of], pos=named - part.first[part.doc[named]], known=known)
        yield from gather.flush()

    return rows.select("_doc", "_fp", "_text").mapInArrow(run, schema(HALF))


def twice(packets: DataFrame, count: int) -> DataFrame:
    """First level, reduce side: places of halves found twice, dealt by document."""
    def run(x: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        found = x["known"] > 0
        own = np.flatnonzero(x["known"] != 1)
        order, first = firsts(x["hash"][own])
        group = np.cumsum(first) - 1
        often = np.bincount(group, minlength=1)[group] > 1 if len(own) else np.zeros(0, bool)
        found[own[order[often]]] = True
        gather = Gather(PLACE, count)
        keep = np.flatnonzero(found)
        yield from gather.add(document_part(x["doc"][keep], x["text"][keep], count), **{k: x[k][keep] for k in PLACE})
        yield from gather.flush()

    return reduce_parts(packets, HALF, run, schema(PLACE), lambda: empty_packets(PLACE))


def places_by_document(table: pa.Table) -> dict[tuple[int, int], np.ndarray]:
    """Sorted places of each document of a part."""
    x = unpack(table, PLACE)
    order = np.lexsort((x["pos"], x["text"], x["doc"]))
    doc, text, pos = (x[k][order] for k in ("doc", "text", "pos"))
    if not len(doc):
        return {}
    edges = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (text[1:] != text[:-1])))
    return {(int(doc[i]), int(text[i])): pos[i:j] for i, j in zip(edges, np.append(edges[1:], len(doc)), strict=True)}


def unrepeated(texts: pa.Table) -> pa.Table:
    """One row for each document of a part: rows that share id and text are one document."""
    keys = np.stack([texts["_doc"].to_numpy(), texts["_fp"].to_numpy()])
    _, first = np.unique(keys, axis=1, return_index=True)
    return texts if len(first) == texts.num_rows else texts.take(pa.array(np.sort(first)))


def whole_packets(rows: DataFrame, places: DataFrame, length: int, count: int) -> DataFrame:
    """Second level, map side: windows over the surviving halves, dealt by hash."""
    def run(texts: pa.Table, packets: pa.Table) -> pa.Table:
        batches: list[pa.RecordBatch] = []
        gather, alive = Gather(WHOLE, count), places_by_document(packets)
        if alive and texts.num_rows:
            texts = unrepeated(texts).combine_chunks()
            doc, fp = texts["_doc"].to_numpy(), texts["_fp"].to_numpy()
            for part in slices(texts["_text"]):
                keep = np.zeros(len(part.starts), bool)
                for i in range(part.n):
                    pos = alive.get((int(doc[part.low + i]), int(fp[part.low + i])))
                    if pos is not None:
                        keep[part.first[i] + pos] = True
                words = part.word_hashes()
                halves = chain(words, length // 2)
                windows, named = named_halves(part, halves, length)
                windows = windows[keep[named]]
                if not len(windows):
                    continue
                hashes, hashes2 = chain(words, length)[windows], chain(part.word_hashes(1), length)[windows]
                of = part.low + part.doc[windows]
                pos = windows - part.first[part.doc[windows]]
                order, first = firsts(pos, fp[of], doc[of], hashes2, hashes)
                first |= np.append(True, np.diff(hashes2[order]) != 0)
                known = np.ones(len(windows), np.int8)
                known[order[first]] = 0
                at = np.where(known == 1, document_part(doc[of], fp[of], count), (hashes % U64(count)).astype(np.int32))
                batches.extend(gather.add(at, hash=hashes, hash2=hashes2, doc=doc[of], text=fp[of], pos=pos, known=known))
            batches.extend(gather.flush())
        return pa.Table.from_batches(batches) if batches else empty_packets(WHOLE)

    return rows.groupBy("_part").cogroup(places.groupBy("part")).applyInArrow(run, schema(WHOLE))


def later_copies(packets: DataFrame, count: int) -> DataFrame:
    """Second level, reduce side: windows that also start earlier, dealt by document."""
    def run(x: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        later = x["known"] == 1
        own = np.flatnonzero(~later)
        h2 = x["hash2"][own]
        order, first = firsts(x["pos"][own], x["text"][own], x["doc"][own], h2, x["hash"][own])
        if len(own):
            first |= np.append(True, h2[order][1:] != h2[order][:-1])
        later[own[order[~first]]] = True
        gather = Gather(PLACE, count)
        keep = np.flatnonzero(later)
        yield from gather.add(document_part(x["doc"][keep], x["text"][keep], count), **{k: x[k][keep] for k in PLACE})
        yield from gather.flush()

    return reduce_parts(packets, WHOLE, run, schema(PLACE), lambda: empty_packets(PLACE))


def kept_words(part: TextSlice, i: int, removed: np.ndarray) -> bytes:
    """The words of the i-th text that are not removed, joined by one space."""
    low, high = part.first[i], part.first[i + 1]
    raw = part.data[part.offsets[i] : part.offsets[i + 1]].tobytes()
    words = raw.split()
    if len(words) != high - low:  # bytes.split also takes other separators
        base = part.offsets[i]
        words = [raw[a:b] for a, b in zip(part.starts[low:high] - base, part.ends[low:high] - base, strict=True)]
    return b" ".join(words[k] for k in np.flatnonzero(~removed).tolist()) if removed.any() else b" ".join(words)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: id, n_words, n_removed, and the text of the kept words."""
    count = part_count(docs.sparkSession)
    rows = with_keys(docs, id_col, text_col, count)
    alive = twice(half_packets(rows, length, count), count)
    removed = later_copies(whole_packets(rows, alive, length, count), count)

    def run(texts: pa.Table, packets: pa.Table) -> pa.Table:
        found = places_by_document(packets)
        texts = texts.combine_chunks()
        n_words, n_removed, kept = [], [], []
        if texts.num_rows:
            doc, fp = texts["_doc"].to_numpy(), texts["_fp"].to_numpy()
            for part in slices(texts["_text"]):
                for i in range(part.n):
                    size = int(part.first[i + 1] - part.first[i])
                    gone = covered(found.get((int(doc[part.low + i]), int(fp[part.low + i])), np.zeros(0, int)), length, size)
                    n_words.append(size)
                    n_removed.append(int(gone.sum()))
                    kept.append(kept_words(part, i, gone))
        return pa.table({"_id": texts["_id"], "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                         "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})

    id_type = docs.schema[id_col].dataType.simpleString()
    out = rows.groupBy("_part").cogroup(removed.groupBy("part")).applyInArrow(run, f"_id {id_type}, n_words long, n_removed long, kept_text string")
    return out.withColumnRenamed("_id", id_col)

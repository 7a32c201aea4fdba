"""Ranked lexical search by bit-sliced Bloom signatures.

Every document is a column of a bit matrix and every hashed key sets PROBES of its rows. Keys are a term and
the number of times that it occurs at least, for the steps of TIMES, so that a slice (the AND of a key's
rows) marks all documents that hold a term so often, and a few that don't. Documents of similar size share a
matrix of at most BLOCK_DOCS columns, whose rows follow the largest of them. The matrices are a table in
the shared folder, written in one pass over the texts, which also gives the exact statistics of the queries' terms.

A search reads that table only. For a term, the slices weighted by what another step of occurrences can
add at most give an upper bound of its share of a document's score; their sum over an item's terms bounds the
document's score, as false marks only add. The TOP documents by bound are scored exactly; the least of those
scores is a floor for the item. Then every document whose bound reaches the floor is scored exactly and
ranked: what is left out is proven to be lower. Exact scores are taken from the whole texts, which candidates find by
id: candidates are sent to every task up to SENT_ROWS rows (they are counted in their table), else joined by shuffle.

Items are searched in parts of about ITEMS, so neither driver nor tasks hold all of them. Terms are compared by 64-bit hashes.

Defined results: null and empty texts have no terms and are never found, items without terms have no rows; rows
that share an id or repeat are documents of their own; a null id comes first among equal scores; texts of any length
are read in blocks; extra columns are not read; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftmark.llm.textbatch import U64, mix
from siftmark.llm.wordblocks import ALNUM, word_blocks
from siftmark.sources.scratch import written

TOP = 10
BLOCK_DOCS = 512
PROBES, BITS_PER_KEY = 3, 8
#: A slice marks documents that hold a term at least so often.
TIMES = (1, 2, 3, 4, 6, 9, 16, 64)
ITEMS = 4096
#: Terms (with repeats) whose bounds are computed together.
SLOTS = 8192
SENT_ROWS = 200_000
PROBE_KEYS = mix(np.arange(1, PROBES + 1, dtype=U64)) | U64(1)
TIMES_KEYS = mix(np.arange(11, 11 + len(TIMES), dtype=U64))


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Share of a term in a score, before its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def length_norm(n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    return 25 + (75 * n * docs) // max(terms, 1)


@dataclass
class Queries:
    """Terms of some items: hashes ascending, weights, and for each item the places of its terms with repeats."""
    hashes: np.ndarray
    weights: np.ndarray
    items: list[np.ndarray]
    docs: int = 0
    terms: int = 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash, else -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)


def term_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, tf) of the distinct terms of each text in row order, and terms of each text with repeats."""
    rows, hashes, times = [np.zeros(0, np.int64)], [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    length = np.zeros(len(texts), np.int64)
    for block in word_blocks(texts, ALNUM):
        h = block.hashes()
        length += np.bincount(block.doc, minlength=len(texts))
        _, first, n = np.unique(mix(h + block.doc.astype(U64) * TIMES_KEYS[0]), return_index=True, return_counts=True)
        rows.append(block.doc[first])
        hashes.append(h[first])
        times.append(n)
    row, h, n = (np.concatenate(x) for x in (rows, hashes, times))
    # pieces of one text are counted apart at first
    order = np.lexsort((h, row))
    row, h, n = row[order], h[order], n[order]
    first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (h[1:] != h[:-1]))) if len(row) else np.zeros(0, np.int64)
    return row[first], h[first], np.add.reduceat(n, first) if len(first) else n, length


def probes(keys: np.ndarray, rows: int) -> np.ndarray:
    """Rows of the matrix that each key sets."""
    return (((keys[:, None] * PROBE_KEYS) >> U64(20)) % U64(rows)).astype(np.int64)


def signatures(doc: np.ndarray, hashes: np.ndarray, times: np.ndarray, length: np.ndarray) -> Iterator[tuple[np.ndarray, int, bytes]]:
    """(documents, rows, packed matrix) of blocks of documents of similar size; documents without terms are in none."""
    keys, of = [], []
    for step, least in enumerate(TIMES):
        at = np.flatnonzero(times >= least)
        keys.append(mix(hashes[at] + TIMES_KEYS[step]))
        of.append(doc[at])
    key, of = np.concatenate(keys), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    key, of = key[order], of[order]
    size = np.bincount(of, minlength=len(length))
    bounds = np.append(0, np.cumsum(size))
    classes = np.where(size > 0, np.ceil(np.log2(np.maximum(size, 16))), 0).astype(int)
    for c in np.unique(classes[classes > 0]):
        members = np.flatnonzero(classes == c)
        rows = BITS_PER_KEY << int(c)
        for low in range(0, len(members), BLOCK_DOCS):
            docs = members[low : low + BLOCK_DOCS]
            bits = np.zeros((rows, -(-len(docs) // 8) * 8), bool)
            for column, d in enumerate(docs):
                bits[probes(key[bounds[d] : bounds[d + 1]], rows).ravel(), column] = True
            yield docs, rows, np.packbits(bits, axis=1).tobytes()


def scan(docs: DataFrame, hashes: np.ndarray, with_slices: bool = True) -> DataFrame:
    """Blocks of signatures, and on one row a batch how many documents hold each of the terms with these hashes."""
    shared = docs.sparkSession.sparkContext.broadcast(Queries(hashes, np.zeros(0), []))
    kind = docs.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        for batch in batches:
            ids = batch.column("_id")
            doc, h, times, length = term_counts(batch.column("_text"))
            at = queries.find(h)
            df = np.bincount(at[at >= 0], minlength=len(queries.hashes))
            held = np.flatnonzero(df)
            none = pa.array([], ids.type)
            yield row_of(none, [], 0, b"", held, df[held], int((length > 0).sum()), int(length.sum()))
            if with_slices:
                for docs, rows, matrix in signatures(doc, h, times, length):
                    yield row_of(ids.take(pa.array(docs)), length[docs], rows, matrix, [], [], 0, 0)

    def row_of(ids: pa.Array, length, rows: int, matrix: bytes, held, df, docs: int, terms: int) -> pa.RecordBatch:
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        return pa.record_batch({
            "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), "length": one(list(length), pa.int64()), "rows": pa.array([rows], pa.int64()),
            "matrix": pa.array([matrix], pa.binary()), "held": one(list(held), pa.int32()), "df": one(list(df), pa.int64()),
            "docs": pa.array([docs]), "terms": pa.array([terms])})

    return docs.mapInArrow(run, f"ids array<{kind}>, length array<bigint>, rows bigint, matrix binary, held array<int>, df array<bigint>, docs bigint, terms bigint")


def query_terms(texts: list[str | None]) -> Queries:
    """Terms of the items, without weights."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    for block in word_blocks(pa.array(texts, pa.string()), ALNUM):
        hashes = block.hashes()
        for k in np.unique(block.doc):
            found[k].append(hashes[block.doc == k])
    items = [np.concatenate(x) if x else np.zeros(0, U64) for x in found]
    known = np.unique(np.concatenate([*items, np.zeros(0, U64)]))
    return Queries(known, np.zeros(len(known), np.int64), [np.searchsorted(known, x) for x in items])


def weighted(queries: Queries, stored: DataFrame) -> Queries:
    """The queries with the weights that the scanned statistics give."""
    docs, terms = stored.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
    cells = stored.select(F.explode(F.arrays_zip("held", "df")).alias("c")).groupBy("c.held").agg(F.sum("c.df").alias("df"))
    df = np.zeros(len(queries.hashes), np.int64)
    for r in cells.collect():  # at most one row for each term of the items
        df[r.held] = r.df
    weights = [math.floor(1000 * math.log((2 * docs + 2) / (2 * n + 1))) if n else 0 for n in df.tolist()]
    return Queries(queries.hashes, np.array(weights, np.int64), queries.items, docs, terms)


def bounds_of(queries: Queries, length: np.ndarray, rows: int, matrix: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """(first item, upper bounds of items x documents) for groups of items."""
    m = length_norm(length, queries.docs, queries.terms)
    slices = np.frombuffer(matrix, np.uint8).reshape(rows, -1)
    most = [impact(np.int64(nxt - 1), m) for nxt in TIMES[1:]] + [np.full(len(m), 1_000_000)]
    gains = np.diff(np.stack([np.zeros_like(m), *most]), axis=0)
    low = 0
    while low < len(queries.items):
        high, slots = low + 1, len(queries.items[low])
        while high < len(queries.items) and slots + len(queries.items[high]) <= SLOTS:
            slots += len(queries.items[high])
            high += 1
        group = queries.items[low:high]
        terms, place = np.unique(np.concatenate(group), return_inverse=True)
        terms = terms.astype(np.int64)
        share = np.zeros((len(terms), len(m)), np.int64)
        alive = np.arange(len(terms))
        marks = np.full((len(terms), slices.shape[1]), 255, np.uint8)
        for step in range(len(TIMES)):
            at = probes(mix(queries.hashes[terms[alive]] + TIMES_KEYS[step]), rows)
            for k in range(PROBES):
                marks &= slices[at[:, k]]
            keep = marks.any(axis=1)
            alive, marks = alive[keep], marks[keep]
            if not len(alive):
                break
            share[alive] += np.unpackbits(marks, axis=1, count=len(m)) * gains[step]
        share *= queries.weights[terms][:, None]
        sizes = np.array([len(x) for x in group])
        out = np.zeros((len(group), len(m)), np.int64)
        full = np.flatnonzero(sizes)
        if len(full):
            out[full] = np.add.reduceat(share[place], np.append(0, np.cumsum(sizes[full]))[:-1], axis=0)
        yield low, out
        low = high


def best_by_bound(stored: DataFrame, queries: Queries) -> DataFrame:
    """(q, _id): the TOP documents of each item by upper bound."""
    shared = stored.sparkSession.sparkContext.broadcast(queries)
    kind = stored.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        for batch in batches:
            for b in range(len(batch)):
                ids, length = batch.column("ids")[b].values, batch.column("length")[b].values.to_numpy()
                for low, bound in bounds_of(queries, length, batch.column("rows")[b].as_py(), batch.column("matrix")[b].as_py()):
                    k = min(TOP, len(length))
                    top = np.argpartition(-bound, k - 1, axis=1)[:, :k]
                    q, c = np.repeat(np.arange(len(bound)), k), top.ravel()
                    score = bound[q, c]
                    q, c, score = q[score > 0], c[score > 0], score[score > 0]
                    yield pa.record_batch({"q": pa.array(q + low), "_id": ids.take(pa.array(c)), "bound": pa.array(score)})

    found = stored.where("rows > 0").select("ids", "length", "rows", "matrix").mapInArrow(run, f"q long, _id {kind}, bound long")
    order = Window.partitionBy("q").orderBy(F.desc("bound"), "_id")
    return found.withColumn("k", F.row_number().over(order)).where(F.col("k") <= TOP).select("q", "_id")


def not_excluded(stored: DataFrame, queries: Queries, floors: np.ndarray) -> DataFrame:
    """(q, _id): every document whose upper bound reaches the floor of the item and is above 0."""
    shared = stored.sparkSession.sparkContext.broadcast((queries, np.maximum(floors, 1)))
    kind = stored.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, floors = shared.value
        for batch in batches:
            for b in range(len(batch)):
                ids, length = batch.column("ids")[b].values, batch.column("length")[b].values.to_numpy()
                for low, bound in bounds_of(queries, length, batch.column("rows")[b].as_py(), batch.column("matrix")[b].as_py()):
                    q, c = np.nonzero(bound >= floors[low : low + len(bound), None])
                    if len(q):
                        yield pa.record_batch({"q": pa.array(q + low), "_id": ids.take(pa.array(c))})

    return stored.where("rows > 0").select("ids", "length", "rows", "matrix").mapInArrow(run, f"q long, _id {kind}")


def exact_scores(docs: DataFrame, candidates: DataFrame, queries: Queries) -> DataFrame:
    """(q, _id, score) of the candidates (q, _id), a stored table, from whole texts."""
    by_id = candidates.distinct().groupBy("_id").agg(F.collect_list("q").alias("qs")).withColumnRenamed("_id", "_wanted")
    by_id = F.broadcast(by_id) if candidates.count() <= SENT_ROWS else by_id
    rows = docs.join(by_id, F.col("_id").eqNullSafe(F.col("_wanted"))).select("_id", "_text", "qs")
    shared = docs.sparkSession.sparkContext.broadcast(queries)
    kind = docs.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        for batch in batches:
            doc, h, times, length = term_counts(batch.column("_text"))
            at = queries.find(h)
            doc, times, at = doc[at >= 0], times[at >= 0], at[at >= 0]
            m = length_norm(length, queries.docs, queries.terms)
            parts = queries.weights[at] * impact(times, m[doc])
            bounds = np.searchsorted(doc, np.arange(len(length) + 1))
            share = np.zeros(len(queries.hashes), np.int64)
            for k, wanted in enumerate(batch.column("qs").to_pylist()):
                own = slice(bounds[k], bounds[k + 1])
                share[at[own]] = parts[own]
                score = np.array([share[queries.items[q]].sum() for q in wanted], np.int64)
                share[at[own]] = 0
                yield pa.record_batch({"q": pa.array(wanted, pa.int64()), "_id": pa.concat_arrays([batch.column("_id").slice(k, 1)] * len(wanted)), "score": pa.array(score)})

    return rows.mapInArrow(run, f"q long, _id {kind}, score long").where("score > 0")


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """item, rank, id and score of the TOP documents of each item."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    wanted = items.select(F.col(item_col).alias("item"), F.col("text").cast("string").alias("text"))
    parts = max(1, -(-wanted.count() // ITEMS))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "_id")
    index, results = None, []
    for part in range(parts):
        chosen = wanted.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part).collect()
        queries = query_terms([r.text for r in chosen])
        stored = written(scan(texts, queries.hashes, index is None))
        index = stored if index is None else index
        queries = weighted(queries, stored)
        best = exact_scores(texts, written(best_by_bound(index, queries)), queries)
        floors = np.zeros(len(chosen), np.int64)
        lowest = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == TOP)
        for r in lowest.select("q", "score").collect():
            floors[r.q] = r.score
        found = exact_scores(texts, written(not_excluded(index, queries, floors)), queries)
        names = spark.createDataFrame([(k, r.item) for k, r in enumerate(chosen)], f"q long, item {wanted.schema['item'].dataType.simpleString()}")
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
        results.append(ranked.join(F.broadcast(names), "q").select(F.col("item").alias(item_col), "rank", F.col("_id").alias(id_col), "score"))
    return reduce(DataFrame.unionByName, results)

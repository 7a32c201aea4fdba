"""Quality rules: plain counts, and a log-likelihood ratio of hashed n-grams.

The target multinomial is counted over every trusted document, the raw one over every document. Words and
pairs of neighbouring words are hashed into buckets of their own, fixed in number at every size of the corpus.
A document's score is the mean over its n-grams of log p_target(bucket) - log p_raw(bucket), so long texts
score like short ones; raw counts are taken without the document's own n-grams, as else what only
this document has would speak against it.

The threshold follows the target: it lies as far below the 1 % quantile of the trusted documents' scores as
that lies below their median. For this, a trusted document is scored without its own n-grams in the target
as well, and counts if it passes the base rules. So a table that fills up, whose ratios fade, gets a
threshold that fades with them. Counts are integers and a text is scored in one task, so verdicts do not
depend on the partitioning. A document is kept if it passes the base rules and reaches the threshold.

Jobs: one over the texts for both counts, one for the trusted scores, and the last one judges. A task sends its counts
as two vectors, packed in ranges of buckets, so the shuffle follows the tasks and not the n-grams. For the
target's counts a Bloom filter of fixed size finds the texts; the ids that it lets through wrongly, hardly any, come
from a join of ids, and what their texts hold is counted once more and taken off. Texts are shuffled only when so many
ids fill the filter that Spark finds the wrong ones too many to send. The trusted scores are joined without texts.

Memory: each of these jobs starts one Python worker a task (counting wrong texts, if there are any, two). Beyond the
batch of rows that Spark hands it, a worker holds the tables of fixed size and one slice of texts; kept rows are
handed back a slice at a time.

Defined results: a null text is an empty one; a text without words scores 0; repeated rows and rows
with a null id are judged each by itself; without trusted documents every score is 0 and only the base rules
decide; an empty table gives an empty result; columns other than id and text are never read, or passed on as
they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftmark.llm.textbatch import TextSlice, chain, covered, repeats_in_text, slices
from siftmark.sources.scratch import written

#: Buckets of words, and of pairs of neighbouring words.
WORD_BUCKETS = 1 << 18
PAIR_BUCKETS = 1 << 20
#: Buckets in one row of a task's count vector.
RANGE = 1 << 13
#: 64-bit words of the filter of trusted ids (16 MB). With very many ids it lets all through, and the join decides alone.
FILTER_WORDS = 1 << 21
PRIOR = 5
#: Quantile of the trusted scores that fixes the threshold, and the width of the bins it is counted in.
LOW = 0.01
BIN = 0.001
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

MEASURES = {
    "n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(), "base_failed": pa.bool_(), "llr": pa.float64(), "kept": pa.bool_(),
}


@dataclass(frozen=True)
class Multinomials:
    """Target and raw n-gram counts by bucket."""

    target: np.ndarray
    raw: np.ndarray

    def ratios(self, places: np.ndarray, own: np.ndarray, own_target: np.ndarray | int = 0) -> np.ndarray:
        """log p_target - log p_raw at the buckets, less a document's own counts, with PRIOR n-grams of the ratio 1 added.

        What the corpus hardly has is so neither for nor against a document.
        """
        total = self.target.sum()
        if not total:
            return np.zeros(len(places))
        share = total / self.raw.sum()
        target, raw = np.maximum(self.target[places] - own_target, 0), np.maximum(self.raw[places] - own, 0)
        return np.log((target + PRIOR * share) / ((raw + PRIOR) * share))


@dataclass(frozen=True)
class QualityRules:
    counts: Multinomials
    threshold: float


def gram_buckets(part: TextSlice) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of each word and each pair of neighbouring words."""
    words = part.word_hashes()
    pairs, fit = chain(words, 2), part.fits(2)
    places = np.concatenate([words % np.uint64(WORD_BUCKETS), np.uint64(WORD_BUCKETS) + pairs[fit] % np.uint64(PAIR_BUCKETS)])
    return places.astype(np.int64), np.concatenate([part.doc, part.doc[: len(pairs)][fit]])


def scores(part: TextSlice, counts: Multinomials) -> tuple[np.ndarray, np.ndarray]:
    """Mean ratio of each text, and the same for a text that the target counts too."""
    places, docs = gram_buckets(part)
    size = len(counts.raw)
    keys, own = np.unique(docs * size + places, return_counts=True)
    docs, places = keys // size, keys % size
    n = np.maximum(np.bincount(docs, weights=own, minlength=part.n), 1)
    plain, trusted = (np.bincount(docs, weights=own * counts.ratios(places, own, less), minlength=part.n) / n for less in (0, own))
    return plain, trusted


def base_counts(part: TextSlice) -> dict[str, np.ndarray]:
    """The plain counts of each text, and whether it fails on them."""
    lead = (part.data & 0xC0) != 0x80
    starts, ends, docs = part.lines()
    with_word = np.searchsorted(part.starts, ends) > np.searchsorted(part.starts, starts)
    starts, ends, docs = starts[with_word], ends[with_word], docs[with_word]
    _, again = repeats_in_text(part.span_hashes(starts, ends), docs)
    windows, fit = chain(part.word_hashes(), 3), part.fits(3)
    places = np.flatnonzero(fit)
    often, _ = repeats_in_text(windows[fit], part.doc[places])
    hit = covered(places[often], 3, len(part.starts))
    n_words = part.n_words
    repeat = np.bincount(part.doc[hit], minlength=part.n)
    return {
        "n_words": n_words, "word_chars": part.total(part.solid & lead), "n_symbols": part.total(SYMBOLS[part.data]),
        "n_dup_lines": np.bincount(docs[again], minlength=part.n), "n_repeat_words": repeat,
        "base_failed": (n_words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n_words),
    }


def judge_slices(texts: pa.Array, rules: QualityRules) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """Of each slice its first row, and all measures of its texts with _trusted: their score if the target counts them."""
    for part in slices(texts):
        counts = base_counts(part)
        llr, trusted = scores(part, rules.counts)
        yield part.low, counts | {"llr": llr, "kept": ~counts["base_failed"] & (llr >= rules.threshold), "_trusted": trusted}


def judge(texts: pa.Array, rules: QualityRules) -> dict[str, np.ndarray]:
    """All measures of each text, and _trusted."""
    found: dict[str, list[np.ndarray]] = {name: [] for name in [*MEASURES, "_trusted"]}
    for _, counts in judge_slices(texts, rules):
        for name, values in counts.items():
            found[name].append(values)
    return {name: np.concatenate(v) if v else np.zeros(0) for name, v in found.items()}


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """Ids of all documents labelled good."""
    return labels.where((F.col(label_col) == 1) & F.col(id_col).isNotNull()).select(id_col).distinct()


def packed(counts: np.ndarray) -> bytes:
    """Counts by the bytes of equal weight, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(counts.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<i8").ravel()


def in_filter(batch: pa.RecordBatch, marks: np.ndarray) -> np.ndarray:
    """Whether the filter has all bits of the row's mask; never for a null mask."""
    mask = batch.column("mask")
    bits = mask.fill_null(0).to_numpy()
    return ((marks[batch.column("word").to_numpy()] & bits) == bits) & mask.is_valid().to_numpy(zero_copy_only=False)


def count_rows(texts: DataFrame, marks: np.ndarray | None = None) -> DataFrame:
    """(range, n): n-gram counts of the column _text in each range of buckets in use, packed.

    With a filter the counts of the texts whose word and mask are in it follow, in ranges after all others.
    """
    buckets, schema = WORD_BUCKETS + PAIR_BUCKETS, "range int, n binary"
    shared = None if marks is None else texts.sparkSession.sparkContext.broadcast(marks)

    def rows(ranges: list[int], counts: list[np.ndarray]) -> pa.RecordBatch:
        return pa.record_batch({"range": pa.array(ranges, pa.int32()), "n": pa.array([packed(c) for c in counts], pa.binary())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((1 if shared is None else 2, buckets), np.int64)
        for batch in batches:
            hit = None if shared is None else in_filter(batch, shared.value)
            for part in slices(batch.column("_text")):
                places, docs = gram_buckets(part)
                np.add.at(sums[0], places, 1)
                if hit is not None:
                    np.add.at(sums[1], places[hit[part.low : part.low + part.n][docs]], 1)
        cut = sums.reshape(-1, RANGE)
        used = np.flatnonzero(cut.any(axis=1))
        yield rows(used.tolist(), list(cut[used]))

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}  # at most all ranges, twice
        for batch in batches:
            for k, data in zip(batch.column("range").to_pylist(), batch.column("n"), strict=True):
                found = unpacked(data.as_py())
                sums[k] = sums[k] + found if k in sums else found
        yield rows(list(sums), list(sums.values()))

    texts = texts.select("_text", *([] if shared is None else ["word", "mask"]))
    return texts.mapInArrow(count, schema).repartition("range").mapInArrow(total, schema)


def gathered(texts: DataFrame, marks: np.ndarray | None = None) -> np.ndarray:
    """Counts of all buckets, fixed in number: one row of all texts, and with a filter one of those in it."""
    found = count_rows(texts, marks).toArrow()
    out = np.zeros((1 if marks is None else 2, WORD_BUCKETS + PAIR_BUCKETS), np.int64)
    cut = out.reshape(-1, RANGE)
    for k, data in zip(found["range"].to_pylist(), found["n"].to_pylist(), strict=True):
        cut[k] = unpacked(data)
    return out


def with_marks(rows: DataFrame) -> DataFrame:
    """The rows with word and mask of their _id in the filter: four bits of one 64-bit word. A null id has no mask."""
    rows = rows.withColumn("_h", F.xxhash64("_id"))
    bits = " | ".join(f"shiftleft(1L, cast(shiftrightunsigned(_h, {at}) & 63 as int))" for at in (40, 46, 52, 58))
    return rows.withColumn("word", F.expr(f"_h & {FILTER_WORDS - 1}L")).withColumn("mask", F.expr(f"IF(_id IS NULL, NULL, {bits})")).drop("_h")


def id_filter(ids: DataFrame) -> np.ndarray:
    """Bloom filter of fixed size of the column _id."""
    found = with_marks(ids.select("_id")).groupBy("word").agg(F.expr("bit_or(mask)").alias("mask")).toArrow()
    marks = np.zeros(FILTER_WORDS, np.int64)
    marks[found["word"].to_numpy()] = found["mask"].to_numpy()
    return marks


def likely(rows: DataFrame, marks: np.ndarray) -> DataFrame:
    """The rows whose _id may be in the filter; none that is in it is missing, a null id never is."""
    shared, names = rows.sparkSession.sparkContext.broadcast(marks), rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(names).filter(pa.array(in_filter(batch, shared.value)))

    return with_marks(rows.where("_id IS NOT NULL")).mapInArrow(run, rows.schema)


def learned_counts(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str) -> Multinomials:
    """Both multinomials. What the filter lets through wrongly is found by ids alone and taken off."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    marks = id_filter(trusted)
    wrong = written(likely(rows.select("_id"), marks).join(trusted, "_id", "left_anti").distinct())
    raw, target = gathered(with_marks(rows), marks)
    if not wrong.isEmpty():
        target = target - gathered(likely(rows, marks).join(wrong, "_id", "left_semi"))[0]
    return Multinomials(target, raw)


def threshold_of(bins: np.ndarray, n: np.ndarray) -> float:
    """The threshold from the trusted scores, given as sorted bins and how many are in each; without any, all are kept."""
    if not len(bins):
        return -np.inf
    so_far = np.cumsum(n)
    low, middle = (int(bins[np.searchsorted(so_far, q * so_far[-1])]) for q in (LOW, 0.5))
    return (2 * low - middle) * BIN


def learned_rules(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> QualityRules:
    """Counts and threshold from all documents and all trusted ids (repeated and null ids do not matter)."""
    trusted = target_ids.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id")).distinct()
    trusted = written(trusted)  # its size is known to the joins below, which choose by it
    counts = learned_counts(docs, trusted, id_col, text_col)
    if not counts.target.any():
        return QualityRules(counts, -np.inf)
    rows = measured(docs, QualityRules(counts, -np.inf), ["base_failed", "_trusted"], id_col, text_col)
    rows = rows.where("NOT base_failed").select("_id", F.floor(F.col("_trusted") / BIN).alias("bin"))
    found = rows.join(trusted, "_id", "left_semi").groupBy("bin").agg(F.count("*").alias("n")).orderBy("bin").toArrow()
    return QualityRules(counts, threshold_of(found["bin"].to_numpy(), found["n"].to_numpy()))


def measured(docs: DataFrame, rules: QualityRules, names: list[str], id_col: str, text_col: str) -> DataFrame:
    """_id and the named measures of every row, in one pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(rules)
    types = MEASURES | {"_trusted": pa.float64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = judge(batch.column("_text"), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), *(pa.array(found[n], types[n]) for n in names)], ["_id", *names])

    kinds = {pa.int64(): T.LongType(), pa.bool_(): T.BooleanType(), pa.float64(): T.DoubleType()}
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, T.StructType([rows.schema["_id"], *(T.StructField(n, kinds[types[n]]) for n in names)]))


def quality_measures(docs: DataFrame, rules: QualityRules, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and measures of every row."""
    return measured(docs, rules, list(MEASURES), id_col, text_col).withColumnRenamed("_id", id_col)


def keep_good(docs: DataFrame, rules: QualityRules, text_col: str = "text") -> DataFrame:
    """The rows that the rules keep, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, found in judge_slices(batch.column(text_col), shared.value):
                yield batch.slice(low, len(found["kept"])).filter(pa.array(found["kept"], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

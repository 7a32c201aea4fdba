"""Scores of texts by a hashed maximum-entropy language model.

A token's probability has two factors, each a softmax: its class given the history, then the token within
its class. The HEAD_CLASSES * WIDTH most frequent tokens have classes by frequency; within them the second
factor is a softmax too. All other words have one of TAIL_CLASSES classes by their last two bytes; there a
word's share is (count + 0.1) / (tokens of the class + 0.1 * (words of the class + 1)), the last 1 for all
words that training has not seen. The features of both softmaxes are n-grams (the word before; the two words before) and skips (the
second and the third word before), hashed to rows of weights, on top of the log shares of classes and tokens. All
but the first see a word beyond the head words by its last two bytes only, so that rows are shared by
words that behave alike. The probabilities of all tokens sum to one after every history.

Counting covers every training text. Counts stay a Spark table of all words; the most frequent ones, at
most HOT_WORDS, are also sent to every task, and what a text has beyond them is joined to the table, so no
word is a hot key of that join. Rows of weights follow the training tokens (one to TOKENS_PER_ROW of
them, between MIN_ROWS and MAX_ROWS, so at most 32 MB are sent).

Training makes ROUNDS gradient updates. Each takes the training texts of one part of the id hashes, so
that together they use every text once. Tasks sum observed minus expected counts for each row, Spark adds
them up (in multiples of 1/256, so that no order changes a sum), and each weight moves by that gradient over
the expected count so far. A task is given several splits, so that partial gradients grow with the cores and
not with the input. Scoring is one pass over all texts in sparse numpy batches.

Defined results: a null text is an empty one and has the end token only; a null id is neither held out
nor learnt from; rows that share an id or repeat are learnt from and scored each on its own; without training texts every
score is the base score; a text over 1 MB is read in pieces cut between words, whose histories start anew, and a
word of 1 MB or more is known by its digest; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftmark.llm.labelled import fold
from siftmark.llm.textbatch import U64, mix
from siftmark.llm.wordblocks import SPACED, WordBlock, word_blocks
from siftmark.sources.scratch import written

WIDTH = 32
HEAD_CLASSES, TAIL_CLASSES = 16, 16
CLASSES = HEAD_CLASSES + TAIL_CLASSES
HOT_WORDS = 1 << 20
MIN_ROWS, MAX_ROWS, TOKENS_PER_ROW = 1 << 10, 1 << 18, 2048
ROUNDS = 4
RATE, PRIOR, LARGEST_STEP = 0.7, 2.0, 2.0
SMOOTH = 0.1
#: Tokens whose logits are computed together.
CHUNK = 1 << 14
#: One odd multiplier for the class factor and one for each head class.
ROW_KEYS = mix(np.arange(1, HEAD_CLASSES + 2, dtype=U64)) | U64(1)
FEATURE_KEYS = mix(np.arange(101, 105, dtype=U64)) | U64(1)
END = ""


def count_step(n: str) -> Column:
    """Logarithmic step of a count."""
    return F.floor(F.log2(n) * 4).cast("int")


def ending_class(endings: np.ndarray) -> np.ndarray:
    """Class of a tail word by its last two bytes."""
    return (HEAD_CLASSES + ((endings.astype(U64) * U64(0x9E3779B97F4A7C15)) >> U64(60)) % U64(TAIL_CLASSES)).astype(np.int8)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, kind, n) of the column `_text`; the end token is the empty word, of the last kind."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in word_blocks(batch.column(0), SPACED):
                _, first, n = np.unique(block.hashes(), return_index=True, return_counts=True)
                yield pa.record_batch({"word": block.words(first).cast(pa.string()), "kind": pa.array(ending_class(block.endings()[first])), "n": pa.array(n)})
            yield pa.record_batch({"word": pa.array([END]), "kind": pa.array([CLASSES - 1], pa.int8()), "n": pa.array([len(batch)])})

    found = docs.select("_text").mapInArrow(count, "word string, kind tinyint, n long")
    return found.groupBy("word", "kind").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """The most frequent words with their counts, and totals of all."""
    tokens: int
    distinct: int
    hashes: np.ndarray                 #: of the hot words, ascending
    counts: np.ndarray                 #: of the hot words
    places: np.ndarray                 #: of the hot words: class * WIDTH + place for a head word, else -1
    end_count: int
    end_place: int
    class_log: np.ndarray              #: log share of each class
    head_log: np.ndarray               #: log share of each place in its head class
    tail_log: np.ndarray               #: log of (tokens of the tail class + 0.1 * (its words + 1))
    cut: int                           #: words from this step of counts on are hot
    _direct: np.ndarray | None = field(default=None, repr=False)
    _head: tuple[np.ndarray, int] | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_direct": None, "_head": None}

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each hash among the hot words, else -1. Frequent words are found at their own place in a table."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        if self._direct is None:
            self._direct = np.zeros(1 << 21, np.int32)
            order = np.argsort(self.counts, kind="stable")
            self._direct[(self.hashes[order] >> U64(43)).astype(np.int64)] = order
        at = self._direct[(hashes >> U64(43)).astype(np.int64)].astype(np.int64)
        rest = np.flatnonzero(self.hashes[at] != hashes)
        place = np.minimum(np.searchsorted(self.hashes, hashes[rest]), len(self.hashes) - 1)
        at[rest] = np.where(self.hashes[place] == hashes[rest], place, -1)
        return at

    def head(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash among the head words, else -1, without a search among all hot words."""
        if self._head is None:
            hot = np.flatnonzero(self.places >= 0)
            own, table, shift = self.hashes[hot], np.full(1 << 20, len(hot), np.int32), 0
            for shift in range(44, 0, -1):  # a shift at which no two of them share a place
                if len(np.unique((own >> U64(shift)) & U64((1 << 20) - 1))) == len(own):
                    break
            table[((own >> U64(shift)) & U64((1 << 20) - 1)).astype(np.int64)] = np.arange(len(hot))
            self._head = table, shift
            self._own, self._own_place = np.append(own, U64(0)), np.append(self.places[hot], -1).astype(np.int32)
        table, shift = self._head
        at = table[((hashes >> U64(shift)) & U64((1 << 20) - 1)).astype(np.int64)]
        return np.where(self._own[at] == hashes, self._own_place[at], -1)


def log_of(share: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(share).astype(np.float32)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Totals and hot words of a stored table of counts."""
    steps = counts.groupBy("kind", count_step("n").alias("step")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    tokens, distinct = sum(r.n for r in steps), sum(r.words for r in steps)
    by_step: dict[int, int] = {}
    for r in steps:
        by_step[r.step] = by_step.get(r.step, 0) + r.words
    cut, held = max(by_step, default=0) + 1, 0
    for step in sorted(by_step, reverse=True):
        if held + by_step[step] > HOT_WORDS:
            break
        cut, held = step, held + by_step[step]
    hot = counts.where(count_step("n") >= cut).select("word", "kind", "n").toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    words, n, kind = hot["word"], hot["n"].to_numpy(), hot["kind"].to_numpy()
    places = np.full(len(n), -1)
    places[: HEAD_CLASSES * WIDTH] = np.arange(min(len(n), HEAD_CLASSES * WIDTH))
    is_end = np.array(words.to_pylist(), object) == END
    head = np.flatnonzero(places >= 0)
    shares = np.zeros(HEAD_CLASSES * WIDTH)
    shares[places[head]] = n[head]
    shares = shares.reshape(HEAD_CLASSES, WIDTH)
    class_n, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in steps:
        class_n[r.kind] += r.n
        class_words[r.kind] += r.words
    np.subtract.at(class_n, kind[head], n[head])
    np.subtract.at(class_words, kind[head], 1)
    tail = class_n + SMOOTH * (class_words + 1)
    tail[:HEAD_CLASSES] = 0
    whole = tail + np.append(shares.sum(1), np.zeros(TAIL_CLASSES))
    in_class = shares / np.maximum(shares.sum(1, keepdims=True), 1e-300)
    rest = np.flatnonzero(~is_end)
    hashes = np.concatenate([b.hashes() for b in word_blocks(words.take(pa.array(rest)), SPACED)] or [np.zeros(0, U64)])
    order = np.argsort(hashes)
    end = np.flatnonzero(is_end)
    end_count = counts.where(F.col("word") == END).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return Vocabulary(
        tokens, distinct, hashes[order], n[rest][order], places[rest][order], int(end_count), int(places[end[0]]) if len(end) else -1,
        log_of(whole / whole.sum()), log_of(in_class), np.log(np.where(tail > 0, tail, 1)), cut)


@dataclass
class MaxentModel:
    vocabulary: Vocabulary
    weights: np.ndarray

    @property
    def shift(self) -> U64:
        return U64(64 - (len(self.weights).bit_length() - 1))


@dataclass
class Events:
    """Tokens of a block with the end tokens of its texts: features, classes and places."""
    doc: np.ndarray
    hashes: np.ndarray
    features: np.ndarray
    place: np.ndarray
    kind: np.ndarray


def events(block: WordBlock, words: Vocabulary, ends: np.ndarray) -> Events:
    """Tokens of a block, and an end after each text in `ends`, whose row it names. Rows ascend in both."""
    hashes = block.hashes()
    place = words.head(hashes)
    kind = np.where(place >= 0, place // WIDTH, ending_class(block.endings()))
    doc = np.concatenate([block.doc, ends])
    order = np.argsort(doc, kind="stable")
    doc = doc[order]
    hashes = np.concatenate([hashes, np.zeros(len(ends), U64)])[order]
    own_place = np.concatenate([place, np.full(len(ends), words.end_place)])[order]
    # an end beyond the head words has no class of endings; it shares the last class of the tail
    kind = np.concatenate([kind, np.full(len(ends), words.end_place // WIDTH if words.end_place >= 0 else CLASSES - 1)])[order]
    # a word at its coarsest: the head word itself, or the last two bytes of any other
    coarse = np.concatenate([np.where(place[: len(block.doc)] >= 0, place[: len(block.doc)], HEAD_CLASSES * WIDTH + block.endings()), np.zeros(len(ends), np.int64)])
    coarse = coarse.astype(U64)[order] + U64(1)

    def back(x: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros(len(doc), U64)
        out[k:] = np.where(doc[k:] == doc[:-k], x[:-k], U64(0))
        return out

    one, two, three = (back(coarse, k) for k in (1, 2, 3))
    features = np.stack([mix(x + key) for x, key in zip((back(hashes, 1), (one << U64(20)) ^ two, two, three), FEATURE_KEYS)], axis=1)
    return Events(doc, hashes, features, own_place.astype(np.int64), kind.astype(np.int64))


def softmax_rows(model: MaxentModel, features: np.ndarray, keys: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of weights that apply, exponentials of the WIDTH outcomes, and their sums.

    No weight can move further than ROUNDS * LARGEST_STEP, so the exponentials need no shift.
    """
    rows = ((features * keys) >> model.shift).astype(np.int64)
    z = model.weights.take(rows[:, 0], axis=0, mode="clip")
    for k in range(1, rows.shape[1]):
        z += model.weights.take(rows[:, k], axis=0, mode="clip")
    z += start
    np.exp(z, out=z)
    return rows, z, z.sum(axis=1)


def factors(model: MaxentModel, found: Events) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For chunks of the tokens: their numbers, and rows, exponentials, sums and the outcome of each factor."""
    words = model.vocabulary
    for low in range(0, len(found.doc), CHUNK):
        at = np.arange(low, min(low + CHUNK, len(found.doc)))
        yield at, *softmax_rows(model, found.features[low : low + CHUNK], ROW_KEYS[HEAD_CLASSES], words.class_log), found.kind[at]
        at = at[found.place[at] >= 0]
        if len(at):
            of = found.place[at] // WIDTH
            start = words.head_log.take(of, axis=0)
            yield at, *softmax_rows(model, found.features.take(at, axis=0), ROW_KEYS[of][:, None], start), found.place[at] % WIDTH


def add_rows(total: np.ndarray, row: np.ndarray, values: np.ndarray) -> None:
    """Add each of the values to its row of the total; rows that repeat often are summed first."""
    order = np.argsort((row & 0xFFFF).astype(np.uint16), kind="stable")  # by 16 bits at a time, which takes linear time
    if len(total) > 1 << 16:
        order = order[np.argsort((row[order] >> 16).astype(np.uint16), kind="stable")]
    ordered = row[order]
    first = np.flatnonzero(np.diff(ordered, prepend=-1))
    size = np.diff(np.append(first, len(row)))
    often = size >= 8
    if often.any():
        bounds = np.cumsum(size[often]) - size[often]
        total[ordered[first[often]]] += np.add.reduceat(values.take(order[np.repeat(often, size)], axis=0), bounds, axis=0)
    first, size = first[~often], size[~often]
    for k in range(7):
        at = first[size > k] + k
        if len(at):
            total[ordered[at]] += values.take(order[at], axis=0)


def blocks_with_ends(texts: pa.Array) -> Iterator[tuple[WordBlock, np.ndarray]]:
    """Blocks, each with the rows whose texts end in it."""
    last, at = None, 0
    for block in word_blocks(texts, SPACED):
        if last is not None:
            yield last, np.arange(at, block.low)
            at = block.low
        last = block
    if last is not None:
        yield last, np.arange(at, len(texts))


def gradients(docs: DataFrame, shared) -> DataFrame:
    """(row, g, m): observed minus expected, and expected counts of the outcomes for each row of weights."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        n = len(model.weights)
        seen, expected = np.zeros(n * WIDTH), np.zeros((n, WIDTH), np.float32)
        for batch in batches:
            for block, ends in blocks_with_ends(batch.column(0)):
                for _, rows, share, whole, outcome in factors(model, events(block, model.vocabulary, ends)):
                    share /= whole[:, None]
                    for row in rows.T:
                        np.add.at(seen, row * WIDTH + outcome, 1.0)
                        add_rows(expected, row, share)
        seen = seen.reshape(n, WIDTH)
        touched = np.flatnonzero(expected.any(axis=1))
        for low in range(0, len(touched), CHUNK):
            part = touched[low : low + CHUNK]
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(np.rint(x.ravel() * 256) / 256, pa.float32()), WIDTH).cast(pa.list_(pa.float32()))
                     for x in (seen[part] - expected[part], expected[part])]
            yield pa.record_batch({"row": pa.array(part.astype(np.int32)), "g": lists[0], "m": lists[1]})

    found = docs.select("_text").mapInArrow(run, "row int, g array<float>, m array<float>")
    sums = [F.sum(F.col(c)[k].cast("double")).alias(f"{c}{k}") for c in "gm" for k in range(WIDTH)]
    total = found.groupBy("row").agg(*sums)
    return total.select("row", *[F.array(*[F.col(f"{c}{k}").cast("float") for k in range(WIDTH)]).alias(c) for c in "gm"])


def train(docs: DataFrame, words: Vocabulary) -> MaxentModel:
    """The model after ROUNDS updates; `docs` has (_id, _text) of the training texts."""
    spark = docs.sparkSession
    size = MIN_ROWS
    while size < MAX_ROWS and size * TOKENS_PER_ROW < words.tokens:
        size *= 2
    model = MaxentModel(words, np.zeros((size, WIDTH), np.float32))
    if not words.tokens:
        return model
    tasks = spark.sparkContext.defaultParallelism
    so_far = np.zeros((size, WIDTH), np.float32)
    for k in range(ROUNDS):
        shared = spark.sparkContext.broadcast(model)
        part = docs.where(F.pmod(F.xxhash64("_id"), F.lit(ROUNDS)) == k)
        found = gradients(part.coalesce(tasks), shared).toArrow()
        row = found["row"].to_numpy()
        g, m = (np.asarray(found[c].combine_chunks().values).reshape(-1, WIDTH) for c in "gm")
        so_far[row] += m
        step = RATE * g / (so_far[row] + PRIOR)
        model = MaxentModel(words, model.weights.copy())
        model.weights[row] += np.clip(step, -LARGEST_STEP, LARGEST_STEP)
        shared.unpersist()
    return model


def partial_scores(docs: DataFrame, model: MaxentModel) -> DataFrame:
    """Per row of (_id, _text): tokens, sums over the words that tasks know, and the other words with their number."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    base = np.log10(model.vocabulary.tokens + SMOOTH * (model.vocabulary.distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        words = model.vocabulary
        for batch in batches:
            size = len(batch)
            n_tokens, n_known = np.ones(size, np.int64), np.full(size, int(words.end_count > 0), np.int64)
            base_sum, log_sum = np.full(size, np.log10(words.end_count + SMOOTH) - base), np.zeros(size)
            rest_doc, rest_word, rest_kind, rest_n = [], [], [], []
            for block, ends in blocks_with_ends(batch.column("_text")):
                hashes = block.hashes()
                found = events(block, words, ends)
                for at, _, share, whole, outcome in factors(model, found):
                    log_sum += np.bincount(found.doc[at], np.log(share[np.arange(len(at)), outcome] / whole), size)
                if words.end_place < 0:
                    log_sum[ends] += np.log(words.end_count + SMOOTH) - words.tail_log[CLASSES - 1]
                n_tokens += np.bincount(block.doc, minlength=size)
                at = words.find(hashes)
                known = at >= 0
                count, doc = words.counts[at[known]], block.doc[known]
                logs = np.log10(count + SMOOTH)
                n_known += np.bincount(doc, minlength=size)
                base_sum += np.bincount(doc, logs - base, size)
                kind = ending_class(block.endings())
                tail = words.places[at[known]] < 0
                log_sum += np.bincount(doc[tail], logs[tail] * np.log(10) - words.tail_log[kind[known][tail]], size)
                other = np.flatnonzero(~known)
                if len(other):
                    order = other[np.lexsort((hashes[other], block.doc[other]))]
                    d, h = block.doc[order], hashes[order]
                    first = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (h[1:] != h[:-1])))
                    rest_doc.append(d[first])
                    rest_word.append(block.words(order[first]))
                    rest_kind.append(kind[order[first]])
                    rest_n.append(np.diff(np.append(first, len(order))))
            docs_of = np.concatenate(rest_doc or [np.zeros(0, np.int64)])
            bounds = np.searchsorted(docs_of, np.arange(size + 1))
            inner = pa.StructArray.from_arrays(
                [(pa.concat_arrays(rest_word) if rest_word else pa.array([], pa.large_string())).cast(pa.string()),
                 pa.array(np.concatenate(rest_kind or [np.zeros(0, np.int8)])), pa.array(np.concatenate(rest_n or [np.zeros(0, np.int64)]))],
                ["word", "kind", "times"])
            yield pa.record_batch({
                "_id": batch.column("_id"), "n_tokens": pa.array(n_tokens), "n_known": pa.array(n_known), "base_score": pa.array(base_sum),
                "score": pa.array(log_sum / np.log(10)), "rest": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), inner)})

    kind = docs.schema["_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"_id {kind}, n_tokens long, n_known long, base_score double, score double, "
                                "rest array<struct<word: string, kind: tinyint, times: long>>")


def language_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int = 10) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row; learns from all rows that are not held out."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    held_out = fold("_id", parts) == 0
    training = rows.where(~held_out)
    counts = written(word_counts(training))
    words = vocabulary(counts)
    model = train(training, words)
    found = written(partial_scores(rows, model)).withColumn("_row", F.monotonically_increasing_id())
    rest = found.select("_row", F.explode("rest").alias("r")).select("_row", "r.word", "r.kind", "r.times")
    known = counts.where(count_step("n") < words.cut).select("word", "n")
    tail = [float(x) for x in words.tail_log]
    whole = float(np.log10(words.tokens + SMOOTH * (words.distinct + 1)))
    n = F.coalesce("n", F.lit(0))
    added = rest.join(known, "word", "left").groupBy("_row").agg(
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.col("times") * (F.log10(n + SMOOTH) - whole)).alias("base"),
        F.sum(F.col("times") * (F.log10(n + SMOOTH) - F.element_at(F.array(*[F.lit(x) for x in tail]), F.col("kind") + 1) / F.lit(float(np.log(10))))).alias("model"))
    out = found.drop("rest").join(added, "_row", "left")
    base = F.col("base_score") + F.coalesce("base", F.lit(0.0))
    score = base if not words.tokens else F.col("score") + F.coalesce("model", F.lit(0.0))
    return out.select(
        F.col("_id").alias(id_col), F.coalesce(fold("_id", parts) == 0, F.lit(False)).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(words.tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"), score.alias("score"))

"""Toxicity by a weighted lexicon, matched by an Aho-Corasick automaton.

Text is folded first: case, full-width and look-alike letters, digits and signs that stand for letters
inside a word (also i and l, which 1 may both stand for); words are then parted by single spaces. The
lexicon holds words and word beginnings with a weight, the log odds of finding them in a toxic and in a
clean document. At each word the heaviest match counts, unless it lies within an exception phrase. The
sum by length becomes a probability through a logistic curve.

Learning takes a sample of at most LEARN_ROWS labelled documents and LEARN_BYTES of text a class, whole
texts in the order of the hash of their ids, equal texts once. The documents of each class that hold a
word or beginning are counted by Spark. What is in at least MIN_SUPPORT toxic ones, however large the
sample, has a weight of at least MIN_WEIGHT and a log odds ratio above 0 by CONFIDENCE standard errors,
enters the lexicon. The bytes of the sample bound it, so it is sent to every task. The curve is fitted on
FIT_ROWS of the sample a class. Every document is scored, whole.

Defined results: null and empty texts have no match and score like any text without one; repeated rows
are scored alike; without labels of both classes the lexicon is empty and the score is below 0.5; extra
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftmark.llm.labelled import fold, labelled_sample, logistic, logistic_fit
from siftmark.sources.scratch import written

BEGINNINGS = range(3, 9)
#: Toxic documents that a word or beginning must be in, at every size of the sample.
MIN_SUPPORT = 3
#: Standard errors by which the log odds ratio must exceed 0.
CONFIDENCE = 2.0
MIN_WEIGHT = 3.0
LEARN_ROWS = 20_000
LEARN_BYTES = 200_000_000
FIT_ROWS = 3000
#: Phrases inside which a match does not count.
EXCEPTIONS = ("clown fish", "trash can", "trash bin")

#: Letters of other scripts that look like Latin ones.
LOOK_ALIKE = dict(zip("авекмнорстухіјѕԁɡαεικνορτυχ", "abekmhopctyxijsdgaeiknoptux", strict=False))
#: Digits and signs that stand for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}
FOLD = str.maketrans(LOOK_ALIKE)
DISGUISED = re.compile(r"(?:(?<=[^\W\d_])|(?<!\S))[0134578@$!|]+(?=[^\W\d_])")
PARTS = re.compile(r"[\W\d_]+")


def folded(text: str) -> str:
    """The folded words of a text, each with one space before it, and one at the end."""
    text = text if text.isascii() else unicodedata.normalize("NFKC", text)
    text = text.lower()
    if not text.isascii():
        text = text.translate(FOLD)
    text = DISGUISED.sub(lambda m: "".join(SUBSTITUTES[c] for c in m[0]), text)
    return " " + PARTS.sub(" ", text).strip().replace("l", "i") + " "


def patterns(text: str) -> set[str]:
    """Words (with spaces on both sides) and beginnings (with one before) of a text."""
    words = set(folded(text).split())
    found = {f" {w} " for w in words if len(w) > 2}
    for n in BEGINNINGS:
        found.update(f" {w[:n]}" for w in words if len(w) > n)
    return found


@dataclass(frozen=True)
class ToxicModel:
    lexicon: dict[str, float]
    exceptions: tuple[str, ...]
    weights: tuple[float, ...]


class Matcher:
    """Automaton of the lexicon and the exception phrases."""

    def __init__(self, lexicon: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS):
        self.machine = ahocorasick.Automaton()
        for pattern, weight in lexicon.items():
            self.machine.add_word(pattern, (len(pattern), weight))
        for phrase in exceptions:
            self.machine.add_word(folded(phrase), (len(folded(phrase)), None))
        self.empty = len(self.machine) == 0
        if not self.empty:
            self.machine.make_automaton()

    def features(self, text: str) -> tuple[float, float]:
        """Sum of weights per 100 words (logarithm), and sum of weights (logarithm)."""
        plain = folded(text)
        if self.empty:
            return 0.0, 0.0
        hits: dict[int, float] = {}
        spans = []
        for end, (size, weight) in self.machine.iter(plain):
            start = end - size + 1
            if weight is None:
                spans.append((start, end))
            else:
                hits[start] = max(hits.get(start, 0.0), weight)
        total = sum(w for at, w in hits.items() if not any(a <= at < b for a, b in spans))
        return float(np.log1p(100 * total / max(1, plain.count(" ") - 1))), float(np.log1p(total))


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Weights of words and beginnings, from the rows (_label, _text) of a bounded sample."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
        for batch in batches:
            for label, text in zip(batch.column("_label").to_pylist(), batch.column("_text").to_pylist(), strict=True):
                counts[label].update(patterns(text))
        for label, found in enumerate(counts):
            n = pa.array(list(found.values()), pa.int64())
            none = pa.array(np.zeros(len(found), np.int64))
            yield pa.record_batch({"pattern": pa.array(list(found), pa.string()), "bad": n if label else none, "clean": none if label else n})

    n_bad, n_clean = (sample.where(F.col("_label") == label).count() for label in (1, 0))
    if not n_bad or not n_clean:
        return {}
    found = (sample.select("_label", "_text").mapInArrow(count, "pattern string, bad long, clean long")
             .groupBy("pattern").agg(F.sum("bad").alias("bad"), F.sum("clean").alias("clean")).where(F.col("bad") >= MIN_SUPPORT))
    bad, clean = F.col("bad") + 0.5, F.col("clean") + 0.5
    error = F.sqrt(1 / bad + 1 / clean)
    found = found.select("pattern", (F.log(bad / (n_bad + 1)) - F.log(clean / (n_clean + 1))).alias("weight"), error.alias("error"))
    return dict(map(tuple, found.where((F.col("weight") >= MIN_WEIGHT) & (F.col("weight") > CONFIDENCE * F.col("error"))).drop("error").collect()))


def fit(docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS) -> ToxicModel:
    """Lexicon and curve from a bounded sample, which is written to the shared folder."""
    sample = labelled_sample(docs, labels, "toxic", LEARN_ROWS, LEARN_BYTES)
    sample = written(sample.groupBy("_label", F.sha2("_text", 256).alias("_key")).agg(F.min("_id").alias("_id"), F.min("_text").alias("_text")))
    lexicon = learn_lexicon(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon, exceptions)
        for batch in batches:
            x = np.array([matcher.features(t) for t in batch.column("_text").to_pylist()]).reshape(-1, 2)
            yield pa.record_batch({"y": batch.column("_label").cast(pa.float64()), "a": pa.array(x[:, 0]), "b": pa.array(x[:, 1])})

    few = [sample.where(F.col("_label") == label).orderBy(F.xxhash64("_id"), "_id").limit(FIT_ROWS) for label in (0, 1)]
    rows = few[0].unionByName(few[1]).select("_label", "_text").mapInArrow(run, "y double, a double, b double").toArrow()
    x = np.column_stack([rows["a"].to_numpy(), rows["b"].to_numpy()]) if rows.num_rows else np.zeros((0, 2))
    if not lexicon:
        return ToxicModel({}, exceptions, (0.0, 0.0, -1.0))
    return ToxicModel(lexicon, exceptions, tuple(logistic_fit(x, rows["y"].to_numpy(), ridge=0.1)))


def toxicity_scores(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value.lexicon, shared.value.exceptions)
        weights = np.array(shared.value.weights)
        for batch in batches:
            x = np.array([matcher.features(t) for t in batch.column("_text").fill_null("").to_pylist()]).reshape(-1, 2)
            yield pa.record_batch({"_id": batch.column("_id"), "score": pa.array(logistic(x, weights), pa.float64())})

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, score double").withColumnRenamed("_id", id_col)


def held_out_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; learns from documents that are not held out only."""
    part = fold("doc_id", 5)
    model = fit(docs, labels.where(part != 0))
    return toxicity_scores(docs, model).select(
        "doc_id", F.coalesce(part == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

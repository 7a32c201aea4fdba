"""Quality by compression: zstandard dictionaries of good and of bad text.

A text costs fewer bytes with the dictionary that resembles it. The difference of the two compressed
sizes over the text's size, beside the smaller size over the text's size (text that repeats itself
compresses with any dictionary), is calibrated to a probability by a logistic curve. Dictionaries and
curve are fitted on a bounded sample of labelled documents (SAMPLE_ROWS and SAMPLE_BYTES a class); the
curve on documents that the dictionaries have not seen, and moved from the sample's rate of good
documents to that of all labels to learn from. Every document is scored whole, in one pass.

Defined results: a null text is an empty one; an empty text has both features 0 and a score like any
other; repeated rows are scored alike; without labels of both classes the score is 0.5, or the rate of
the labels that there are; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftmark.llm.labelled import fold, labelled_sample, logistic, logistic_fit

SAMPLE_ROWS = 3000
SAMPLE_BYTES = 12_000_000
DICTIONARY_BYTES = 112_640
LEVEL = 3


@dataclass(frozen=True)
class CompressionModel:
    """Dictionaries (empty: none could be built) and calibration."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]

    def differences(self, texts: list[bytes]) -> np.ndarray:
        if not (self.good and self.bad):
            return np.zeros((len(texts), 2))
        sizes = np.zeros((2, len(texts)))
        for row, raw in zip(sizes, (self.good, self.bad), strict=True):
            press = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(raw),
                                             write_content_size=False, write_dict_id=False)
            row[:] = [len(press.compress(t)) for t in texts]
        length = np.maximum([len(t) for t in texts], 1)
        return np.column_stack([sizes[1] - sizes[0], sizes.min(axis=0) * (np.array(list(map(len, texts))) > 0)]) / length[:, None]

    def score(self, texts: list[bytes]) -> np.ndarray:
        return logistic(self.differences(texts), np.array(self.weights))


def dictionary(texts: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of the texts; their plain bytes where there is too little to train on."""
    try:
        return zstandard.train_dictionary(size, [t for t in texts if t]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(texts)[-size:]


def fit(sample: DataFrame, good_rate: float | None = None) -> CompressionModel:
    """Fit on a bounded sample (labelled_sample); every third of it calibrates, to the rate of good documents."""
    rows = sample.select("_id", "_label", "_text").orderBy(F.xxhash64("_id"), "_id").toArrow()
    texts = [t.encode() for t in rows["_text"].to_pylist()]
    labels = rows["_label"].to_numpy() if rows.num_rows else np.zeros(0)
    calibrates = np.arange(len(texts)) % 3 == 0
    part = lambda label: [t for t, y, c in zip(texts, labels, calibrates, strict=True) if y == label and not c]
    good, bad = (dictionary(part(label)) if part(label) else b"" for label in (1, 0))
    model = CompressionModel(good, bad, (0.0, 0.0, 0.0))
    chosen = [t for t, c in zip(texts, calibrates, strict=True) if c]
    weights = logistic_fit(model.differences(chosen), labels[calibrates])
    share = labels[calibrates].mean() if len(chosen) else 0
    if good_rate is not None and 0 < share < 1 and 0 < good_rate < 1:
        weights[-1] += np.log(good_rate / (1 - good_rate)) - np.log(share / (1 - share))
    return CompressionModel(good, bad, tuple(weights))


def quality_scores(docs: DataFrame, model: CompressionModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").fill_null("").cast(pa.binary()).to_pylist()
            yield pa.record_batch({"_id": batch.column("_id"), "score": pa.array(shared.value.score(texts), pa.float64())})

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, score double").withColumnRenamed("_id", id_col)


def held_out_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; learns from documents that are not held out only."""
    part = fold("doc_id", 3)
    known = labels.where(part != 1)
    rate = known.where(F.col("quality").isin(0, 1)).agg(F.avg("quality").alias("rate")).first()["rate"]
    model = fit(labelled_sample(docs, known, "quality", SAMPLE_ROWS, SAMPLE_BYTES), rate)
    return quality_scores(docs, model).select(
        "doc_id", F.coalesce(part == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

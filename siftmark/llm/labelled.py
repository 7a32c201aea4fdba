"""Samples of labelled documents with a stated bound, and a small logistic fit."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: A text over this part of the byte budget is not taken into a sample, so that it can't end it.
LONGEST_SHARE = 0.25


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(parts))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, rows: int, text_bytes: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _label, _text) of at most `rows` labelled documents a class and `text_bytes` of text a class.

    Rows are taken in the order of the hash of their id, whole texts only, and none over LONGEST_SHARE of
    `text_bytes`. The ids are bounded by `rows`, so they are sent to every task and the texts are found in
    one pass.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
    known = known.groupBy("_id").agg(F.max("_label").alias("_label"))
    order = [F.xxhash64("_id"), F.col("_id")]
    picked = known.where("_label = 0").orderBy(*order).limit(rows).unionAll(known.where("_label = 1").orderBy(*order).limit(rows))
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    found = texts.join(F.broadcast(picked), "_id").groupBy("_id", "_label").agg(F.min("_text").alias("_text"))
    found = found.where(F.octet_length("_text") <= LONGEST_SHARE * text_bytes)
    # at most 2 * rows rows reach this window
    so_far = F.sum(F.octet_length("_text")).over(Window.partitionBy("_label").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return found.withColumn("_bytes", so_far).where(F.col("_bytes") <= text_bytes).drop("_bytes")


def logistic_fit(features: np.ndarray, labels: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights (the last is the constant) of a logistic model by Newton's method."""
    x = np.column_stack([features, np.ones(len(features))])
    w = np.zeros(x.shape[1])
    rate = (labels.sum() + 0.5) / (len(labels) + 1)
    w[-1] = np.log(rate / (1 - rate))
    for _ in range(rounds if len(labels) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - labels) + ridge * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def logistic(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features @ weights[:-1] + weights[-1], -30, 30)))

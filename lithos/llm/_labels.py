"""Bounded training samples of labelled documents, and calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds``; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, limit: int, *, id_col: str, text_col: str) -> DataFrame:
    """``id, text, label`` of at most ``limit`` labelled documents: those of least id hash, so the choice doesn't depend on order or layout.

    The ids are chosen from the labels alone; only then are texts fetched, with a broadcast of at
    most ``limit`` ids. Labels other than 0 and 1 are left out; of an id labelled both ways neither counts.
    """
    marked = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    marked = marked.withColumnRenamed("id", id_col).where(keep).withColumnRenamed(id_col, "id")
    marked = marked.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").drop("other")
    chosen = marked.orderBy(F.xxhash64("id"), "id").limit(limit)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "id")


def isotonic(scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of a non-decreasing curve from score to probability (pool adjacent violators; straight lines between blocks).

    With no rows the curve is 0.5 throughout.
    """
    if not len(scores):
        return np.array([0.0, 1.0]), np.array([0.5, 0.5])
    order = np.lexsort((labels, scores))
    x, y = scores[order], labels[order].astype(float)
    same = np.concatenate([[True], x[1:] != x[:-1]])
    group = np.cumsum(same) - 1
    weight = np.bincount(group).astype(float)
    mean, place = np.bincount(group, y) / weight, x[same]
    blocks: list[list[float]] = []  # mean, weight, first and last score
    for m, w, p in zip(mean, weight, place, strict=True):
        blocks.append([m, w, p, p])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m2, w2, _, last = blocks.pop()
            m1, w1, first, _ = blocks.pop()
            blocks.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, first, last])
    knots = [(p, b[0]) for b in blocks for p in ({b[2], b[3]} if b[2] != b[3] else {b[2]})]
    knots.sort()
    return np.array([k[0] for k in knots]), np.array([k[1] for k in knots])


def calibrated(scores: np.ndarray, knots: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The curve's probability, with a slight slope within its flats so that order is kept; from 0 to 1."""
    slope = 1 / (1 + np.exp(-np.clip(scores, -30, 30)))
    return np.clip(0.998 * np.interp(scores, *knots) + 0.002 * slope, 0.0, 1.0)

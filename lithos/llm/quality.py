"""Quality classifier: ridge regression on random Fourier features of document statistics, calibrated isotonically."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lithos.llm._labels import calibrated, fold, isotonic, labelled_sample
from lithos.llm._text import class_words, raw, text_slices, word_hashes

#: Labelled documents used at most, random features, width of the kernel in standard deviations, and ridge.
TRAIN_LIMIT, FEATURES, WIDTH, RIDGE, SEED = 20_000, 256, 4.0, 1e-2, 17

_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_UPPER, _LOWER, _DIGIT, _WIDE = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = _LOWER[97:123] = _DIGIT[48:58] = _WIDE[128:] = True


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of numbers per text; an empty text has zeros.

    Shares of upper case, digits, non-ASCII and single marks among bytes; logarithms of size and of
    words per line; lengths of words; shares of distinct words and of words met more than once in a
    row; and shares of words that begin with upper case, end in a mark, or are all upper case.
    """
    data, off = raw(texts)
    size = np.diff(off)
    starts, ends, first = class_words(data, off, _WORD)
    n = len(size)
    row = np.repeat(np.arange(n), size)

    def share(mask: np.ndarray) -> np.ndarray:
        return np.bincount(row[mask], minlength=n) / np.maximum(size, 1)

    words = np.diff(first)
    of = np.repeat(np.arange(n), words)
    length = ends - starts
    per = np.maximum(words, 1)
    code = word_hashes(data, starts, ends)
    order = np.lexsort((code, of))
    fresh = np.ones(len(code), bool)
    fresh[1:] = (code[order][1:] != code[order][:-1]) | (of[order][1:] != of[order][:-1])
    again = np.zeros(len(code), bool)
    again[1:] = (code[1:] == code[:-1]) & (of[1:] == of[:-1])
    mean_len = np.bincount(of, length, minlength=n) / per
    var_len = np.bincount(of, length.astype(float) ** 2, minlength=n) / per - mean_len**2
    head, tail = data[starts], data[ends - 1]
    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
    shout = (upper[ends] - upper[starts] >= 2) & (2 * (upper[ends] - upper[starts]) > length)
    lines = np.bincount(row[data == 10], minlength=n) + 1.0
    by_word = [np.bincount(of[m], minlength=n) / per for m in (_UPPER[head], (tail == 46) | (tail == 44), shout, again, length <= 3, length >= 16, ~(_LOWER | _UPPER | _WIDE | _DIGIT)[tail] & (tail != 46) & (tail != 44))]
    marks = [share(data == ord(c)) for c in "|!?#$%&*@.,:/_-<>\"'=+"]
    distinct = np.bincount(of[order][fresh], minlength=n) / per
    columns = [share(_UPPER[data]), share(_DIGIT[data]), share(_WIDE[data]), share(data == 32), *marks, *by_word, distinct, np.log1p(size), np.log1p(words), np.log1p(words / lines), mean_len, np.sqrt(np.maximum(var_len, 0))]
    out = np.stack(columns, axis=1)
    out[words == 0, :] = 0
    # Shares of a few hundredths matter as much as whole ones.
    k = 4 + len(marks) + len(by_word)
    out[:, :k] = np.sqrt(out[:, :k])
    return out


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: tuple[np.ndarray, np.ndarray]

    def features(self, stats: np.ndarray) -> np.ndarray:
        """cos(Wx + b): their products approximate a Gaussian kernel of the scaled statistics. The last column is 1."""
        rng = np.random.default_rng(SEED)
        w, b = rng.normal(0, 1 / WIDTH, (len(self.mean), FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.sqrt(2 / FEATURES) * np.cos(np.clip((stats - self.mean) / self.scale, -8, 8) @ w + b)
        return np.hstack([z, np.ones((len(z), 1))])

    def score(self, stats: np.ndarray) -> np.ndarray:
        return calibrated(self.features(stats) @ self.weights, self.knots)


def _normal_equations(sample: DataFrame, model: QualityModel) -> DataFrame:
    """Each partition's sums of Z'Z and Z'y, row by row, to be added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            z = model.features(np.array(batch.column("stats").to_pylist(), float).reshape(batch.num_rows, len(model.mean)))
            total += z.T @ np.hstack([z, np.asarray(batch.column("label"), float)[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES + 1)), pa.array(total.tolist(), pa.list_(pa.float64()))], ["k", "row"])

    return sample.mapInArrow(run, "k long, row array<double>")


def train_quality(docs: DataFrame, labels: DataFrame, *, label: str = "quality", folds: int = 5, held_out: int = 0, limit: int = TRAIN_LIMIT, id_col: str = "doc_id", text_col: str = "text") -> QualityModel:
    """Fit on at most ``limit`` labelled documents whose fold isn't ``held_out``; every fourth of them by hash only calibrates.

    Partitions sum their normal equations; at most one small matrix per partition of the bounded
    sample meets in a reduction by matrix row, and its sum comes to the driver. Without labelled
    rows every score is 0.5.
    """
    chosen = labelled_sample(docs, labels, label, fold(id_col, folds) != held_out, limit, id_col=id_col, text_col=text_col)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("label"), pa.array(statistics(part.column("text")).tolist(), pa.list_(pa.float64()))], ["id", "label", "stats"])

    sample = chosen.mapInArrow(measure, "id long, label int, stats array<double>").withColumn("part", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(4))).repartition(8, "id").cache()
    width = statistics(pa.array(["a"])).shape[1]
    ranges = sample.select(*[F.struct(F.avg(F.col("stats")[i]).alias("m"), F.stddev_samp(F.col("stats")[i]).alias("s")).alias(f"c{i}") for i in range(width)]).first()
    mean, scale = np.array([r.m or 0.0 for r in ranges]), np.array([max(r.s or 0.0, 1e-3) for r in ranges])
    model = QualityModel(mean, scale, np.zeros(FEATURES + 1), isotonic(np.zeros(0), np.zeros(0)))
    fitted = _normal_equations(sample.where("part != 0"), model)
    added = fitted.groupBy("k").agg(F.array(*[F.sum(F.col("row")[i]) for i in range(FEATURES + 2)]).alias("row")).collect()
    rows = np.zeros((FEATURES + 1, FEATURES + 2))
    for r in added:
        rows[r.k] = r.row
    left, right = rows[:, :-1], rows[:, -1]
    penalty = RIDGE * max(1.0, left[-1, -1]) / FEATURES * np.eye(FEATURES + 1)
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(left + penalty, right)
    rest = sample.where("part = 0").select("stats", "label").collect()
    if rest:
        raw_scores = model.features(np.array([r.stats for r in rest])) @ model.weights
        model.knots = isotonic(raw_scores, np.array([r.label for r in rest]))
    sample.unpersist()
    return model


def score_quality(docs: DataFrame, model: QualityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every whole text, 0 to 1; null texts score as empty ones, null and repeated ids keep their rows."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(held.value.score(statistics(part.column("text"))))], ["id", "score"])

    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, "id long, score double").withColumnRenamed("id", id_col)

"""Quality by ordinal cumulative-link regression on graded ratings.

A text becomes hashed counts of its words, of their shapes (``THE!!`` is ``A!``) and of immediate repetitions. One weight
per hashed feature serves all grades; the grades differ only in ordered thresholds: ``P(grade > k) = sigmoid(x w - t_k)``
with ``t_0 < t_1 < ...``. The model gives the expected grade and the probability of a grade from ``least`` on, which
decides selection.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import words as W
from demandloom.llm.toxicity import held_out, training_rows

BITS = 17
SQUEEZE = re.compile(rb"([^\s])\1+")
SHAPES = bytes(
    97 if chr(b) in "abcdefghijklmnopqrstuvwxyz" or b > 127 else 65 if chr(b) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    else 48 if chr(b) in "0123456789" else b for b in range(256)
)


def hashed_features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature slots and their weights, of length one together; a text without words has none."""
    words = W.word_hashes(W.split_words(text))
    if not len(words):
        return np.empty(0, np.int64), np.empty(0)
    shapes = W.word_hashes(SQUEEZE.sub(rb"\1", text.translate(SHAPES)).split())
    again = np.flatnonzero(words[1:] == words[:-1])
    repeats = np.full(len(again), 0x5EED, np.uint64)
    each = np.concatenate((words, W.mixed(shapes ^ np.uint64(1)), repeats))
    slots, counts = np.unique((each >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)
    values = np.log1p(counts)
    return slots, values / np.sqrt((values * values).sum())


@dataclass
class OrdinalModel:
    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, margin: np.ndarray) -> np.ndarray:
        """``P(grade > k)`` per row and threshold."""
        return 1 / (1 + np.exp(-np.clip(margin[:, None] - self.thresholds[None, :], -35, 35)))

    def score(self, text: bytes | None, least: int) -> tuple[float, float]:
        """Expected grade, and the probability of a grade of at least ``least``."""
        slots, values = hashed_features(text)
        above = self.above(np.array([self.weights[slots] @ values]))[0]
        share = np.diff(np.concatenate(([0.0], 1 - above, [1.0])))
        grades = np.array(self.grades, float)
        return float(share @ grades), float(share[grades >= least].sum())


def fit_ordinal(rows: list[tuple[str | None, int]], rounds: int = 150, rate: float = 0.3, penalty: float = 1e-5) -> OrdinalModel:
    """Gradient ascent on the likelihood, with per-feature step sizes. Without rows the only grade is 0."""
    grades = sorted({int(grade) for _, grade in rows}) or [0]
    weights = np.zeros(1 << BITS)
    if len(grades) == 1:
        return OrdinalModel(grades, weights, np.empty(0))
    parts = [hashed_features(text.encode() if text else None) for text, _ in rows]
    place = np.array([grades.index(int(grade)) for _, grade in rows])
    owner = np.repeat(np.arange(len(parts)), [len(slots) for slots, _ in parts])
    slots, values = np.concatenate([s for s, _ in parts]), np.concatenate([v for _, v in parts])
    shares = np.cumsum(np.bincount(place))[:-1] / len(place)
    first = np.log(shares / (1 - shares))
    # The first threshold and the logarithms of the gaps: the order of thresholds cannot be lost.
    shape = np.concatenate((first[:1], np.log(np.maximum(np.diff(first), 1e-3))))
    squares, shape_squares = np.full(1 << BITS, 1e-8), np.full(len(shape), 1e-8)
    for _ in range(rounds):
        thresholds = shape[0] + np.concatenate(([0.0], np.cumsum(np.exp(shape[1:]))))
        margin = np.bincount(owner, weights[slots] * values, minlength=len(parts))
        below = np.column_stack([np.zeros(len(parts)), 1 / (1 + np.exp(-np.clip(thresholds[None, :] - margin[:, None], -35, 35))), np.ones(len(parts))])
        rows_at = np.arange(len(parts))
        low, high = below[rows_at, place], below[rows_at, place + 1]
        chance = np.maximum(high - low, 1e-12)
        slope_low, slope_high = low * (1 - low), high * (1 - high)
        by_margin = (slope_low - slope_high) / chance
        by_threshold = np.array([
            (slope_high[place == k] / chance[place == k]).sum() - (slope_low[place == k + 1] / chance[place == k + 1]).sum()
            for k in range(len(thresholds))])
        gradient = np.bincount(slots, by_margin[owner] * values, minlength=1 << BITS) - penalty * len(parts) * weights
        gaps = np.exp(shape[1:]) * np.cumsum(by_threshold[::-1])[::-1][1:]
        shape_gradient = np.concatenate(([by_threshold.sum()], gaps))
        squares += gradient * gradient
        shape_squares += shape_gradient * shape_gradient
        weights = weights + rate * gradient / np.sqrt(squares)
        shape = shape + rate * shape_gradient / np.sqrt(shape_squares)
    return OrdinalModel(grades, weights.astype(np.float32), shape[0] + np.concatenate(([0.0], np.cumsum(np.exp(shape[1:])))))


def train_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = 8000) -> OrdinalModel:
    """Fit on at most ``limit`` labelled rows outside the held-out fold; scoring covers all rows."""
    return fit_ordinal(training_rows(docs, labels, label, limit))


def quality_scores(
    docs: DataFrame, labels: DataFrame, label: str = "quality", least: int = 1, chance: float = 0.5, limit: int = 8000
) -> DataFrame:
    """``doc_id, held_out, expected_grade, tail_probability, selected`` per row of ``docs``.

    ``tail_probability`` is that of a grade of at least ``least``; rows with ``chance`` or more are selected. Null and
    empty texts are scored by the thresholds alone. Repeated rows repeat their scores; other columns are ignored. Without
    labels the expected grade is 0 and nothing is selected.
    """
    model = docs.sparkSession.sparkContext.broadcast(train_quality(docs, labels, label, limit))
    schema = pa.schema([("doc_id", pa.int64()), ("expected_grade", pa.float64()), ("tail_probability", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.value
        for batch in W.slices(batches):
            scores = [scorer.score(text, least) for text in W.column_bytes(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s for s, _ in scores], pa.float64()), pa.array([t for _, t in scores], pa.float64())], schema=schema)

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = texts.mapInArrow(run, "doc_id bigint, expected_grade double, tail_probability double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "expected_grade", "tail_probability",
        (F.col("tail_probability") >= chance).alias("selected"))

"""Toxicity by compression distance: a zstandard dictionary of toxic text against one of ordinary text.

Both dictionaries begin with the same frequent ordinary words, so that ordinary text compresses alike under both. One
ends with words that mark toxic training documents (by log-odds of document counts), the other, equally long, with words
that mark ordinary ones. Windows of one word are written in UTF-16, which makes a match worth more than the header of its
sequence, and compressed with each dictionary; the difference in bytes is the window's score. Counts of windows over
several byte thresholds, and their means, are weighed by a logistic calibration fitted on training rows that the
dictionaries of that fold have not seen.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = re.compile(r"\w+")
ENCODING = "utf-16-le"
KEPT_WINDOWS = 200_000  # window scores a task remembers; they are computed again beyond that


def windows_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def _tail(words: list[str], size: int) -> str:
    """The words in reverse, so that the first ones lie at the end of the dictionary, cut at a word."""
    chosen, total = [], 0
    for word in words:
        if total > size:
            break
        chosen.append(word)
        total += len(word) + 1
    return " " + " ".join(reversed(chosen)) + " "


@dataclass
class Dictionaries:
    toxic: bytes
    ordinary: bytes
    level: int = 13
    _scores: dict[str, int] = field(default_factory=dict, repr=False)
    _compressors: list = field(default_factory=list, repr=False)

    def __getstate__(self):
        return {"toxic": self.toxic, "ordinary": self.ordinary, "level": self.level, "_scores": {}, "_compressors": []}

    def scores(self, windows: list[str]) -> np.ndarray:
        """Bytes that the toxic dictionary saves over the ordinary one, per window."""
        if not self._compressors:
            settings = zstandard.ZstdCompressionParameters.from_level(
                self.level, min_match=4, write_content_size=False, write_checksum=False, write_dict_id=False)
            for content in (self.ordinary, self.toxic):
                trained = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                trained.precompute_compress(compression_params=settings)
                self._compressors.append(zstandard.ZstdCompressor(dict_data=trained, compression_params=settings))
        ordinary, toxic = self._compressors
        known = self._scores
        if len(known) > KEPT_WINDOWS:
            known.clear()
        for window in set(windows).difference(known):
            data = f" {window} ".encode(ENCODING)
            known[window] = len(ordinary.compress(data)) - len(toxic.compress(data))
        return np.fromiter(map(known.__getitem__, windows), float, len(windows))


def train_dictionaries(
    rows: list[tuple[str | None, int]], shared_size: int = 8000, tail_size: int = 4000, min_documents: int = 5,
    min_odds: float = 5.0,
) -> Dictionaries:
    toxic, ordinary, sizes = Counter(), Counter(), [0, 0]
    for text, label in rows:
        (toxic if label else ordinary).update(set(windows_of(text)))
        sizes[label] += 1

    def odds(word: str) -> float:
        return float(np.log((toxic[word] + 0.1) / (sizes[1] + 0.2)) - np.log((ordinary[word] + 0.1) / (sizes[0] + 0.2)))

    marks = sorted((-odds(w), -toxic[w], w) for w in toxic if toxic[w] >= min_documents and odds(w) > min_odds)
    plain = sorted((odds(w), -ordinary[w], w) for w in ordinary if ordinary[w] >= 2 * min_documents)
    shared = _tail([w for w, _ in sorted(ordinary.items(), key=lambda kv: (-kv[1], kv[0]))[:20_000]], shared_size)
    end = _tail([w for *_, w in marks], tail_size)
    other = _tail([w for *_, w in plain], len(end))[-len(end):]
    return Dictionaries((shared + end).encode(ENCODING), (shared + other.rjust(len(end))).encode(ENCODING))


def features(scores: np.ndarray) -> np.ndarray:
    if not len(scores):
        scores = np.zeros(1)
    top = np.sort(scores)[::-1][:3]
    over4, over8, over12 = (np.maximum(scores - k, 0) for k in (4, 8, 12))
    return np.array([
        scores.mean(), top[0], top.mean(), over4.mean(), over8.mean(), over8.sum() ** 0.5, over12.sum() ** 0.5,
        (scores >= 5).mean(), (scores >= 6).mean(), (scores >= 7).mean(), (scores >= 10).mean(),
        np.log1p((scores >= 6).sum()), np.log1p((scores >= 8).sum()), len(scores) ** -0.5, np.log(len(scores)),
    ])


@dataclass
class ToxicityModel:
    dictionaries: Dictionaries | None
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def score(self, text: str | None) -> float:
        if self.dictionaries is None:
            return self.prior
        values = (features(self.dictionaries.scores(windows_of(text))) - self.mean) / self.scale
        return float(1 / (1 + np.exp(-np.clip(values @ self.weights[:-1] + self.weights[-1], -35, 35))))


def _logistic(rows: np.ndarray, labels: np.ndarray, penalty: float = 1e-4, rounds: int = 60):
    mean, scale = rows.mean(0), rows.std(0) + 1e-9
    x = np.c_[(rows - mean) / scale, np.ones(len(rows))]
    weights = np.zeros(x.shape[1])
    ridge = penalty * len(labels)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -35, 35)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        weights = weights + np.linalg.solve(hessian, x.T @ (labels - p) - ridge * weights)
    return mean, scale, weights


def fit(rows: list[tuple[str | None, int]]) -> ToxicityModel:
    """Dictionaries and calibration from labelled texts; with one class only, every score is that class's share."""
    rows = [(text, int(label > 0)) for text, label in rows]
    labels = np.array([label for _, label in rows], float)
    prior = float(labels.mean()) if len(labels) else 0.0
    none = np.zeros(1)
    if not 2 <= labels.sum() <= len(labels) - 2:
        return ToxicityModel(None, none, none, none, prior)
    # Windows are cut again for each pass: kept, they would take several times the memory of the texts.
    table, order = [], []
    for fold in (0, 1):
        trained = train_dictionaries(rows[1 - fold :: 2])
        for text, label in rows[fold::2]:
            table.append(features(trained.scores(windows_of(text)))), order.append(label)
    mean, scale, weights = _logistic(np.array(table), np.array(order, float))
    return ToxicityModel(train_dictionaries(rows), mean, scale, weights, prior)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> list[tuple[str | None, int]]:
    """At most ``limit`` labelled texts outside the held-out fold, the ones whose hashed ids are smallest."""
    chosen = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label")).where(
        "doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = chosen.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), F.xxhash64("text")).limit(limit)
    return [(row["text"], row["label"]) for row in rows.collect()]


def held_out(doc_id):
    """Rows kept from training: ``crc32(doc_id as text) mod 5 = 0``; a row without id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def train_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = 6000) -> ToxicityModel:
    """Fit on at most ``limit`` labelled rows. ``limit`` bounds what the driver holds; scoring covers all rows."""
    return fit(training_rows(docs, labels, label, limit))


def with_toxicity(docs: DataFrame, model: ToxicityModel, name: str = "toxicity") -> DataFrame:
    """``docs`` with a score column from 0 to 1; null and empty texts are scored as texts without any window."""
    model = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.value
        for batch in batches:
            scores = pa.array([scorer.score(text) for text in batch.column(place).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def toxicity_scores(docs: DataFrame, labels: DataFrame, limit: int = 6000) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``."""
    model = train_toxicity(docs, labels, limit=limit)
    scored = with_toxicity(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")), model, "score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, limit: int = 6000) -> DataFrame:
    """The rows of ``docs`` scored under 0.5; columns stay."""
    name = "__toxicity"
    return with_toxicity(docs, train_toxicity(docs, labels, limit=limit), name).where(F.col(name) < 0.5).drop(name)

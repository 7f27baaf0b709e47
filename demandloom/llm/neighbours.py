"""Nearest neighbours by blocked int8 products with error bounds.

Vectors are scaled to length one and rounded to 8 bits. The rounding error of each vector is kept, so the product of two
rounded vectors bounds the true cosine from both sides. Query blocks meet blocks of rows; each meeting is one matrix
product. A pair stays if its upper bound reaches the k-th largest lower bound of its query within the block; only those
are computed again in double precision from the original vectors. Every block gives its k best per query, kept in a heap,
and the k best of those are the answer. All rows are searched, so the result is exact.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm.storage import discard, written
from demandloom.llm.words import fingerprint

BLOCK_ROWS = 2048
SLICES = 64  # parts over which a query block's meetings are dealt


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of length one as int8, their scale, and the length of the rounding error (with room for float error)."""
    unit = vectors / np.linalg.norm(vectors / np.abs(vectors).max(1, keepdims=True), axis=1, keepdims=True)
    unit = unit / np.abs(vectors).max(1, keepdims=True)
    scale = np.abs(unit).max(1) / 127
    whole = np.rint(unit / scale[:, None]).astype(np.int8)
    return whole, scale, np.linalg.norm(unit - whole * scale[:, None], axis=1) + 1e-9


def bounds(one, two) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all cosines between two quantised blocks."""
    (a, scale_a, error_a), (b, scale_b, error_b) = one, two
    # Products of int8 rows are whole numbers below 2**24 up to a thousand dimensions, and exact in double beyond.
    kind = np.float32 if a.shape[1] <= 1000 else np.float64
    product = (a.astype(kind) @ b.astype(kind).T) * scale_a[:, None] * scale_b[None, :]
    length_a = 1 + error_a
    error = error_a[:, None] + length_a[:, None] * error_b[None, :] + 1e-6
    return product - error, product + error


def cosine(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Cosines in double precision, summed from left to right as SQL does; equal vectors get equal values.

    Vectors are divided by their largest component first, so multiples of a vector tie and no square leaves the range.
    """
    x, y = one / np.abs(one).max(), many / np.abs(many).max(1, keepdims=True)

    def total(values: np.ndarray) -> np.ndarray:
        return values.cumsum(axis=-1)[..., -1]

    return total(y * x) / np.sqrt(total(x * x) * total(y * y))


def _packed(kind: str):
    schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("vectors", pa.binary()), ("dims", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def emit(dims: int) -> pa.RecordBatch:
            ids, vectors = held.pop(dims)
            data = np.array(vectors, kind).tobytes()
            return pa.RecordBatch.from_arrays([
                pa.array([fingerprint(np.array(ids, np.int64))], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                pa.array([data], pa.binary()), pa.array([dims], pa.int32())], schema=schema)

        for batch in batches:
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, vectors = held.setdefault(len(vector), ([], []))
                ids.append(vec_id), vectors.append(vector)
                if len(ids) == BLOCK_ROWS:
                    yield emit(len(vector))
        for dims in list(held):
            yield emit(dims)

    return run


def _nearest(k: int, kind: str):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dims = row["dims"]
                asked = np.frombuffer(row["asked"], kind).reshape(-1, dims).astype(float)
                vectors = np.frombuffer(row["vectors"], kind).reshape(-1, dims).astype(float)
                ids, query_ids = np.array(row["ids"], np.int64), np.array(row["query_ids"], np.int64)
                low, high = bounds(quantised(asked), quantised(vectors))
                own = query_ids[:, None] == ids[None, :]
                low[own] = high[own] = -np.inf
                take = min(k, len(ids))
                least = np.partition(low, len(ids) - take, axis=1)[:, len(ids) - take]
                out: list[tuple[int, int, float]] = []
                for q in range(len(query_ids)):
                    near = np.flatnonzero((high[q] >= least[q]) & ~own[q])
                    if len(near):
                        scores = cosine(asked[q], vectors[near])
                        best = heapq.nsmallest(k, zip((-scores).tolist(), ids[near].tolist()))
                        out += [(int(query_ids[q]), vec_id, -score) for score, vec_id in best]
                columns = list(zip(*out)) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(columns[0]), pa.int64()), pa.array(list(columns[1]), pa.int64()),
                     pa.array(list(columns[2]), pa.float64())], schema=schema)

    return run


def nearest(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of largest cosine for each row whose id ``every`` divides.

    Takes ``vec_id`` and ``embedding``. Vectors that are null, empty, zero or hold null or non-finite components take no
    part, nor do rows without ``vec_id``; vectors of different lengths are never compared. A query does not find rows of
    its own id; other repeated rows are found once each per distinct ``vec_id`` and score. Ties go to the smaller id.
    """
    numbers = F.col("embedding").cast("array<double>")
    sound = F.coalesce(F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    used = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), numbers.alias("embedding")).where("vec_id is not null").where(
        sound & F.exists("embedding", lambda x: x != 0)).dropDuplicates()
    used = written(used, "nearest-vectors")
    kind = "float32" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "float64"
    columns = "block bigint, ids array<bigint>, vectors binary, dims int"
    blocks = written(used.mapInArrow(_packed(kind), columns), "nearest-blocks")
    queries = written(used.where(F.col("vec_id") % every == 0).mapInArrow(_packed(kind), columns), "nearest-queries")
    discard(used)
    # Every block of rows meets every query block of its length. Which ones meet is told by their numbers alone; a query
    # block is then copied to a fixed number of slices, so that its meetings are not one task's.
    numbers_only = queries.select(F.col("block").alias("asked_block"), "dims")
    meetings = blocks.join(numbers_only, "dims").withColumn("slice", F.pmod("block", F.lit(SLICES)))
    copies = queries.select(
        F.col("block").alias("asked_block"), F.col("ids").alias("query_ids"), F.col("vectors").alias("asked"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SLICES - 1).cast("bigint"))).alias("slice"))
    tiles = meetings.join(copies, ["asked_block", "slice"]).select("query_ids", "asked", "ids", "vectors", "dims")
    found = tiles.mapInArrow(_nearest(k, kind), "query_id bigint, vec_id bigint, score double").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

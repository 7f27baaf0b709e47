"""Benchmark decontamination by greedy string tiling.

Word runs of benchmark items are joined with documents on shared seeds (hashed runs of ``min_match`` words). A document
passes on only the words that stand in such seeds, as nothing else can be in a tile. Per document text and item the
longest common run of unmarked words is marked again and again, found by running Karp-Rabin hashes; the share of the
item's words that end up marked is its coverage, whatever the order of the passages.

The seeds reach the scan as two bitmaps of fixed size; the exact join follows, so more seeds cost time, not results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import words as W
from demandloom.llm.storage import discard, in_membership, membership, written

BASE = np.uint64(0x9E3779B97F4A7C55)  # odd, so that its powers never vanish


def _powers(count: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate(([np.uint64(1)], np.cumprod(np.full(count, BASE, np.uint64))))


def _running(tokens: np.ndarray, powers: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate(([np.uint64(0)], np.cumsum(tokens * powers[: len(tokens)])))


def _free(marked: np.ndarray, size: int) -> np.ndarray:
    """Starts of the windows of ``size`` places none of which is marked."""
    upto = np.concatenate(([0], np.cumsum(marked)))
    return np.flatnonzero(upto[size:] == upto[:-size])


class _Side:
    def __init__(self, tokens: np.ndarray, places: np.ndarray, powers: np.ndarray):
        self.tokens, self.places, self.powers = tokens, places, powers
        self.running, self.marked = _running(tokens, powers), np.zeros(len(tokens), bool)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if size > len(self.tokens):
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        starts = _free(self.marked, size)
        starts = starts[self.places[starts + size - 1] - self.places[starts] == size - 1]
        with np.errstate(over="ignore"):
            hashes = (self.running[starts + size] - self.running[starts]) * self.powers[len(self.powers) - 1 - starts]
        return starts, hashes


def greedy_tiles(item: np.ndarray, text: np.ndarray, places: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Tiles ``(start in item, place in text, length)``, longest first; ``text`` holds the words at ``places``."""
    powers = _powers(max(len(item), len(text)) + 1)
    one, two = _Side(item, np.arange(len(item)), powers), _Side(text, places, powers)
    tiles, longest = [], min(len(item), len(text))

    def common(size: int) -> np.ndarray:
        return np.intersect1d(one.windows(size)[1], two.windows(size)[1])

    while longest >= min_match:
        low, high = min_match - 1, longest  # a common run of a length holds runs of every smaller one
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if len(common(middle)) else (low, middle - 1)
        longest = low
        if longest < min_match:
            break
        (starts, hashes), (others, theirs) = one.windows(longest), two.windows(longest)
        at: dict[int, list[int]] = {}
        for start, value in zip(starts.tolist(), hashes.tolist()):
            at.setdefault(value, []).append(start)
        found = False
        hits = np.isin(theirs, hashes)
        for other, value in zip(others[hits].tolist(), theirs[hits].tolist()):
            for start in at.get(value, []):
                here, there = slice(start, start + longest), slice(other, other + longest)
                if one.marked[here].any() or two.marked[there].any() or not np.array_equal(item[here], text[there]):
                    continue
                one.marked[here] = two.marked[there] = found = True
                tiles.append((start, int(places[other]), longest))
                break
        longest = longest if found else longest - 1
    return tiles


def _item_words(min_match: int):
    schema = pa.schema([("item_id", pa.int64()), ("item", pa.list_(pa.int64())), ("seeds", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches):
            hashes = [W.word_hashes(W.split_words(text)) for text in W.column_bytes(batch, "text")]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), W.long_lists([W.signed(h) for h in hashes]),
                W.long_lists([W.signed(np.unique(W.shingle_hashes(h, min_match))) for h in hashes]),
            ], schema=schema)

    return run


def _seeded(min_match: int, maps):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text_key", pa.int64()), ("places", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64())),
        ("seeds", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # texts of this task: a copy repeats only its row
        nothing = np.empty(0, np.int64)
        for batch in W.slices(batches):
            ids, keys, places, tokens, seeds = [], [], [], [], []
            for doc_id, key, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), W.column_bytes(batch, "text")
            ):
                if key not in seen:
                    hashes = W.word_hashes(W.split_words(text))
                    shingles = W.shingle_hashes(hashes, min_match)
                    hit = np.flatnonzero(in_membership(shingles, maps.value)) if len(shingles) else nothing
                    if not len(hit):
                        continue
                    seen.add(key)
                    within = np.unique((hit[:, None] + np.arange(min_match)).ravel())
                    places.append(within), tokens.append(W.signed(hashes[within])), seeds.append(W.signed(np.unique(shingles[hit])))
                else:
                    places.append(nothing), tokens.append(nothing), seeds.append(nothing)
                ids.append(doc_id), keys.append(key)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), W.long_lists(places), W.long_lists(tokens),
                W.long_lists(seeds)], schema=schema)

    return run


def _tiled(min_match: int):
    schema = pa.schema([
        ("text_key", pa.int64()), ("item_id", pa.int64()), ("item_words", pa.int64()), ("covered", pa.int64()),
        ("tiles", pa.list_(pa.struct([("item_word", pa.int64()), ("doc_word", pa.int64()), ("words", pa.int64())]))),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches):
            rows = []
            for row in batch.to_pylist():
                item, text = np.array(row["item"], np.int64).view(np.uint64), np.array(row["tokens"], np.int64).view(np.uint64)
                tiles = greedy_tiles(item, text, np.array(row["places"], np.int64), min_match)
                rows.append({
                    "text_key": row["text_key"], "item_id": row["item_id"], "item_words": len(item),
                    "covered": sum(tile[2] for tile in tiles),
                    "tiles": [dict(zip(("item_word", "doc_word", "words"), tile)) for tile in tiles],
                })
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, percent: int = 50) -> DataFrame:
    """``doc_id, text_key, item_id, item_words, covered, coverage, tiles`` where tiles cover ``percent`` of an item.

    ``text_key`` is ``xxhash64(text)``; equal texts are compared once and share the result. Null or empty texts, and
    items or texts of fewer than ``min_match`` words, match nothing. Repeated rows repeat their results, repeated items
    count once, rows without ``doc_id`` are reported with null, an item without ``item_id`` is left out. Other columns
    are ignored.
    """
    spark = docs.sparkSession
    given = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = written(given.where("item_id is not null and text is not null").dropDuplicates(["item_id", "text"]).mapInArrow(
        _item_words(min_match), "item_id bigint, item array<bigint>, seeds array<bigint>"), "tiling-items")
    seeds = items.select("item_id", F.explode("seeds").alias("seed"))
    maps = spark.sparkContext.broadcast(membership(seeds, "seed"))
    texts = docs.where("text is not null").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string").alias("text"))
    hits = written(texts.mapInArrow(
        _seeded(min_match, maps),
        "doc_id bigint, text_key bigint, places array<bigint>, tokens array<bigint>, seeds array<bigint>"), "tiling-hits")
    held = hits.where(F.size("seeds") > 0)
    pairs = held.select("text_key", F.explode("seeds").alias("seed")).join(seeds, "seed").select("text_key", "item_id").distinct()
    single = held.select("text_key", "places", "tokens").dropDuplicates(["text_key"])
    meeting = pairs.join(single, "text_key").join(items.select("item_id", "item"), "item_id")
    tiled = meeting.select("text_key", "item_id", "item", "places", "tokens").mapInArrow(
        _tiled(min_match),
        "text_key bigint, item_id bigint, item_words bigint, covered bigint, "
        "tiles array<struct<item_word:bigint,doc_word:bigint,words:bigint>>")
    found = written(tiled.where(F.col("covered") * 100 >= F.col("item_words") * percent).where("covered > 0"), "tiling-found")
    discard(items)
    return hits.select("doc_id", "text_key").join(found, "text_key").select(
        "doc_id", "text_key", "item_id", "item_words", "covered", (F.col("covered") / F.col("item_words")).alias("coverage"), "tiles")


def without_benchmark(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, percent: int = 50) -> DataFrame:
    """The rows of ``docs`` whose text covers no item; columns stay."""
    found = contamination(docs, benchmark, min_match, percent).select(F.col("text_key").alias("__text_key")).distinct()
    return docs.join(found, F.xxhash64(docs["text"]) == found["__text_key"], "left_anti").select(*docs.columns)

"""Language-model scoring by cross-entropy difference.

Two bigram models with one vocabulary and one smoothing are counted over all documents: the target model over the
documents of the target set, the background model over every document. A document's score is its loss per token under the
target model less that under the background model; low scores read like the target.

The vocabulary of both models is every distinct word of all documents, by 64-bit hash, so the models grow with the corpus.
Counts and texts meet in two exchanges of packed arrays:

1. *Ask.* Texts are read in blocks of about ``BLOCK`` words. A block sends the sorted hashes of its distinct words and pairs
   of words, with how often it holds them, to buckets of the hash range, a row per block and bucket; and the words' numbers
   and text lengths along with one of them.
2. *Answer.* A bucket adds up what all blocks hold and answers each row with the corpus' counts, in the row's own order. A
   word or pair comes once per block however frequent it is, and buckets are as many as keep one small, so none is hot.
   The answers are written; the driver receives the number of words, distinct words and words of the target.
3. *Score.* Back at its block, an answer needs no keys: buckets are ranges, so answers in the order of buckets are in the
   order of the block's own hashes.

``train_pair`` gives the same model as tables of counts.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import words as W
from demandloom.llm.storage import written

BLOCK = 3 << 18  # words of a block; a longer text is a block of its own
BUCKETS = 256  # at least
KNOWN_IDS = 1 << 21  # ids of a target set that are sent to all tasks (16 MB); a larger set is joined
BUCKET_WORDS = 1 << 20  # about so many words of the corpus per bucket
START = 0  # stands before the first word; no word's hash but with a chance of 2**-64
HELD = 1 << 20  # words a task holds before it adds them up
STRENGTH = 8.0  # weight of the word model within a pair's probability


def slots(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a text's words, and of each word (from the second on) the word before and itself."""
    hashes = W.signed(W.word_hashes(W.split_words(text)))
    return hashes, np.stack((hashes[:-1], hashes[1:]), 1)


def _begun(hashes: np.ndarray) -> np.ndarray:
    return np.concatenate((np.full(min(len(hashes), 1), START, np.int64), hashes[:-1]))


def _added(before: np.ndarray, words: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs and the sums of their weights, a column each."""
    with np.errstate(over="ignore"):
        keys = W.mixed(W.mixed(before.view(np.uint64) + W.MIX[1]) * W.MIX[0] + words.view(np.uint64))
    _, first, which = np.unique(keys, return_index=True, return_inverse=True)
    sums = np.stack([np.bincount(which, column, len(first)).astype(np.int64) for column in weights])
    return before[first], words[first], sums


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["before", "word", "whole", "target"]
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def flushed() -> pa.RecordBatch:
        before, words, sums = _added(*[np.concatenate([part[k] for part in held], axis=-1) for k in range(3)])
        return pa.RecordBatch.from_arrays([pa.array(column) for column in (before, words, *sums)], names=names)

    for batch in W.slices(batches):
        for chosen, text in zip(batch.column(0).to_pylist(), W.column_bytes(batch, "text")):
            hashes = slots(text)[0]
            held.append((_begun(hashes), hashes, np.stack((np.ones(len(hashes)), np.full(len(hashes), float(chosen))))))
            size += len(hashes)
            if size >= HELD:
                yield flushed()
                held, size = [], 0
    if size:
        yield flushed()


def packed(values: np.ndarray) -> bytes:
    """Whole numbers byte by byte of equal weight, compressed: most bytes of great weight are zeros."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    return bytes([raw.shape[1]]) + zstandard.compress(raw.T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    return np.ascontiguousarray(raw.T).view(f"u{data[0]}").ravel()


def packed_sorted(values: np.ndarray) -> bytes:
    return packed(np.diff(values, prepend=np.uint64(0)))


def unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64)


def _narrowest(values: np.ndarray) -> np.ndarray:
    most = int(values.max(initial=0))
    return values.astype(next(kind for kind in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(kind).max))


def _later(lengths: np.ndarray) -> np.ndarray:
    """Places of the words that have one before them in their text, in texts laid end to end."""
    inside = np.ones(lengths.sum(), bool)
    inside[(np.cumsum(lengths) - lengths)[lengths > 0]] = False
    return np.flatnonzero(inside)


def pair_keys(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return W.mixed(W.mixed(before + W.MIX[1]) * W.MIX[0] + words)


ASKED = pa.schema([
    ("block", pa.int64()), ("bucket", pa.int32()), ("words", pa.binary()), ("word_counts", pa.binary()),
    ("word_targets", pa.binary()), ("pairs", pa.binary()), ("pair_counts", pa.binary()), ("pair_targets", pa.binary()),
    ("body", pa.binary()),
])
ASKED_DDL = ("block bigint, bucket int, words binary, word_counts binary, word_targets binary, pairs binary, pair_counts binary, "
             "pair_targets binary, body binary")


def _asks(bits: int):
    """Blocks of ``doc_id, chosen, text`` rows as a row per bucket, and one with the texts as numbers of the block's words."""
    shift = np.uint64(64 - bits)

    def told(hashes: np.ndarray, counts: np.ndarray, targets: np.ndarray) -> dict[int, tuple[bytes, bytes, bytes]]:
        buckets = (hashes >> shift).astype(np.int64)
        edges = np.flatnonzero(np.diff(buckets, prepend=-1)).tolist()
        return {
            int(buckets[start]): (packed_sorted(hashes[start:end]), packed(_narrowest(counts[start:end])), packed(_narrowest(targets[start:end])))
            for start, end in zip(edges, [*edges[1:], len(hashes)])
        }

    def block(number: int, docs: list[tuple[int | None, bool, np.ndarray]]) -> Iterator[dict]:
        lengths = np.array([len(hashes) for _, _, hashes in docs], np.int64)
        tokens = np.concatenate([hashes for _, _, hashes in docs])
        weight = np.repeat(np.array([chosen for _, chosen, _ in docs], np.float64), lengths)
        words, ids, often = np.unique(tokens, return_inverse=True, return_counts=True)
        rank = np.argsort(-often, kind="stable")  # frequent words get small numbers, which compress
        number_of = np.empty(len(words), np.int64)
        number_of[rank] = np.arange(len(words))
        name = (TaskContext.get().partitionId() << 32) + number
        body = pickle.dumps((
            [doc_id for doc_id, _, _ in docs], packed(_narrowest(lengths)), packed(_narrowest(number_of[ids])), packed(words[rank])))
        yield {"block": name, "bucket": int(np.uint64(W.mixed(np.array([name], np.uint64))[0]) >> shift), "body": body}
        places = _later(lengths)
        pairs, which = np.unique(pair_keys(tokens[places - 1], tokens[places]), return_inverse=True)
        asked = told(words, often, np.bincount(ids, weight, len(words)).astype(np.int64))
        more = told(pairs, np.bincount(which, minlength=len(pairs)), np.bincount(which, weight[places], len(pairs)).astype(np.int64))
        for bucket in sorted({*asked, *more}):
            mine, both = asked.get(bucket, (None,) * 3), more.get(bucket, (None,) * 3)
            yield dict(zip(ASKED.names, (name, bucket, *mine, *both, None)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, 0
        for batch in W.slices(batches):
            for doc_id, chosen, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), W.column_bytes(batch, "text")):
                hashes = W.word_hashes(W.split_words(text))
                held.append((doc_id, chosen, hashes))
                size += len(hashes)
                if size >= BLOCK:
                    yield pa.RecordBatch.from_pylist(list(block(number, held)), ASKED)
                    held, size, number = [], 0, number + 1
        if held:
            yield pa.RecordBatch.from_pylist(list(block(number, held)), ASKED)

    return run


ANSWERED_DDL = f"{ASKED_DDL}, size bigint, whole bigint, target bigint"


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: the counts in them give way to those of the corpus. A bucket is held at a time.

    The first row of a bucket has its number of distinct words, of words, and of words of the target.
    """
    kinds = [pa.field(name, pa.int64()) for name in ("size", "whole", "target")]
    schema = pa.schema([*ASKED, *kinds])

    def summed(rows: list[dict], keys: str, counts: str, targets: str) -> tuple[int, int, int]:
        having = [row for row in rows if row[keys] is not None]
        if not having:
            return 0, 0, 0
        hashes = [unpacked_sorted(row[keys]) for row in having]
        distinct, which = np.unique(np.concatenate(hashes), return_inverse=True)
        sums = [
            np.bincount(which, np.concatenate([unpacked(row[name]) for row in having]).astype(np.float64), len(distinct)).astype(np.int64)
            for name in (counts, targets)
        ]
        ends = np.cumsum([len(h) for h in hashes]).tolist()
        for row, start, end in zip(having, [0, *ends], ends):
            row[keys] = None
            for name, total in zip((counts, targets), sums):
                row[name] = packed(_narrowest(total[which[start:end]]))
        return len(distinct), int(sums[0].sum()), int(sums[1].sum())

    def answered(rows: list[dict]) -> pa.RecordBatch:
        zero = dict.fromkeys(("size", "whole", "target"), 0)
        told = dict(zip(zero, summed(rows, "words", "word_counts", "word_targets")))
        summed(rows, "pairs", "pair_counts", "pair_targets")
        for row in rows:
            row["bucket"] = -1 if row["body"] is not None else row["bucket"]
        return pa.RecordBatch.from_pylist([row | (zero if k else told) for k, row in enumerate(rows)], schema)

    held: list[dict] = []
    for batch in W.slices(batches):
        for row in batch.to_pylist():
            if held and held[0]["bucket"] != row["bucket"]:
                yield answered(held)
                held = []
            held.append(row)
    if held:
        yield answered(held)


SCORED_DDL = "doc_id bigint, n_tokens bigint, target_loss double, background_loss double"


def _scores(size: int, totals: tuple[int, int]):
    """Rows sorted by block, its body first and then its answers by bucket. A block is held at a time."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("target_loss", pa.float64()), ("background_loss", pa.float64())])

    def scored(body: bytes, answers: list[dict]) -> pa.RecordBatch:
        doc_ids, lengths, numbers, words = pickle.loads(body)
        lengths, words = unpacked(lengths).astype(np.int64), unpacked(words)
        order = np.argsort(words)
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        ids, words = place[unpacked(numbers).astype(np.int64)], words[order]
        places = _later(lengths)
        _, which = np.unique(pair_keys(words[ids[places - 1]], words[ids[places]]), return_inverse=True)
        owner, losses = np.repeat(np.arange(len(lengths)), lengths), []
        for word_name, pair_name, total in (("word_targets", "pair_targets", totals[0]), ("word_counts", "pair_counts", totals[1])):
            counts, pairs = (
                np.concatenate([np.empty(0), *[unpacked(row[name]) for row in answers if row[name] is not None]]) for name in (word_name, pair_name))
            single = (counts + 0.5) / (total + 0.5 * size)
            chance = single[ids]
            before = counts[ids[places - 1]]
            chance[places] = (pairs[which] + STRENGTH * chance[places]) / (before + STRENGTH)
            sums = np.bincount(owner, -np.log(chance), len(lengths))
            losses.append([loss / n if n else None for loss, n in zip(sums.tolist(), lengths.tolist())])
        return pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(lengths), *[pa.array(x, pa.float64()) for x in losses]], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        body, answers = None, []
        for batch in W.slices(batches):
            for row in batch.to_pylist():
                if row["body"] is not None:
                    if body is not None:
                        yield scored(body, answers)
                    body, answers = row["body"], []
                else:
                    answers.append(row)
        if body is not None:
            yield scored(body, answers)

    return run


@dataclass
class CountTable:
    """One column of counts; looked up by a word's hash, or the hashes of two words."""

    rows: DataFrame
    keys: tuple[str, ...]
    column: str

    def sum(self) -> int:
        return self.rows.agg(F.sum(self.column)).first()[0] or 0

    def __len__(self) -> int:
        return self.rows.count()

    def __getitem__(self, key) -> int:
        found = self.rows
        for name, value in zip(self.keys, np.atleast_1d(key)):
            found = found.where(F.col(name) == int(value))
        return found.agg(F.sum(self.column)).first()[0] or 0


@dataclass
class BigramPair:
    """Counts of both models: ``before, word, whole, target`` and ``word, whole, target``, all words in both."""

    pairs: DataFrame
    words: DataFrame

    @property
    def tables(self) -> dict[str, CountTable]:
        inner = self.pairs.where(F.col("before") != START)
        return {
            "target_words": CountTable(self.words, ("word",), "target"), "all_words": CountTable(self.words, ("word",), "whole"),
            "target_pairs": CountTable(inner, ("before", "word"), "target"), "all_pairs": CountTable(inner, ("before", "word"), "whole"),
        }


def _members(ids):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0)
            inside = np.isin(own.fill_null(0).to_numpy(zero_copy_only=False), ids.value) & np.array(own.is_valid())
            yield pa.RecordBatch.from_arrays([own, pa.array(inside), batch.column(1)], names=["doc_id", "chosen", "text"])

    return run


def _flagged(docs: DataFrame, target: DataFrame) -> DataFrame:
    """``doc_id, chosen, text``; null texts read as empty. Texts are only moved if the target set is a large one."""
    chosen = target.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id is not null").distinct()
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if chosen.limit(KNOWN_IDS + 1).count() > KNOWN_IDS:
        marked = texts.join(chosen.withColumn("chosen", F.lit(True)), "doc_id", "left")
        return marked.select("doc_id", F.coalesce("chosen", F.lit(False)).alias("chosen"), "text")
    ids = docs.sparkSession.sparkContext.broadcast(np.sort(np.array([row[0] for row in chosen.collect()], np.int64)))
    return texts.mapInArrow(_members(ids), "doc_id bigint, chosen boolean, text string")


def train_pair(docs: DataFrame, target: DataFrame) -> BigramPair:
    """Counts over every row of ``docs``; ``target`` lists the ``doc_id`` of the target set."""
    parts = _flagged(docs, target).select("chosen", "text").mapInArrow(_counted, "before bigint, word bigint, whole bigint, target bigint")
    sums = [F.sum(name).alias(name) for name in ("whole", "target")]
    pairs = written(parts.groupBy("before", "word").agg(*sums), "language-pairs")
    return BigramPair(pairs, written(pairs.groupBy("word").agg(*sums), "language-words"))


def cross_entropy_difference(docs: DataFrame, target: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, target_loss, background_loss, score`` per row of ``docs``.

    Losses are nats per word; ``score`` is the target's less the background's. Texts without words have no losses and no
    score (null). A row without ``doc_id`` belongs to the background only. Repeated rows count and are scored each; other
    columns are ignored. An empty target leaves a uniform model in its place; no documents give no rows.
    """
    flagged = _flagged(docs, target)
    size = flagged.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(BUCKETS, size // (6 * BUCKET_WORDS)).bit_length() - 1
    asks = flagged.mapInArrow(_asks(bits), ASKED_DDL).repartition("bucket").sortWithinPartitions("bucket", "block")
    answers = written(asks.mapInArrow(_answers, ANSWERED_DDL), "language-answers")
    words, whole, chosen = answers.agg(F.sum("size"), F.sum("whole"), F.sum("target")).first()
    rows = answers.select(*ASKED.names).repartition("block").sortWithinPartitions("block", "bucket")
    scored = rows.mapInArrow(_scores(words or 0, (chosen or 0, whole or 0)), SCORED_DDL)
    return scored.withColumn("score", F.col("target_loss") - F.col("background_loss"))

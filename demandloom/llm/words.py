"""Words, shingles and 64-bit hashes of whole texts, as numpy arrays inside Spark tasks.

A word here is a maximal run of bytes outside ASCII white space (space, tab to carriage return), with A-Z lower-cased.
``bytes.lower`` and ``bytes.split`` do exactly that on UTF-8, and leave every other character alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
MIX = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB))


def split_words(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """The splitmix finalizer: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (values ^ (values >> U64(30))) * MIX[2]
        x = (x ^ (x >> U64(27))) * MIX[3]
    return x ^ (x >> U64(31))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash per place of ``size`` words in a row; empty when the text is shorter."""
    count = len(hashes) - size + 1
    if count < 1:
        return np.empty(0, U64)
    total = np.zeros(count, U64)
    with np.errstate(over="ignore"):
        for k in range(size):
            total = mixed(total * MIX[0] + hashes[k : k + count] + MIX[1])
    return total


def fingerprint(values: np.ndarray) -> int:
    """A signed 64-bit name of a whole array."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(values.tobytes())).astype(np.int64))


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def column_bytes(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A text column as UTF-8 bytes, without decoding it."""
    column = batch.column(batch.schema.get_field_index(name))
    wide = pa.types.is_large_string(column.type)
    return column.cast(pa.large_binary() if wide else pa.binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Small batches, so that what a task holds at once is bounded by ``rows`` texts."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def long_lists(arrays: list[np.ndarray]) -> pa.Array:
    """Numpy arrays as one Arrow column of type array<bigint>."""
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int64, copy=False)))

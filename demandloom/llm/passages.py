"""Substring dedup over compact windows.

The tokens of a text are its word shingles. For a hash function the Cartesian tree over hashes has, per place, the widest
window in which that place has the smallest hash; windows of at least some number of places are kept. All runs of that
length inside a window that contain the place share its min-hash, so texts that share such a run have a window with one key.

Any passage holds ``Lengths.run`` equal words in a row at least, so its holders share the key of a short window; nothing is
asked elsewhere. Documents meet in buckets, each with the bucket's first one (the smallest), so what very many documents hold
costs a row per document:

- whole passages, at every place where one may begin: all words of an exact repeat are found, whatever other holders share;
- short windows by their keys and by runs of equal words of several lengths around them;
- windows of the shortest passage, for each of several hash functions, by key, and by key and min-hash of either side.

Rows of buckets go through the JVM as bytes, many values a row, and are sorted in numpy. Exact repeats are rows as they are;
around them, and wherever else documents met, stretches of words are compared once. Where exact repeats cover all that would
be looked at, nothing is.

Each match, be it of one function, is verified on the words themselves: runs of equal shingles on the matched and the
neighbouring diagonals are joined, so words may be changed, put in or left out, and the Jaccard similarity of the shingles
of the two stretches is 0.8 or more.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.llm import words as W
from demandloom.llm.holders import HOLDER, with_holders
from demandloom.llm.storage import discard, in_membership, membership, written

SIDE = 23  # tokens whose min-hash tells contexts apart: half a shortest window
PLACE_BITS = 28  # places of a text; longer texts fail rather than lose windows
MARGIN = 64  # tokens around the outermost matched places: an anchor lies in each run of min_tokens
WORDS = 1 << 19  # whose windows are taken at once, but for longer texts
ROWS = 1 << 19  # packed at once
PARTS = 1 << 12  # into which packed rows are dealt
CELLS = 1 << 20  # places on diagonals compared at once
NEIGHBOURS = 32  # runs to either side with which a run left out may be similar enough
KEY = 8  # words of a window's key
BAND = 8  # words put in or left out between two runs of one passage, and around the shifts at which windows meet
SEEDS = tuple(int(W.mixed(np.array([k + 1], np.uint64))[0]) for k in range(32))


def _row_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Per row, the smallest of each ``width`` values side by side, by doubling."""
    span, reach = values, 1
    while reach * 2 <= width:
        span, reach = np.minimum(span[:, :-reach], span[:, reach:]), reach * 2
    rest = width - reach
    return np.minimum(span[:, : span.shape[1] - rest], span[:, rest:]) if rest else span


def _centres(hashes: np.ndarray, least: int, whole: np.ndarray | slice) -> list[np.ndarray]:
    """``window_centres`` over the runs of ``least`` places that begin at the chosen places."""
    places = np.arange(hashes.shape[1], dtype=np.uint64)
    low = np.uint64((1 << PLACE_BITS) - 1)
    found = (_row_minima((hashes & ~low) | places, least) & low)[:, whole].astype(np.int64)
    new = np.diff(found, axis=1, prepend=-1) != 0  # the smallest place moves to the right only
    return [row[flags] for row, flags in zip(found, new)]


def window_centres(hashes: np.ndarray, least: int) -> list[np.ndarray]:
    """Per row of hashes, the nodes of its Cartesian tree whose range holds ``least`` places or more.

    A place is such a node if it has the smallest hash of some ``least`` places side by side, so no tree is built. Of equal
    hashes the leftmost counts, wherever in a text the places stand.
    """
    return _centres(hashes, least, slice(None))


def _combined(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return W.mixed(one * W.MIX[0] + two + W.MIX[1])


class Grams:
    """Hashes of word runs of any length at the places of texts that lie one after the other in one array.

    Runs of two, four and so on words are hashed from halves; others are two of those that overlap. ``left`` are the words
    from a place to the end of its text: a run that is longer than that is none.
    """

    def __init__(self, words: np.ndarray, sizes: np.ndarray, most: int):
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        self.owner = np.repeat(np.arange(len(sizes)), sizes)
        self.left = self.starts[1:][self.owner] - np.arange(len(words))
        self.levels = [W.mixed(words.astype(np.uint64) + W.MIX[1])]
        while 2 << (len(self.levels) - 1) <= most:
            half, last = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.zeros_like(last))
            self.levels[-1][:-half] = _combined(last[:-half], last[half:])

    def all(self, length: int) -> np.ndarray:
        """At every place; meaningless where ``left`` is less than ``length``."""
        level = length.bit_length() - 1
        out, rest = self.levels[level], length - (1 << level)
        if rest:
            out = np.concatenate((_combined(out[:-rest], out[rest:]), np.zeros(min(rest, len(out)), np.uint64)))
        return out

    def at(self, places: np.ndarray, length: int) -> np.ndarray:
        """At some places, where whole runs stand."""
        level = length.bit_length() - 1
        out, rest = self.levels[level], length - (1 << level)
        return _combined(out[places], out[places + rest]) if rest else out[places]


class Lengths(NamedTuple):
    """``run``: words of the longest equal run that any passage has at least; ``key``: of a window's key."""

    size: int
    words: int
    run: int
    key: int

    @classmethod
    def of(cls, size: int, words: int) -> Lengths:
        # A word changed takes ``size`` shingles from either text, so the most even passage of the fewest words leaves this.
        run = max(size, (words - size + 1 - size) // 2 + size - 1)
        return cls(size, words, run, min(KEY, run))


def compact_windows(grams: Grams, of: Lengths) -> tuple[np.ndarray, np.ndarray]:
    """Per place at which ``of.run`` words stand, the place of their smallest key (the leftmost of equal ones), and those places.

    The second are the nodes of the Cartesian trees over the texts' keys whose range holds ``of.run - of.key + 1`` places
    (see ``window_centres``), so two texts that share ``of.run`` words share a key.
    """
    whole = np.flatnonzero(grams.left >= of.run)
    if not len(whole):
        return whole, whole
    low = np.uint64((1 << PLACE_BITS) - 1)
    keys = (grams.all(of.key) & ~low) | np.arange(len(grams.left), dtype=np.uint64)
    smallest = (_row_minima(keys[None, :], of.run - of.key + 1)[0][whole] & low).astype(np.int64)
    return smallest, smallest[np.diff(smallest, prepend=-1) != 0]


def _by_words(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of ``WORDS`` words together; a longer one stands alone."""
    start, held = 0, 0
    for at, size in enumerate(sizes.tolist()):
        if at > start and held + size > WORDS:
            yield start, at
            start, held = at, 0
        held += size
    if len(sizes):
        yield start, len(sizes)


def _windowed(of: Lengths):

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches):
            hashes = [W.word_hashes(W.split_words(text)) for text in W.column_bytes(batch, "text")]
            sizes = np.fromiter(map(len, hashes), np.int64, len(hashes))
            if len(sizes) and sizes.max() >> PLACE_BITS:
                raise ValueError(f"a text has more than 2**{PLACE_BITS} words")
            chosen = np.flatnonzero(sizes >= of.words)  # shorter texts neither hold nor repeat a passage
            ids = batch.column(0).take(pa.array(chosen))
            for start, end in _by_words(sizes[chosen]):
                some = chosen[start:end]
                words = (np.concatenate([hashes[k] for k in some]) >> np.uint64(33)).astype(np.int32)
                grams = Grams(words, sizes[some], of.key)
                centres = compact_windows(grams, of)[1]
                counts = np.bincount(grams.owner[centres], minlength=len(some))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, end - start), _binary(words, sizes[some]), _binary(grams.at(centres, of.key), counts)],
                    names=["doc_id", "words", "keys"])

    return run


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Values one after the other, as bytes: the next ``counts`` of them in each row. The JVM moves them as they are."""
    ends = (np.concatenate(([0], np.cumsum(counts))) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def _values(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows of a ``_binary`` column, and how many each row has."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.empty(0, kind), np.empty(0, np.int64)
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    size = np.dtype(kind).itemsize
    if ends[-1] == ends[0]:
        return np.empty(0, kind), np.zeros(len(column), np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].copy().view(kind), np.diff(ends) // size


def _packed(parts: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Rows as one row per part, whose columns hold the part's values; the order within a part stays."""
    order = np.argsort(parts, kind="stable")
    counts = np.bincount(parts, minlength=PARTS)
    there = np.flatnonzero(counts)
    arrays = [_binary(values[order], counts[there]) for values in columns.values()]
    return pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), *arrays], names=["part", *columns])


def _unpacked(batches: Iterator[pa.RecordBatch], columns: dict[str, type]) -> list[np.ndarray]:
    """All values of each column of ``_packed`` rows."""
    out: list[list[np.ndarray]] = [[np.empty(0, kind)] for kind in columns.values()]
    for batch in batches:
        for values, (name, kind) in zip(out, columns.items()):
            values.append(_values(batch.column(batch.schema.get_field_index(name)), kind)[0])
    return [np.concatenate(values) for values in out]


def _parts(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - PARTS.bit_length() + 1)).astype(np.uint16)


KEYED = {"key": np.uint64, "doc": np.int64}


def _dealt_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The window keys of documents, packed by hash; a document names each once."""
    held, count = [], 0

    def flushed() -> pa.RecordBatch:
        keys, docs = (np.concatenate(c) for c in zip(*held))
        return _packed(_parts(W.mixed(keys)), {"key": keys, "doc": docs})

    for batch in W.slices(batches):
        keys, counts = _values(batch.column(1), np.uint64)
        held.append((keys, np.repeat(batch.column(0).to_numpy(zero_copy_only=False), counts)))
        count += len(keys)
        if count >= ROWS:
            yield flushed()
            held, count = [], 0
    if count:
        yield flushed()


def _grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal values stand together, and where each value begins there."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    return order, np.flatnonzero(np.concatenate((np.ones(min(len(values), 1), bool), ordered[1:] != ordered[:-1])))


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys that several documents have."""
    keys, docs = _unpacked(batches, KEYED)
    order, begins = _grouped(keys)
    if len(begins):
        docs = docs[order]
        several = np.minimum.reduceat(docs, begins) < np.maximum.reduceat(docs, begins)
        yield pa.RecordBatch.from_arrays([pa.array(W.signed(keys[order][begins[several]]))], names=["key"])


def _thinned(buckets: np.ndarray, places: np.ndarray, grams: Grams, block: int) -> np.ndarray:
    """Rows without those that stand between others of their bucket in one block of their text.

    Texts that repeat words without end have one bucket at each of their places; runs of ``block`` words from the first and
    the last such place of a block hold all words that those from the places between them hold.
    """
    with np.errstate(over="ignore"):
        order, begins = _grouped(W.mixed(buckets + W.mixed(grams.owner[places].astype(np.uint64))))
    first = np.zeros(len(order), bool)
    first[begins] = True
    blocks = (places - grams.starts[grams.owner[places]])[order] // block
    first[1:] |= blocks[1:] != blocks[:-1]
    return order[first | np.append(first[1:], True)]


KINDS = ("short", "passages", "windows")


def _buckets(grams: Grams, shared, of: Lengths, functions: int, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of one kind (see ``KINDS``) of the places of texts, and the places; odd numbers are whole passages.

    Short windows with shared keys meet by their keys, and by the runs of equal words, of several lengths, to either side
    of the key: a first document that shares less hides none that shares more. Wherever all short windows have shared keys,
    whole passages meet. Around shared keys, the windows of the shortest passage meet by their smallest token, for each hash
    function, alone and with the smallest of ``SIDE`` tokens from there to either side by another one.
    """
    smallest, centres = compact_windows(grams, of)
    chosen = centres[shared(grams.at(centres, of.key))]
    even, buckets, at = ~np.uint64(1), [], []

    def add(context: np.ndarray, places: np.ndarray, number: int) -> None:
        buckets.append(_combined(context, np.full(len(places), number, np.uint64)) & even)
        at.append(places)

    if kind == "short":
        own, begin, left = grams.at(chosen, of.key), grams.starts[grams.owner[chosen]], grams.left[chosen]
        add(own, chosen, 0)
        for length in sorted({max(of.key + 1, of.run * k // 5) for k in (2, 3, 4, 5)} | {4 * of.words // 5}):
            for side, (first, where) in enumerate(((chosen, left >= length), (chosen + of.key - length, chosen + of.key - length >= begin))):
                where = np.flatnonzero(where)
                add(_combined(own[where], grams.at(first[where], length)), chosen[where], 2 * length + side)
    elif kind == "passages":
        flags = np.zeros(len(grams.left), bool)
        flags[chosen] = True
        meets = np.zeros(len(grams.left) + 1, np.int64)
        meets[1 + np.flatnonzero(grams.left >= of.run)] = flags[smallest]
        meets = np.cumsum(meets)
        windows = of.words - of.run + 1
        places = np.flatnonzero(meets[windows:] - meets[:-windows] == windows) if len(meets) > windows else np.empty(0, np.int64)
        places = places[grams.left[places] >= of.words]
        buckets, at = [grams.at(places, of.words) | np.uint64(1)], [places]
    else:
        near = np.zeros(len(grams.left) + 1, np.int64)  # places whose window may lie in a passage with a shared key
        np.add.at(near, np.maximum(chosen - of.words, 0), 1)
        np.add.at(near, np.minimum(chosen + of.words, len(grams.left)), -1)
        near = np.cumsum(near)[:-1] > 0
        tokens, behind = grams.all(of.size), grams.left < of.size
        whole, least = np.flatnonzero(grams.left >= of.words), of.words - of.size + 1
        for function in range(functions if len(whole) else 0):
            mixed = W.mixed(tokens ^ np.uint64(SEEDS[function]))
            # Sides by function: one unlucky side is not that of all. Places behind the end do not count.
            side = W.mixed(tokens ^ np.uint64(SEEDS[-1 - function]))
            side[behind] = np.uint64(2**64 - 1)
            side = _row_minima(np.append(side, np.full(SIDE - 1, 2**64 - 1, np.uint64))[None, :], SIDE)[0]
            middle = _centres(mixed[None, :], least, whole)[0]
            middle = middle[near[middle]]
            back = np.maximum(middle - SIDE + 1, grams.starts[grams.owner[middle]])
            for number, context in enumerate((mixed[middle], _combined(mixed[middle], side[middle]), _combined(mixed[middle], side[back]))):
                add(context, middle, 1000 + 3 * function + number)
    buckets, at = np.concatenate([np.empty(0, np.uint64), *buckets]), np.concatenate([np.empty(0, np.int64), *at])
    kept = _thinned(buckets, at, grams, of.words)
    return buckets[kept], at[kept]


MEMBERS = {"bucket": np.uint64, "doc": np.int64, "place": np.int32}


def _dealt_members(of: Lengths, functions: int, kind: str, maps, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shared(keys: np.ndarray) -> np.ndarray:
            return in_membership(keys, maps.value, bits)

        held: list[tuple] = []
        count = 0

        def flushed() -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*held)]
            return _packed(_parts(columns[0]), dict(zip(MEMBERS, columns)))

        for batch in W.slices(batches):
            keys, counts = _values(batch.column(2), np.uint64)
            batch = batch.filter(pa.array(np.bincount(np.repeat(np.arange(len(counts)), counts)[shared(keys)], minlength=len(counts)) > 0))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            sizes = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64) // 4
            for start, end in _by_words(sizes):
                words, _ = _values(batch.column(1).slice(start, end - start), np.int32)
                grams = Grams(words, sizes[start:end], of.words)
                buckets, at = _buckets(grams, shared, of, functions, kind)
                owners = grams.owner[at]
                marks = np.where(buckets & np.uint64(1), EXACT + ENDING * (grams.left[at] == of.words), 0)
                held.append((buckets, ids[start:end][owners], (at - grams.starts[owners] + marks).astype(np.int32)))
                count += len(at)
                if count >= ROWS:
                    yield flushed()
                    held, count = [], 0
        if count:
            yield flushed()

    return run


MET = {"doc": np.int64, "first_doc": np.int64, "place": np.int32, "first_place": np.int32}
EXACT, ENDING = 1 << PLACE_BITS, 1 << PLACE_BITS + 1  # marks on places of whole passages, and of such at a text's end
BEYOND = (1 << PLACE_BITS + 1) - 1  # behind each text's end


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of a bucket with its first document, at its first place there; packed by document. Exact ones bear a mark in ``place``."""
    buckets, docs, places = _unpacked(batches, MEMBERS)
    order, begins = _grouped(buckets)
    if not len(begins):
        return
    docs, places = docs[order], places[order]
    counts = np.diff(np.append(begins, len(docs)))
    heads = np.repeat(np.minimum.reduceat(docs, begins), counts)
    first = np.repeat(np.minimum.reduceat(np.where(docs == heads, places & (EXACT - 1), EXACT), begins).astype(np.int32), counts)
    asking = np.flatnonzero(docs > heads)
    for start in range(0, len(asking), ROWS):
        some = asking[start : start + ROWS]
        yield _packed(_parts(W.mixed(docs[some].view(np.uint64))), dict(zip(MET, (docs[some], heads[some], places[some], first[some]))))


PAIRED = ("doc_id", "first_doc_id", "exact", "start", "length", "first_start", "first_length", "shift", "last_shift")


def _paired(of: Lengths):
    """What documents share with first holders: exact passages, and requests to compare what lies around the places met.

    Places on one diagonal, less place and first place, are a span; spans of neighbouring diagonals that lie near each other
    are one request: words may be put in or left out between them. Sorted by diagonal, places rise where words were put in
    and fall where they were left out.
    """
    names = PAIRED
    schema = pa.schema([(name, pa.int64()) for name in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, heads, places, firsts = _unpacked(batches, MET)
        if not len(docs):
            return
        exact, ending, places = places & EXACT != 0, places & ENDING != 0, (places & (EXACT - 1)).astype(np.int64)
        shifts = places - firsts
        order = np.lexsort((places, shifts, heads, docs))
        docs, heads, places, shifts, exact, ending = (c[order] for c in (docs, heads, places, shifts, exact, ending))

        def changes(*columns: np.ndarray) -> np.ndarray:
            out = np.zeros(len(columns[0]), bool)
            out[0] = True
            for column in columns:
                out[1:] |= column[1:] != column[:-1]
            return out

        text = np.cumsum(changes(docs)) << PLACE_BITS + 1  # places of all texts on one line, each with room behind its end
        covers = covered = np.empty(0, np.int64)
        # Exact passages on one diagonal that overlap or touch are one.
        whole = np.flatnonzero(exact)
        if len(whole):
            new = changes(docs[whole], heads[whole], shifts[whole])
            new[1:] |= places[whole][1:] - places[whole][:-1] > of.words
            begins = np.flatnonzero(new)
            start, last = whole[begins], whole[np.append(begins[1:], len(whole)) - 1]
            length, one = places[last] - places[start] + of.words, np.ones(len(start), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (
                docs[start], heads[start], one, places[start], length, places[start] - shifts[start], length, shifts[start], shifts[start])], schema=schema)
            reach = text[start] + np.where(ending[last], BEYOND, places[start] + length)
            by = np.argsort(text[start] + places[start], kind="stable")
            covers, covered = (text[start] + places[start])[by], np.maximum.accumulate(reach[by])
            gaps = np.flatnonzero(np.append(True, covers[1:] > covered[:-1]))
            covers, covered = covers[gaps], covered[np.append(gaps[1:], len(covered)) - 1]

        begins = np.flatnonzero(changes(docs, heads, shifts))
        low, shift = places[begins], shifts[begins]
        high = np.maximum.reduceat(places + np.where(exact, of.words - of.size, 0), begins)
        apart = changes(docs[begins], heads[begins])
        apart[1:] |= (shift[1:] - shift[:-1] > BAND) | (low[1:] - high[:-1] > 2 * MARGIN) | (low[:-1] - high[1:] > 2 * MARGIN)
        islands = np.flatnonzero(apart)

        def around(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:  # multiples of 64 let requests coincide
            start = np.maximum(0, (low - MARGIN) // MARGIN * MARGIN)
            return start, -((-high - MARGIN - of.size) // MARGIN) * MARGIN - start

        least, most = np.minimum.reduceat, np.maximum.reduceat
        columns = (
            docs[begins[islands]], heads[begins[islands]], np.zeros(len(islands), np.int64),
            *around(least(low, islands), most(high, islands)), *around(least(low - shift, islands), most(high - shift, islands)),
            least(shift, islands), most(shift, islands))
        # Where all words looked at lie in exact passages, there is nothing to add.
        start = text[begins[islands]] + columns[3]
        within = np.searchsorted(covers, start, "right") - 1
        asked = np.ones(len(islands), bool)
        some = np.flatnonzero(within >= 0)
        asked[some] = np.minimum(start + columns[4], text[begins[islands]] + BEYOND)[some] > covered[within[some]]
        yield pa.RecordBatch.from_arrays([pa.array(c[asked]) for c in columns], schema=schema)

    return run


def _diagonals(one: np.ndarray, two: np.ndarray, low: int, high: int) -> list[tuple[int, int, int]]:
    """``(start in one, start in two, length)`` of the runs of equal tokens whose shift, place less place, is in the range."""
    low, high = max(low, 1 - len(two)), min(high, len(one) - 1)
    if low > high or not len(one):
        return []
    # Row k of the view stands for shift high - k: its place i is place i - shift of two, or a value that one does not hold.
    before, width = max(high, 0), len(one)
    other = one.max() + one.dtype.type(1) if one.max() < np.iinfo(one.dtype).max else np.setdiff1d(np.arange(width + 1, dtype=one.dtype), one)[0]
    padded = np.full(before + len(two) + max(width - low - len(two), 0), other, one.dtype)
    padded[before : before + len(two)] = two
    view = np.lib.stride_tricks.as_strided(padded[before - high :], (high - low + 1, width), padded.strides * 2, writeable=False)[::-1]
    runs: list[tuple[int, int, int]] = []
    step = max(1, CELLS // width)
    for at in range(0, len(view), step):
        rows = view[at : at + step]
        equal = np.zeros((len(rows), width + 2), bool)
        np.equal(rows, one, out=equal[:, 1:-1])
        edges = np.flatnonzero(equal[:, 1:] != equal[:, :-1])
        starts, ends = edges[::2], edges[1::2]
        shifts, places = np.divmod(starts, width + 1)
        runs += zip(places.tolist(), (places - shifts - (low + at)).tolist(), (ends - starts).tolist())
    return runs


def _in_order(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs that advance in both texts, longest first; others keep what does not overlap them."""
    taken: list[tuple[int, int, int]] = []
    for x, y, n in sorted(runs, key=lambda run: (-run[2], run[0], run[1])):
        at = bisect_left(taken, (x, y, n))
        if at:
            before = taken[at - 1]
            cut = max(0, before[0] + before[2] - x, before[1] + before[2] - y)
            x, y, n = x + cut, y + cut, n - cut
        if at < len(taken):
            n = min(n, taken[at][0] - x, taken[at][1] - y)
        if n > 0:
            taken.insert(at, (x, y, n))
    return taken


def alike(
    one: np.ndarray, two: np.ndarray, size: int, min_tokens: int, shifts: tuple[int, int] = (-BAND, BAND)
) -> list[tuple[int, int, int, int, int, int]]:
    """``(start, end, start and end in two, shared, all)`` of stretches whose shingle sets are 0.8 or more similar.

    ``one`` and ``two`` are word hashes, places count shingles. Runs of equal shingles on all diagonals of the range are
    put in order; neighbours join while the shared shingles would be 0.8 of all if none repeated. The measure itself is
    then taken on the sets of distinct shingles; a joined stretch below it is undone step by step.
    """
    return _alike(W.shingle_hashes(one.view(np.uint64), size), W.shingle_hashes(two.view(np.uint64), size), min_tokens, shifts)


def _alike(first: np.ndarray, second: np.ndarray, min_tokens: int, shifts: tuple[int, int]) -> list[tuple[int, int, int, int, int, int]]:
    if min(len(first), len(second)) < min_tokens:
        return []
    there = np.sort(second)
    at = np.minimum(np.searchsorted(there, first), len(there) - 1)
    if 9 * np.count_nonzero(there[at] == first) < 8 * min_tokens:  # runs of fewer shingles join to no passage
        return []
    found: list[tuple] = []
    runs = _in_order(_diagonals(first, second, *shifts))
    for x, y, n in runs:
        run = (x, x + n, y, y + n, n, ())
        while found and 9 * (found[-1][4] + run[4]) >= 4 * (run[1] - found[-1][0] + run[3] - found[-1][2]):
            before = found.pop()
            run = (before[0], run[1], before[2], run[3], before[4] + run[4], (before, run))
        found.append(run)
    passages = []
    while found:
        start, end, other, last, _, parts = found.pop()
        if min(end - start, last - other) < min_tokens:
            continue
        shared, union = _measure(first[start:end], second[other:last])
        if 5 * shared >= 4 * union:
            passages.append((start, end, other, last, shared, union))
        else:
            found.extend(parts)
    return sorted(passages + _around_left(runs, passages, first, second, min_tokens) if len(runs) > 1 else passages)


def _measure(one: np.ndarray, two: np.ndarray) -> tuple[int, int]:
    """How many distinct shingles two stretches share, and how many there are in either."""
    here, there = np.unique(one), np.unique(two)
    shared = len(np.intersect1d(here, there, assume_unique=True))
    return shared, len(here) + len(there) - shared


def _around_left(
    runs: list[tuple[int, int, int]], passages: list[tuple[int, ...]], first: np.ndarray, second: np.ndarray, min_tokens: int
) -> list[tuple[int, int, int, int, int, int]]:
    """Stretches around the runs that joining from left to right has left out: the shortest with neighbours that is similar enough.

    The neighbours may lie in a passage already, which the run would have made too unlike as a whole.
    """
    x, y, n = np.array(runs).T
    total = np.cumsum(n)
    # Runs a to b would be similar enough if no shingle repeated where closes[b] >= opens[a].
    closes, opens = 9 * total - 4 * (x + y + 2 * n), 9 * (total - n) - 4 * (x + y)
    out: list[tuple[int, int, int, int, int, int]] = []
    for k, (start, _, size) in enumerate(runs):
        if any(begin <= start and start + size <= end for begin, end, *_ in passages + out):
            continue
        a, b = np.arange(max(0, k - NEIGHBOURS), k + 1)[:, None], np.arange(k, min(len(runs), k + NEIGHBOURS + 1))[None, :]
        fits = (closes[b] >= opens[a]) & (np.minimum(x[b] + n[b] - x[a], y[b] + n[b] - y[a]) >= min_tokens)
        for i, j in sorted(np.argwhere(fits).tolist(), key=lambda at: at[1] - at[0]):
            begin, end, other, last = (int(v) for v in (x[a[i, 0]], (x + n)[b[0, j]], y[a[i, 0]], (y + n)[b[0, j]]))
            shared, union = _measure(first[begin:end], second[other:last])
            if 5 * shared >= 4 * union:
                out.append((begin, end, other, last, shared, union))
                break
    return out


def _shingle_lists(column: pa.Array, size: int) -> list[np.ndarray]:
    """The shingle hashes of a ``_binary`` column of word hashes, hashed in one go."""
    flat, counts = _values(column, np.int32)
    hashes = W.shingle_hashes(flat.astype(np.int64).view(np.uint64), size)
    ends = np.cumsum(counts).tolist()
    return [hashes[start : max(start, end - size + 1)] for start, end in zip([0, *ends], ends)]


FOUND = ("doc_id", "start_word", "end_word", "first_doc_id", "first_start", "shared", "union")


def _verified(size: int, min_tokens: int):
    names = FOUND
    schema = pa.schema([(name, pa.int64()) for name in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches):
            rows = []
            given = [batch.column(i).to_pylist() for i in range(6)] + [_shingle_lists(batch.column(i), size) for i in (6, 7)]
            for doc, first, start, other, low, high, one, two in zip(*given):
                shifts = low - start + other, high - start + other
                for begin, end, there, _, shared, union in _alike(one, two, min_tokens, (shifts[0] - BAND, shifts[1] + BAND)):
                    rows.append((doc, start + begin, start + end + size - 1, first, other + there, shared, union))
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], schema=schema)

    return run


def _compared(words: DataFrame, requests: DataFrame, size: int, min_tokens: int) -> DataFrame:
    """Verified stretches of ``requests`` (see ``_paired``): what a document shares with an earlier one there."""

    def cut(start: str, length: str) -> Column:
        return F.substring("words", (F.col(start) * 4 + 1).cast("int"), (F.col(length) * 4).cast("int"))

    one = requests.join(words.select("doc_id", "words"), "doc_id").withColumn("one", cut("start", "length")).drop("words", "length")
    both = one.join(words.select(F.col("doc_id").alias("first_doc_id"), "words"), "first_doc_id").withColumn("two", cut("first_start", "first_length"))
    return both.select("doc_id", "first_doc_id", "start", "first_start", "shift", "last_shift", "one", "two").mapInArrow(
        _verified(size, min_tokens), ", ".join(f"{name} bigint" for name in FOUND))


def _columns(columns: dict[str, type]) -> str:
    return ", ".join(["part int", *[f"{name} binary" for name in columns]])


def _between_holders(texts: DataFrame, size: int, min_words: int, functions: int) -> DataFrame:
    """Passages among ``doc_id, text`` rows in which one ``doc_id`` has one text."""
    of = Lengths.of(size, min_words)
    words = written(texts.mapInArrow(_windowed(of), "doc_id bigint, words binary, keys binary"), "passage-words")
    if not words.groupBy("doc_id").count().where("count > 1").isEmpty():  # rows repeated with id and text
        words, repeated = written(words.dropDuplicates(["doc_id"]), "passage-words"), words
        discard(repeated)
    shared = written(words.select("doc_id", "keys").mapInArrow(_dealt_keys, _columns(KEYED)).repartition("part").mapInArrow(
        _shared_keys, "key bigint"), "passage-keys")
    bits = min(28, max(24, shared.count().bit_length() + 3))
    maps = texts.sparkSession.sparkContext.broadcast(membership(shared, "key", bits))
    discard(shared)
    # One kind after the other, so that the shuffle files of one at a time lie on disk.
    met = [written(words.mapInArrow(_dealt_members(of, functions, kind, maps, bits), _columns(MEMBERS)).repartition("part").mapInArrow(
        _met, _columns(MET)), "passage-met") for kind in KINDS]
    pairs = written(reduce(DataFrame.union, met).repartition("part").mapInArrow(
        _paired(of), ", ".join(f"{name} bigint" for name in PAIRED)), "passage-pairs")
    discard(*met)
    exact = pairs.where("exact = 1").select(
        "doc_id", F.col("start").alias("start_word"), (F.col("start") + F.col("length")).alias("end_word"), "first_doc_id", "first_start",
        F.lit(1).cast("bigint").alias("shared"), F.lit(1).cast("bigint").alias("union"))
    found = written(_compared(words, pairs.where("exact = 0").drop("exact"), size, min_words - size + 1), "passage-found")
    discard(words)
    return exact.union(found).distinct()


def repeated_passages(docs: DataFrame, size: int = 5, min_words: int = 50, functions: int = 6) -> DataFrame:
    """``doc_id, start_word, end_word, first_doc_id, first_start, similarity``: passages that an earlier document holds.

    A row says that the words ``start_word`` to before ``end_word`` of a document repeat those from ``first_start`` in the
    document with the smaller id; the first holder of a passage has no row for it. Stretches have at least ``min_words``
    words, the Jaccard similarity of their shingles of ``size`` words is 0.8 or more. Null and shorter texts hold no
    passage; rows without ``doc_id`` take no part. Different texts of one ``doc_id`` are documents of their own (the one
    with the smallest hash stands first); repeated rows count once; other columns are ignored. An empty table gives none.
    """
    named, several = with_holders(docs.select("doc_id", "text"))
    found = _passages(named, size, min_words, functions)
    if several:
        names = named.select(HOLDER, F.col("doc_id").cast("bigint").alias("id")).where(F.col(HOLDER) != F.col("id")).distinct()
        for column in ("doc_id", "first_doc_id"):
            found = found.join(names.withColumnRenamed(HOLDER, column), column, "left").withColumn(column, F.coalesce("id", column)).drop("id")
    return found.select("doc_id", "start_word", "end_word", "first_doc_id", "first_start", "similarity")


def _passages(named: DataFrame, size: int, min_words: int, functions: int) -> DataFrame:
    """The columns of ``repeated_passages`` by holder."""
    texts = named.select(F.col(HOLDER).alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")
    found = _between_holders(texts, size, min_words, functions)
    # Requests on one diagonal may show the same stretch in pieces; the widest one is kept.
    overlap = Window.partitionBy("doc_id", "first_doc_id", F.col("start_word") - F.col("first_start")).orderBy(
        "start_word", F.desc("end_word"))
    covered = F.max("end_word").over(overlap.rowsBetween(Window.unboundedPreceding, -1))
    return found.withColumn("covered", covered).where("covered is null or end_word > covered").select(
        "doc_id", "start_word", "end_word", "first_doc_id", "first_start",
        (F.col("shared") / F.col("union")).alias("similarity"))


def _cut(spans_at: int, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, touched = list(batch.columns), batch.column(spans_at).is_valid()
            if touched.true_count:
                texts = []
                for text, spans in zip(columns[text_at].to_pylist(), columns[spans_at].to_pylist()):
                    texts.append(remove_words(text, [(s["start_word"], s["end_word"]) for s in spans]) if spans else text)
                columns[text_at] = pa.array(texts, columns[text_at].type)
            columns[spans_at] = touched
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:spans_at], "__cut"])

    return run


def remove_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and the white space after them."""
    data = text.encode()
    places, at = [], 0
    for word in data.split():
        at = data.index(word, at)
        places.append(at)
        at += len(word)
    kept, done = [], 0
    for start, end in sorted(spans):
        if start < done:
            start = done
        if start >= end:
            continue
        kept.append(data[(places[done] if done else 0) : places[start]])
        done = end
    if done < len(places):
        kept.append(data[(places[done] if done else 0) :])
    return b"".join(kept).decode()


def without_repeats(docs: DataFrame, size: int = 5, min_words: int = 50, functions: int = 6) -> DataFrame:
    """``docs`` with every repeated passage left in its first document only; texts left empty by that go, columns stay.

    ``n_chars``, where present, follows the text. Rows without ``doc_id`` or text stay as they are; each text of a repeated
    ``doc_id`` loses its own passages only.
    """
    named, _ = with_holders(docs)
    spans = written(_passages(named, size, min_words, functions).groupBy(F.col("doc_id").alias("__span_of")).agg(
        F.array_sort(F.collect_set(F.struct("start_word", "end_word"))).alias("__spans")), "passage-spans")
    joined = named.join(spans, F.col(HOLDER) == F.col("__span_of"), "left").select(*docs.columns, "__spans")
    cut = joined.mapInArrow(
        _cut(len(docs.columns), docs.columns.index("text")),
        T.StructType([*docs.schema.fields, T.StructField("__cut", T.BooleanType())])).where(~F.col("__cut") | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(F.col("__cut"), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)

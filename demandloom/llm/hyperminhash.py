"""Near-duplicates by HyperMinHash: banded registers, a collision-corrected estimate, and full sets to confirm.

A document is the set of its hashed word shingles. The high bits of a hash name one of 64 buckets; a bucket keeps its
smallest remaining value as a short float: the number of leading zeros and the ``MANTISSA`` bits after the first one. So a
register is 32 bits, and two registers of different minima are equal by chance in about 0.18 * 2**-MANTISSA of cases.

1. *Sketch.* One pass over the texts gives each document its registers and, for every three registers that are not all
   empty, a band: their 64-bit hash with the band's number. The mantissa is long because a band of a short document holds
   one register: with ten bits, short documents would meet by chance in a large corpus.
2. *Room.* Documents with a band that another set holds too bring their whole sets. Shingles held by one set only count
   against it: a set with too many of them links with nothing and is done, and two sets can only link if what is left of
   each is enough for both. In a large group of near copies this leaves the original and what lies close to it.
3. *Meet.* Each band's members meet its pivot, the set with the fewest shingles of its own (the common original of a group
   of near copies has none). Then members of one band that are in different components meet, found by joining the
   components within a band first, so that members of one never meet. Between sets from crowded bands, shingles that few
   of this crowd hold count against a set as well: two sets that are left with too little either share one of those, and
   meet by it (at most ``RARE`` sets hold it), or cannot be linked.
4. *Confirm.* Pairs whose registers or estimated Jaccard stand too far apart are refused, the others are intersected once.
   Links are pairs whose whole sets reach the threshold; components of the links are the classes.

What is refused cannot be a link, but for the estimate, which must fall short of the threshold by six standard deviations.
A pair at similarity 0.85 shares none of its 21 bands with probability 0.386**21, 2e-9. Sets so small that any difference
breaks the threshold are only compared by name. Exact copies are one set from the start, named by a 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm import words as W
from demandloom.llm.components import components
from demandloom.llm.ngram_join import set_name, shingle_set
from demandloom.llm.storage import discard, in_membership, membership, written

BUCKET_BITS = 6
BUCKETS = 1 << BUCKET_BITS
BAND = 3  # registers; the one left over serves the estimate only
VALUE_BITS = 64 - BUCKET_BITS
MANTISSA = 26
DEEPEST = 52  # leading zeros counted
DEVIATIONS = 6.0
CROWD = 32  # a band with more members is crowded
RARE = 64  # sets of the crowd that hold a rare shingle, at most


def registers_of(shingles: np.ndarray) -> np.ndarray:
    """64 registers of sorted distinct hashes: zero where a bucket is empty."""
    out = np.zeros(BUCKETS, np.uint32)
    if not len(shingles):
        return out
    buckets = shingles >> W.U64(VALUE_BITS)
    heads = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1])))  # sorted: a bucket's first is its least
    values = shingles[heads] & W.U64((1 << VALUE_BITS) - 1)
    zeros = DEEPEST - np.frexp((values >> W.U64(VALUE_BITS - DEEPEST)).astype(np.float64))[1]
    after = (values << (zeros + 1).astype(np.uint64)) & W.U64((1 << VALUE_BITS) - 1)
    mantissa = after >> W.U64(VALUE_BITS - MANTISSA)
    out[buckets[heads].astype(np.int64)] = ((zeros + 1).astype(np.uint64) << W.U64(MANTISSA) | mantissa).astype(np.uint32)
    return out


def bands_of(registers: np.ndarray) -> np.ndarray:
    """One hash per band that is not empty."""
    rows = registers[: BUCKETS // BAND * BAND].reshape(-1, BAND).astype(np.uint64)
    total = np.arange(1, len(rows) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for column in rows.T:
            total = W.mixed(total * W.MIX[0] + column + W.MIX[1])
    return total[rows.any(axis=1)]


def smallest_linked(percent: int) -> int:
    """The size of the smaller of two different sets that can reach the threshold: one shingle more, nothing else."""
    return math.ceil(percent / (100 - percent)) if percent < 100 else 1 << 62


def accidental(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The probability that registers of two different minima agree.

    The minima of a bucket are exponential with rates in proportion to the sets; a register's cell around ``x`` is
    ``x * 2**-MANTISSA`` wide, times ``1 / (2 ln 2)`` on average over an octave. Integrating gives the product below.
    """
    n, m = n.astype(np.float64), m.astype(np.float64)
    return n * m / (n + m) ** 2 / (2 * math.log(2)) * 2.0**-MANTISSA


def estimated_jaccard(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row of registers: the estimate without accidental matches, buckets used, and buckets that differ."""
    used = ((x | y) != 0).sum(axis=1)
    differing = (x != y).sum(axis=1)
    agreeing = (used - differing) / np.maximum(used, 1)
    chance = accidental(n, m)
    return np.clip((agreeing - chance) / (1 - chance), 0.0, 1.0), used, differing


def may_link(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sketches can still be links.

    Each differing bucket holds a shingle of only one set, and a link leaves room for few of those.
    """
    found, used, differing = estimated_jaccard(x, y, n, m)
    threshold = percent / 100
    slack = DEVIATIONS * np.sqrt(threshold * (1 - threshold) / np.maximum(used, 1))
    return (differing * (100 + percent) <= (n + m) * (100 - percent)) & (found >= threshold - slack)


def _sketches(size: int, percent: int):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("text_key", pa.int64()),
        ("bands", pa.list_(pa.int64())), ("registers", pa.binary()),
    ])
    least = smallest_linked(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # names in this task: a copy repeats only its row
        nothing = np.empty(0, np.int64)
        for batch in W.slices(batches):
            ids, nodes, counts, keys, bands, registers = batch.column(0).to_pylist(), [], [], [], [], []
            for doc_id, text in zip(ids, W.column_bytes(batch, "text")):
                shingles = shingle_set(text, size)
                node = set_name(shingles, doc_id)
                sketch = None if node in seen or len(shingles) < least else registers_of(shingles)
                seen.add(node)
                nodes.append(node), counts.append(len(shingles)), keys.append(_text_key(text))
                bands.append(nothing if sketch is None else W.signed(bands_of(sketch)))
                registers.append(None if sketch is None else sketch.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(nodes, pa.int64()), pa.array(counts, pa.int64()), pa.array(keys, pa.int64()),
                 W.long_lists(bands), pa.array(registers, pa.binary())], schema=schema)

    return run


def _text_key(text: bytes | None) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(text or b"")).astype(np.int64))


def _whole_sets(size: int, maps):
    """Sets of the texts whose key may be wanted; hashing a text is far cheaper than cutting it."""
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in W.slices(batches):
            nodes, sets = [], []
            texts = W.column_bytes(batch, "text")
            keys = np.array([_text_key(text) for text in texts], np.int64)
            for place in np.flatnonzero(in_membership(keys, maps.value)):
                if keys[place] in seen:
                    continue
                seen.add(keys[place])
                shingles = shingle_set(texts[place], size)
                if len(shingles):
                    nodes.append(set_name(shingles, None)), sets.append(W.signed(shingles))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), W.long_lists(sets)], schema=schema)

    return run


def _likely(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64())])

    def matrix(column: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, BUCKETS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, 4096):
            n, m = (np.array(batch.column(i), np.int64) for i in (2, 3))
            keep = pa.array(may_link(matrix(batch.column(4)), matrix(batch.column(5)), n, m, percent))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in range(4)], schema=schema)

    return run


def _met(joined: DataFrame, fits: Column) -> DataFrame:
    """Distinct pairs ``a < b`` of postings ``x`` and ``y`` whose room allows a link."""
    ordered = F.col("x.node") < F.col("y.node")
    return joined.where(fits & (F.col("x.node") != F.col("y.node"))).select(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"),
        F.when(ordered, F.col("x.n")).otherwise(F.col("y.n")).alias("n_a"),
        F.when(ordered, F.col("y.n")).otherwise(F.col("x.n")).alias("n_b")).distinct()


def _sifted(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs whose registers let them be links."""
    left = sketches.select(F.col("node").alias("a"), F.col("registers").alias("x"))
    right = sketches.select(F.col("node").alias("b"), F.col("registers").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "x", "y")
    return both.mapInArrow(_likely(percent), "a bigint, b bigint, n_a bigint, n_b bigint")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b")).cast("bigint")
    scored = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", both.alias("both"))
    enough = F.col("both") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("both")) * percent
    return scored.where(enough).select("a", "b")


def _room(sets: DataFrame, percent: int) -> DataFrame:
    """``node, n, alone, room`` of the sets that can link: two do only if ``room >= percent * n`` of the other, both ways.

    What two sets share is held twice, so it is at most ``n - alone`` of either.
    """
    rows = sets.select("node", F.explode("shingles").alias("h"))
    single = rows.groupBy("h").agg(F.min("node").alias("node"), F.max("node").alias("high")).where("node = high")
    alone = single.groupBy("node").agg(F.count("*").alias("alone"))
    sized = sets.select("node", F.size("shingles").cast("bigint").alias("n")).join(alone, "node", "left")
    sized = sized.select("node", "n", F.coalesce("alone", F.lit(0)).alias("alone"))
    room = _room_without("alone", percent)
    return sized.withColumn("room", room).where((F.col("n") - F.col("alone")) * 100 >= F.col("n") * percent)


def _room_without(column: str, percent: int) -> Column:
    return (F.col("n") - F.col(column)) * (100 + percent) - F.col("n") * percent


def _rare(sets: DataFrame, crowd: DataFrame) -> DataFrame:
    """``h, node, df`` of the shingles that at most ``RARE`` sets of the crowd hold."""
    rows = sets.join(crowd, "node", "left_semi").select("node", F.explode("shingles").alias("h"))
    few = rows.groupBy("h").agg(F.count("*").alias("df")).where(F.col("df") <= RARE)
    return rows.join(few, "h")


def _fits(x: str, y: str, room: str, n: str, percent: int) -> Column:
    return (F.col(f"{x}.{room}") >= F.col(f"{y}.{n}") * percent) & (F.col(f"{y}.{room}") >= F.col(f"{x}.{n}") * percent)


def _held_twice(held: DataFrame) -> DataFrame:
    """The rows of bands that two different sets hold."""
    shared = held.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    return held.join(shared.select("band"), "band")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs`` (columns ``doc_id``, ``text``; others are ignored).

    ``component_id`` is the smallest ``doc_id`` reachable over links of at least ``percent`` similarity; ``kept`` is true
    for that document. Null, empty and blank texts have no shingles and stay alone; a text of fewer than ``size`` words is
    one shingle. Repeated rows give repeated results. Rows without ``doc_id`` take part, get their component's smallest id
    and are kept only if nobody in it has one. An empty table gives none.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketched = written(texts.mapInArrow(_sketches(size, percent), (
        "doc_id bigint, node bigint, n bigint, text_key bigint, bands array<bigint>, registers binary")), "hyper-sketches")

    names = written(sketched.select("doc_id", "node", "n", "text_key"), "hyper-names")
    held = written(sketched.where("registers is not null").select("node", F.explode("bands").alias("band")), "hyper-bands")
    members = written(_held_twice(held).select("node").distinct(), "hyper-members")
    wanted = names.groupBy("node").agg(F.min("text_key").alias("text_key")).join(members, "node")
    maps = spark.sparkContext.broadcast(membership(wanted, "text_key"))
    found = texts.mapInArrow(_whole_sets(size, maps), "node bigint, shingles array<bigint>")
    sets = written(found.join(members, "node", "left_semi").dropDuplicates(["node"]), "hyper-sets")
    able = written(_room(sets, percent), "hyper-able")
    registers = sketched.where("registers is not null").select("node", "registers").join(able, "node", "left_semi")
    sketches = written(registers.dropDuplicates(["node"]), "hyper-registers")
    postings = written(_held_twice(held.distinct().join(able, "node")), "hyper-postings")
    discard(sketched, held, members)

    pivots = postings.groupBy("band").agg(F.min(F.struct("alone", "node", "n", "room")).alias("y"))
    near = postings.select("band", F.struct("node", "n", "room").alias("x")).join(pivots, "band")
    first = written(_met(near, _fits("x", "y", "room", "n", percent)), "hyper-pairs")
    links = written(_confirmed(_sifted(first, sketches, percent), sets, percent), "hyper-links")
    roots = components(links, "a", "b")

    crowded = postings.groupBy("band").agg(F.count("*").alias("members")).where(F.col("members") > CROWD).select("band")
    crowded = written(crowded, "hyper-crowded")
    crowd = written(postings.join(crowded, "band", "left_semi").select("node").distinct(), "hyper-crowd")
    rare = written(_rare(sets, crowd), "hyper-rare")
    few = rare.groupBy("node").agg(F.count("*").alias("rare"))
    tight = able.join(crowd, "node", "left_semi").join(few, "node", "left").withColumn("rare", F.coalesce("rare", F.lit(0)))
    tight = written(tight.select("node", "n", "room", _room_without("rare", percent).alias("strict")), "hyper-tight")

    rooted = postings.join(tight.select("node", "strict"), "node", "left").join(roots, "node", "left").join(
        crowded.withColumn("full", F.lit(True)), "band", "left")
    rooted = rooted.select("band", "node", "n", "room", "strict", F.coalesce("root", "node").alias("root"),
                           F.when(F.col("full"), F.col("strict")).otherwise(F.col("room")).alias("most"))
    parts = rooted.groupBy("band", "root").agg(F.min("n").alias("low"), F.max("most").alias("room"), F.count("*").alias("members"))
    mixed = parts.groupBy("band").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most").select("band")
    parts = written(parts.join(mixed, "band"), "hyper-parts")
    rooted = written(rooted.join(mixed, "band", "left_semi"), "hyper-rooted")
    fits = _fits("p", "q", "room", "low", percent)
    across = written(parts.alias("p").join(parts.alias("q"), "band").where((F.col("p.root") < F.col("q.root")) & fits).select(
        "band", F.col("p.root").alias("one"), F.col("q.root").alias("other"), (F.col("p.members") * F.col("q.members")).alias("pairs")), "hyper-across")
    # Two components that meet in many bands: all their members once, if that is less than once per band.
    held = rooted.select("root", "node", "n", "room", "strict").distinct()
    size = held.groupBy("root").agg(F.count("*").alias("size"))
    whole = across.groupBy("one", "other").agg(F.sum("pairs").alias("pairs")).join(
        size.select(F.col("root").alias("one"), F.col("size").alias("size_one")), "one").join(
        size.select(F.col("root").alias("other"), F.col("size").alias("size_other")), "other").where(
        F.col("size_one") * F.col("size_other") < F.col("pairs")).select("one", "other")
    whole = written(whole, "hyper-whole")
    told = F.struct("node", "n", "room", "strict")
    left, right = (rooted.select("band", F.col("root").alias(root), told.alias(side)) for root, side in (("one", "x"), ("other", "y")))
    by_band = across.join(whole, ["one", "other"], "left_anti").select("band", "one", "other").join(left, ["band", "one"]).join(right, ["band", "other"])
    ones, others = (held.select(F.col("root").alias(root), told.alias(side)) for root, side in (("one", "x"), ("other", "y")))
    met = by_band.select("x", "y").union(whole.join(ones, "one").join(others, "other").select("x", "y"))
    loose, close = _fits("x", "y", "room", "n", percent), _fits("x", "y", "strict", "n", percent)
    rest = _met(met, F.when(F.col("x.strict").isNotNull() & F.col("y.strict").isNotNull(), close).otherwise(loose))
    held = rare.where("df > 1").join(tight, "node").join(roots, "node", "left").select(
        "h", F.struct("node", "n", "room", "strict", F.coalesce("root", "node").alias("root")).alias("x"))
    both = held.join(held.select("h", F.col("x").alias("y")), "h").where((F.col("x.root") < F.col("y.root")) & ~close)
    rest = rest.union(_met(both, loose)).distinct().join(first, ["a", "b"], "left_anti")
    more = written(_confirmed(_sifted(rest, sketches, percent), sets, percent), "hyper-links")
    discard(parts, rooted, across, whole, postings, first, sketches, sets, able, crowded, crowd, rare, tight)
    if not more.isEmpty():
        roots = components(links.union(more), "a", "b")

    named = names.join(roots, "node", "left").select("doc_id", "n", F.coalesce("root", "node").alias("root"))
    least = written(named.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("rows")).where("rows > 1"), "hyper-least")
    told = named.join(least, "root", "left").withColumn(
        "component_id", F.when(F.col("rows").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return told.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))

"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

A document is the set of its word shingles. Two sets link when ``100 * |both| >= percent * |either|``. Linked sets share a
shingle among the first ``n - ceil(percent * n / 100) + 1`` of each under any order both agree on; the rarer the first ones
are, the fewer sets meet.

1. *Screen.* Only a hashed quarter of the shingles (tier 0; further tiers where that is shorter than the prefix) is
   counted. The order (tier, shared or not) is one order for all sets, so a set none of whose shared shingles falls in its
   prefix links with nothing and is done. Most documents leave here, after moving a quarter of their shingles.
2. *Prefixes.* The sets that are left are counted in full. Unshared shingles come first in (frequency, hash) order and
   join nothing; the shared ones within the prefix become postings, with their position.
3. *Pairs.* Each posting list is joined with its pivot, the set with the fewest unshared shingles; filters drop pairs by
   size, by position and by the sizes of matching pieces of both sets (the suffix filter, with fixed cuts of the hash
   range); each pair left is intersected once. Then the sets that did not end in their pivot's component meet all
   members of their lists outside their own component. So all pairs are covered that could join two components, and a
   group of very many near copies costs a row per copy, not per pair.

Sets are named by a 64-bit hash of their content, so exact copies are one set from the start; two different sets among n
share a name with probability ``n**2 / 2**65``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm import words as W
from demandloom.llm.components import components
from demandloom.llm.holders import HOLDER, with_holders
from demandloom.llm.storage import discard, in_membership, membership, written

TIERS = 4
PIECES = 16


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a text of fewer words is one shingle, one without words has none."""
    hashes = W.word_hashes(W.split_words(text))
    return np.unique(W.shingle_hashes(hashes, min(size, len(hashes)))) if len(hashes) else hashes


def set_name(shingles: np.ndarray, doc_id: int | None) -> int:
    """The content's hash; an empty set is named by its document, as it is nobody's copy."""
    return W.fingerprint(shingles) if len(shingles) else W.fingerprint(np.array([0 if doc_id is None else doc_id], np.int64))


def prefix_length(n: int, percent: int) -> int:
    return n + (-percent * n // 100) + 1 if n else 0


def leading_tiers(shingles: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of the first tiers that hold a whole prefix, and per shingle how many of its tier must be shared.

    In (tier, shared or not) order the first shared shingle of a tier stands behind all earlier tiers and the unshared
    ones of its own; it lies in the prefix when more of the tier than that number are shared.
    """
    tiers = (shingles & W.U64(TIERS - 1)).astype(np.int64)
    counts = np.bincount(tiers, minlength=TIERS)
    upto, prefix = np.cumsum(counts), prefix_length(len(shingles), percent)
    chosen = np.concatenate(([0], upto[:-1])) < prefix
    rows = chosen[tiers]
    return shingles[rows], (upto - prefix)[tiers[rows]]


def _screened(size: int, percent: int):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("parts", pa.list_(pa.int64())),
        ("needs", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # names in this task: copies repeat only their row
        nothing = np.empty(0, np.int64)
        for batch in W.slices(batches):
            ids, nodes, counts, parts, needs = batch.column(0).to_pylist(), [], [], [], []
            for doc_id, text in zip(ids, W.column_bytes(batch, "text")):
                found = shingle_set(text, size)
                node = set_name(found, doc_id)
                part, need = (nothing, nothing) if node in seen else leading_tiers(found, percent)
                seen.add(node)
                nodes.append(node), counts.append(len(found)), parts.append(W.signed(part)), needs.append(need)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(nodes, pa.int64()), pa.array(counts, pa.int64()),
                 W.long_lists(parts), W.long_lists(needs)], schema=schema,
            )

    return run


def _whole_sets(size: int, maps):
    schema = pa.schema([
        ("node", pa.int64()), ("n", pa.int64()), ("shingles", pa.list_(pa.int64())), ("pieces", pa.list_(pa.int64())),
    ])
    wanted = maps

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = wanted.value
        seen: set[int] = set()
        for batch in W.slices(batches):
            nodes, counts, sets, pieces = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), W.column_bytes(batch, "text")):
                found = shingle_set(text, size)
                node = set_name(found, doc_id)
                if not len(found) or node in seen or not in_membership(np.array([node]), (first, second))[0]:
                    continue
                seen.add(node)
                nodes.append(node), counts.append(len(found)), sets.append(W.signed(found))
                pieces.append(np.bincount((found >> W.U64(60)).astype(np.int64), minlength=PIECES))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(counts, pa.int64()), W.long_lists(sets), W.long_lists(pieces)],
                schema=schema,
            )

    return run


def _filters(percent: int) -> Column:
    """Length, positional and suffix filter for postings ``x`` and ``y`` of one shingle."""
    sizes = F.col("x.n") + F.col("y.n")
    length = F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent
    behind = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    piecewise = F.aggregate(F.zip_with("x.pieces", "y.pieces", lambda a, b: F.least(a, b)), F.lit(0).cast("bigint"), lambda a, b: a + b)
    return length & (behind * (100 + percent) >= sizes * percent) & (piecewise * (100 + percent) >= sizes * percent)


def _ordered_pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose exact intersection reaches the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b")).cast("bigint")
    scored = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", both.alias("both"))
    return scored.where(F.col("both") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("both")) * percent).select("a", "b")


def _postings(sets: DataFrame, percent: int) -> DataFrame:
    """``h, node, n, pos, alone, pieces`` of the shared shingles within each prefix; ``alone``: unshared ones."""
    rows = sets.select("node", "n", F.explode("shingles").alias("h"))
    shared = rows.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    own = Window.partitionBy("node")
    placed = rows.join(shared, "h").select(
        "h", "node", "n", (F.col("n") - F.count("*").over(own)).alias("alone"),
        F.row_number().over(own.orderBy("df", "h")).alias("rank"),
    ).select("h", "node", "n", "alone", (F.col("alone") + F.col("rank") - 1).alias("pos"))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1
    return placed.where(F.col("pos") < prefix).join(sets.select("node", "pieces"), "node")


def ngram_join(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs`` (columns ``doc_id``, ``text``; others are ignored).

    ``component_id`` is the smallest ``doc_id`` reachable over links. Null, empty and blank texts have no shingles and
    stay alone; a text of fewer than ``size`` words is one shingle. Repeated rows give repeated results. Rows without
    ``doc_id`` take part and get their component's smallest id, null if nobody in it has one. An empty table gives none.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    screened = written(texts.mapInArrow(
        _screened(size, percent), "doc_id bigint, node bigint, n bigint, parts array<bigint>, needs array<bigint>"
    ), "ngram-screened")

    tiered = screened.select("node", F.explode(F.arrays_zip("parts", "needs")).alias("s")).select(
        F.col("s.parts").alias("h"), "node", F.col("s.needs").cast("int").alias("need"))
    shared = tiered.groupBy("h").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("h")
    left = tiered.join(shared, "h").groupBy("node", F.col("h").bitwiseAND(TIERS - 1).alias("tier")).agg(
        F.countDistinct("h").alias("shared"), F.max("need").alias("need"))
    survivors = written(left.where("shared > need").select("node").distinct(), "ngram-survivors")
    names = written(screened.select("doc_id", "node", "n"), "ngram-names")
    discard(screened)

    maps = spark.sparkContext.broadcast(membership(survivors, "node"))
    discard(survivors)
    sets = written(texts.mapInArrow(
        _whole_sets(size, maps), "node bigint, n bigint, shingles array<bigint>, pieces array<bigint>"
    ).dropDuplicates(["node"]), "ngram-sets")
    postings = written(_postings(sets, percent), "ngram-postings")

    pivots = postings.groupBy("h").agg(F.min(F.struct("alone", "node", "n", "pos", "pieces")).alias("y"))
    near = postings.select("h", F.struct("node", "n", "pos", "pieces").alias("x")).join(pivots, "h")
    first = written(_ordered_pairs(near.where(F.col("x.node") != F.col("y.node")).where(_filters(percent))), "ngram-pairs")
    links = written(_verified(first, sets, percent), "ngram-links")
    roots = components(links, "a", "b")

    rooted = roots.select("node", "root")
    grouped = postings.join(rooted, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ends = pivots.select("h", F.col("y.node").alias("node")).join(rooted, "node", "left").select(
        "h", F.coalesce("root", "node").alias("pivot"))
    grouped = written(grouped.join(ends, "h"), "ngram-grouped")
    discard(postings)
    outside = grouped.where("root <> pivot").select("h", F.struct("node", "n", "pos", "pieces", "root").alias("x"))
    members = grouped.select("h", F.struct("node", "n", "pos", "pieces", "root").alias("y"))
    rest = outside.join(members, "h").where(F.col("x.root") != F.col("y.root")).where(_filters(percent))
    more = written(_verified(_ordered_pairs(rest).join(first, ["a", "b"], "left_anti"), sets, percent), "ngram-links")
    discard(grouped, first, sets)
    if not more.isEmpty():
        roots = components(links.union(more), "a", "b")

    named = names.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_per_group(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its component; columns stay.

    Different texts of one ``doc_id`` are documents of their own. Rows repeated with id and text stay once: the first by
    their other columns. Rows without ``doc_id`` cannot be named as a copy and stay. An empty table gives none.
    """
    named, _ = with_holders(docs)
    found = written(ngram_join(named.select(F.col(HOLDER).alias("doc_id"), "text"), size, percent), "ngram-components")
    copies = found.where("doc_id <> component_id").select(F.col("doc_id").alias(HOLDER)).distinct()
    repeated = found.groupBy(F.col("doc_id").alias(HOLDER)).count().where(f"count > 1 and {HOLDER} is not null").select(HOLDER)
    kept = named.join(copies, HOLDER, "left_anti")
    if repeated.isEmpty():  # whole texts then move once
        return kept.select(*docs.columns)
    first = Window.partitionBy(HOLDER).orderBy(*[c for c in docs.columns if c not in ("doc_id", "text")])
    once = kept.join(repeated, HOLDER, "left_semi").withColumn("__turn", F.row_number().over(first)).where("__turn = 1").select(*docs.columns)
    return kept.join(repeated, HOLDER, "left_anti").select(*docs.columns).unionByName(once)

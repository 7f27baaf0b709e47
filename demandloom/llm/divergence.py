"""Source divergence audit: how far the sources of a language are apart, and which terms set a source off.

Per language the terms that enough of its documents hold are kept. A group (language and source, or a whole language)
gives each kept term a smoothed share in billionths, and two shares differ by ``(p - q)^2 / (p + q)``, all in integers.

* *Counts.* Tasks count terms per source in hash tables of a fixed size, emptied when full; what is shuffled is one row per
  table and term, by (language, term), and everything per term is found in that one shuffle.
* *Pairs of sources.* The difference of a term depends on two counts only, so terms are first counted by (source, count,
  other source, count); shares are worked out on those rows. Terms that one source of a pair or both lack follow from
  the sources' own count tables and the number of kept terms, so absent terms are never listed.
* *Terms.* The value of a term rises with its count in the group and falls with its count in the language. A term that ``k``
  others beat or equal in both, and in the order of the text, cannot be among the first ``k``. So each task keeps its terms that
  fewer than ``k`` others dominate (a skyband, which needs no totals), the skybands are merged the same way, and only what
  is left is ranked exactly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm import words as W
from demandloom.llm.storage import discard, written

LEAST_DOCS = 10
RANKS = 10
SCALE = 1_000_000_000
TABLE_TERMS = 400_000  # distinct terms a task holds before it hands them on
HELD = 2048  # terms a task holds per group before it takes their skyband
BEST = 128  # of them, those that most others are tried against first
LETTERS = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | frozenset(range(128, 256))
#: Every byte that is no letter becomes a blank, and A-Z become lower case. Bytes of other characters are all above 127.
LOWERED = bytes((byte + 32 if 65 <= byte <= 90 else byte) if byte in LETTERS else 32 for byte in range(256))

COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(LOWERED).split() if text else []


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by source, in tables of at most about ``TABLE_TERMS`` terms."""
    schema = pa.schema([
        ("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64()),
    ])
    tables: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def emptied() -> Iterator[pa.RecordBatch]:
        for (lang, source), (found, documents) in tables.items():
            names = list(found)
            for start in range(0, len(names), 50_000):
                part = names[start : start + 50_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()),
                    pa.array(part, pa.binary()).cast(pa.string()), pa.array([found[t] for t in part], pa.int64()),
                    pa.array([documents[t] for t in part], pa.int64())], schema=schema)
        tables.clear()

    for batch in W.slices(batches):
        groups = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
        for group, text in zip(groups, W.column_bytes(batch, "text")):
            words = terms_of(text)
            if not words:
                continue
            found, documents = tables.setdefault(group, (Counter(), Counter()))
            before = len(found)
            found.update(words)
            documents.update(set(words))
            held += len(found) - before
            if held > TABLE_TERMS:
                yield from emptied()
                held = 0
    yield from emptied()


def skyband(counts: np.ndarray, totals: np.ndarray, terms: list[bytes], k: int) -> np.ndarray:
    """Places of the terms that fewer than ``k`` others dominate: count as high, total as low, earlier in UTF-8."""
    place = np.empty(len(terms), np.int64)
    place[sorted(range(len(terms)), key=lambda i: terms[i])] = np.arange(len(terms))
    kept = []
    for i in range(len(terms)):
        above = (counts >= counts[i]) & (totals <= totals[i]) & (place < place[i])
        if np.count_nonzero(above) < k:
            kept.append(i)
    return np.array(kept, np.int64)


def _leading(terms: list[bytes]) -> np.ndarray:
    """The first eight bytes as a number: a smaller one is an earlier term, equal ones tell nothing."""
    return np.array([term[:8] for term in terms], "S8").view(">u8").astype(np.uint64) if terms else np.empty(0, np.uint64)


class Band:
    """The terms of one group that a task still holds."""

    def __init__(self, k: int) -> None:
        self.k, self.limit = k, HELD
        self.terms: list[bytes] = []
        self.counts = self.totals = np.empty(0, np.int64)
        self.best = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)

    def add(self, terms: list[bytes], counts: np.ndarray, totals: np.ndarray) -> None:
        """Terms that ``k`` of the best dominate go at once; the skyband is taken whenever too many are held."""
        high, low, early = self.best
        if len(high):
            above = (high >= counts[:, None]) & (low <= totals[:, None]) & (early < _leading(terms)[:, None])
            stay = np.flatnonzero(above.sum(axis=1) < self.k)
            terms, counts, totals = [terms[i] for i in stay], counts[stay], totals[stay]
        self.terms = self.terms + terms
        self.counts, self.totals = np.concatenate((self.counts, counts)), np.concatenate((self.totals, totals))
        if len(self.terms) >= self.limit:
            self.reduce()

    def reduce(self) -> None:
        kept = skyband(self.counts, self.totals, self.terms, self.k)
        self.terms, self.counts, self.totals = [self.terms[i] for i in kept], self.counts[kept], self.totals[kept]
        self.limit = max(HELD, 2 * len(kept))
        first = np.argsort(-self.counts / (self.totals + 1), kind="stable")[:BEST]
        self.best = self.counts[first], self.totals[first], _leading([self.terms[i] for i in first])


def _skybands(k: int):
    """Rows ``lang, source, term, n, total`` of which a task hands on the skyband per group."""
    schema = pa.schema([
        ("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("total", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands: dict[tuple[str, str], Band] = {}
        for batch in batches:
            names = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            places: dict[tuple[str, str], list[int]] = {}
            for place, name in enumerate(names):
                places.setdefault(name, []).append(place)
            terms = W.column_bytes(batch, "term")
            counts, totals = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))
            for name, mine in places.items():
                bands.setdefault(name, Band(k)).add([terms[i] for i in mine], counts[mine], totals[mine])
        for (lang, source), band in bands.items():
            band.reduce()
            size = len(band.terms)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()),
                pa.array(band.terms, pa.binary()).cast(pa.string()), pa.array(band.counts), pa.array(band.totals)], schema=schema)

    return run


def share(n: Column, whole: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (n + 2) / (whole + 2 * terms))``, exact beyond 64 bits; not used where there are no terms."""
    wide = F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    return F.call_function("div", wide, F.greatest(whole + terms * 2, F.lit(1)).cast("decimal(20,0)")) + 1


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def source_divergence(docs: DataFrame, ranks: int = RANKS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``lang, source, part, item, value, rank`` for ``docs`` (columns ``text, lang, source``; others are ignored).

    Part ``pair``: every other source of the language, by the sum of the differences over all kept terms. Part ``term``: the
    ``ranks`` terms of the group that are commoner there than in the language, by their difference. Ties go to the item earlier in
    UTF-8. Null text, language and source are read as ''. Repeated rows count each time; a row is a document. Groups whose
    documents hold no kept term are listed as pairs; a language without kept terms has pairs of value 0. No documents give no rows.
    """
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    counted = named.mapInArrow(_counted, COUNTS)
    by_term = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = by_term.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("by"),
    ).where(F.col("docs") >= least_docs)
    kept = written(kept.select("lang", "term", "total", "by"), "divergence-terms")

    cells = kept.select("lang", "term", "total", F.explode("by").alias("s")).select(
        "lang", "term", "total", F.col("s.source").alias("source"), F.col("s.n").alias("n"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_whole"))
    wholes = cells.groupBy("lang", "source").agg(F.sum("n").alias("whole"))
    groups = named.select("lang", "source").distinct().join(wholes, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = written(groups.select("lang", "source", *[
        F.coalesce(c, F.lit(0)).alias(c) for c in ("whole", "terms", "lang_whole")]), "divergence-groups")

    pairs = _pairs(kept, cells, groups)
    banded = cells.select("lang", "source", "term", "n", "total").mapInArrow(_skybands(ranks), "lang string, source string, term string, n bigint, total bigint")
    merged = banded.repartition("lang", "source").mapInArrow(_skybands(ranks), banded.schema)
    told = written(_terms(merged, groups).unionByName(pairs), "divergence-report")
    by_value = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    listed = told.withColumn("rank", F.row_number().over(by_value)).where((F.col("part") == "pair") | (F.col("rank") <= ranks))
    discard(kept, groups)
    return listed.select("lang", "source", "part", "item", "value", "rank")


def _terms(merged: DataFrame, groups: DataFrame) -> DataFrame:
    shares = merged.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("whole"), F.col("terms")).alias("p"),
        share(F.col("total"), F.col("lang_whole"), F.col("terms")).alias("q"))
    return shares.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value"))


def _pairs(kept: DataFrame, cells: DataFrame, groups: DataFrame) -> DataFrame:
    """Sums over all kept terms, by inclusion and exclusion.

    With ``f(c, d)`` the difference at counts ``c`` and ``d``, the sum is that of ``f(0, 0)`` over all terms, plus
    ``f(c, 0) - f(0, 0)`` over those of one source, the same for the other, plus ``f(c, d) - f(c, 0) - f(0, d) + f(0, 0)`` over common ones.
    """
    def shares(side: str) -> tuple[Column, Column]:
        at = [F.col(f"{side}.whole"), F.col(f"{side}.terms")]
        return share(F.col(f"n_{side}"), *at), share(F.lit(0), *at)

    both = F.explode(F.flatten(F.transform("by", lambda x, i: F.transform(
        F.slice("by", i + 2, F.size("by")),  # sources in order: those after x
        lambda y: F.struct(x["source"].alias("one"), x["n"].alias("n_a"), y["source"].alias("two"), y["n"].alias("n_b"))))))
    common = kept.select("lang", both.alias("c")).groupBy("lang", "c.one", "c.n_a", "c.two", "c.n_b").agg(F.count("*").alias("times"))
    a, b = groups.alias("a"), groups.alias("b")
    named = common.join(a, (F.col("a.lang") == common["lang"]) & (F.col("a.source") == F.col("one"))).join(
        b, (F.col("b.lang") == common["lang"]) & (F.col("b.source") == F.col("two")))
    (p, p0), (q, q0) = shares("a"), shares("b")
    meeting = named.select("a.lang", "one", "two", "times", p.alias("p"), p0.alias("p0"), q.alias("q"), q0.alias("q0"))
    p, p0, q, q0 = (F.col(c) for c in ("p", "p0", "q", "q0"))
    gain = difference(p, q) - difference(p, q0) - difference(p0, q) + difference(p0, q0)
    shared = meeting.select("lang", "one", "two", (F.col("times") * gain).alias("value"))

    own = cells.groupBy("lang", "source", "n").agg(F.count("*").alias("times")).withColumnRenamed("n", "n_a")
    held = own.alias("o").join(a, (F.col("o.lang") == F.col("a.lang")) & (F.col("o.source") == F.col("a.source"))).join(
        b, (F.col("b.lang") == F.col("a.lang")) & (F.col("b.source") != F.col("a.source")))
    pa_, pa0 = shares("a")
    alone = held.select(
        "a.lang", F.least("a.source", "b.source").alias("one"), F.greatest("a.source", "b.source").alias("two"), "times",
        pa_.alias("p"), pa0.alias("p0"), share(F.lit(0), F.col("b.whole"), F.col("b.terms")).alias("q0"))
    alone = alone.select("lang", "one", "two", (F.col("times") * (difference(p, q0) - difference(p0, q0))).alias("value"))

    every = a.join(b, (F.col("a.lang") == F.col("b.lang")) & (F.col("a.source") < F.col("b.source"))).select(
        "a.lang", F.col("a.source").alias("one"), F.col("b.source").alias("two"), F.col("a.terms").alias("times"),
        share(F.lit(0), F.col("a.whole"), F.col("a.terms")).alias("p0"), share(F.lit(0), F.col("b.whole"), F.col("b.terms")).alias("q0"))
    nowhere = every.select("lang", "one", "two", F.when(F.col("times") > 0, F.col("times") * difference(p0, q0)).otherwise(0).alias("value"))

    sums = nowhere.unionByName(alone).unionByName(shared).groupBy("lang", "one", "two").agg(F.sum("value").alias("value"))
    sides = F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("two").alias("item")), F.struct(F.col("two").alias("source"), F.col("one").alias("item"))))
    return sums.select("lang", sides.alias("s"), "value").select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")

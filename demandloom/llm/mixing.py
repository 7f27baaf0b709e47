"""Temperature mixing of sources, in DataFrame operations only.

The share of source ``s`` in the mix is its token share raised to the power ``x``, normalised. ``x = 1`` keeps the corpus,
``x = 0`` weighs sources alike. ``x`` is found by bisection, five halvings per pass over the per-source totals: the
largest ``x`` whose mix has the entropy asked for, then, as more weight for small sources means more repetition, the
smallest ``x`` from there on at which no source is read more often than ``max_passes`` times.

The weights are then realised as permutations of blocks: a source's documents fall into blocks by a hash, the blocks are
permuted by another one and read in that order, pass after pass, until the source's budget of tokens is reached. Sums run
over block totals first, so that a source with a third of all rows is never one group; only within a block are documents
put in order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm.storage import discard, written

STEPS = 32  # candidates per pass: five halvings
PASSES = 6
BLOCKS = 4096  # per source, at least
BLOCK_TOKENS = 1 << 20  # of the corpus, for every block beyond that: a block stays one small group
NO_SOURCE = ""  # key of documents without source; every other key is an equals sign and the source


def hashed(*parts: Column) -> Column:
    """32 bits of an MD5, which other engines can repeat."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("bigint")


def _largest(shares: DataFrame, holds: Column) -> float | None:
    """The largest exponent in 0..1 at which ``holds`` is true of the mix, if it is at 0; falls from true to false.

    The driver receives ``STEPS + 1`` rows per pass.
    """
    low, high = 0.0, 1.0
    for round_ in range(PASSES):
        step = (high - low) / STEPS
        tried = F.explode(F.array(*[F.lit(low + step * k) for k in range(STEPS + 1)]))
        raised = shares.select("share", "tokens", "total", tried.alias("x")).withColumn("raised", F.pow("share", "x"))
        mixes = raised.groupBy("x").agg(
            F.sum("raised").alias("norm"), F.sum(F.col("raised") * F.log("raised")).alias("weighted"),
            F.max(F.col("raised") / F.col("tokens")).alias("densest"), F.max("total").alias("total"))
        entropy = F.log("norm") - F.col("weighted") / F.col("norm")
        passes = F.col("densest") / F.col("norm")
        rows = mixes.select("x", entropy.alias("entropy"), passes.alias("passes"), "total").select("x", holds.alias("ok")).orderBy("x").collect()
        good = [row["x"] for row in rows if row["ok"]]
        if not good:
            return None if round_ == 0 else low
        low = max(good)
        if low >= high:
            return high
        high = low + step
    return low


def mixing_exponent(totals: DataFrame, budget: int, entropy: float | None, max_passes: float | None) -> float:
    """The exponent, rounded down to six places, for per-source ``tokens``.

    ``entropy`` is a fraction of the largest possible one. A repetition limit that not even the corpus as it is can
    keep leaves 1.
    """
    used = totals.where("tokens > 0")
    whole = used.agg(F.sum("tokens").alias("total"), F.count("*").alias("sources"))
    shares = used.crossJoin(F.broadcast(whole)).select(  # one row of sums
        "tokens", "total", (F.col("tokens") / F.col("total")).alias("share"), "sources")
    first = whole.first()
    if not first["total"] or first["sources"] == 1:
        return 1.0
    x = 1.0
    if entropy is not None:
        found = _largest(shares, F.col("entropy") >= entropy * math.log(first["sources"]))
        x = 0.0 if found is None else found
    if max_passes is not None:
        # Repetition falls as the exponent grows: the largest at which it is still too high, and a step beyond.
        broken = _largest(shares, F.col("passes") * budget > max_passes)
        if broken is not None and broken >= x:
            x = min(1.0, broken + 2e-6)
    return math.floor(x * 1_000_000 + 1e-9) / 1_000_000


def mix_sources(
    docs: DataFrame, budget: int | None = None, entropy: float | None = 0.95, max_passes: float | None = 4.0, seed: int = 7
) -> DataFrame:
    """``doc_id, source, n_tokens, pass, block, slot, weight, exponent``: one row per time a document is read.

    ``budget`` is the tokens to read in all (as many as there are, if not given); tokens are words between white space.
    A source reads ``floor(weight * budget)`` tokens: whole passes, then blocks in permuted order and documents in hash
    order while the tokens before a document stay under the budget. Documents without words are not read. A null source
    is a source of its own, reported as null; null texts have no words; a null ``doc_id`` is ordered by its text. Repeated
    rows are documents of their own. Empty input gives no rows.
    """
    words = F.size(F.filter(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "[ \\t-\\r]+"), lambda w: w != ""))
    identity = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.col("text").cast("string")))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(NO_SOURCE)).alias("source"), words.cast("bigint").alias("n_tokens"), identity.alias("identity"),
    ).withColumn("draw", hashed(F.col("identity"), F.lit(str(seed))))
    rows = written(rows.where("n_tokens > 0").drop("identity"), "mixing-rows")
    whole = rows.agg(F.sum("n_tokens")).first()[0] or 0
    stored, rows = rows, rows.withColumn("block", F.col("draw") % max(BLOCKS, whole // BLOCK_TOKENS))

    blocks = rows.groupBy("source", "block").agg(F.sum("n_tokens").alias("block_tokens"))
    blocks = written(blocks, "mixing-blocks")
    totals = blocks.groupBy("source").agg(F.sum("block_tokens").alias("tokens"))
    budget = whole if budget is None else budget
    x = mixing_exponent(totals, budget, entropy, max_passes)

    norm = totals.agg(F.sum(F.pow(F.col("tokens") / whole if whole else F.lit(0.0), F.lit(x))).alias("norm"))
    weighed = totals.crossJoin(F.broadcast(norm)).select(  # one row
        "source", "tokens", (F.pow(F.col("tokens") / (whole or 1), F.lit(x)) / F.col("norm")).alias("weight"))
    weighed = weighed.withColumn("quota", F.floor(F.col("weight") * budget + 1e-6)).withColumn(
        "passes", F.floor(F.col("quota") / F.col("tokens"))).withColumn("rest", F.col("quota") - F.col("passes") * F.col("tokens"))
    turn = Window.partitionBy("source").orderBy(hashed(F.col("block").cast("string"), F.col("source"), F.lit(str(seed))), "block")
    placed = blocks.join(weighed, "source").select(
        "source", "block", "weight", "passes", "rest", F.row_number().over(turn).alias("turn"),
        (F.sum("block_tokens").over(turn.rowsBetween(Window.unboundedPreceding, 0)) - F.col("block_tokens")).alias("ahead"))
    inside = Window.partitionBy("source", "block").orderBy("draw", "doc_id", "n_tokens")
    each = rows.join(placed, ["source", "block"]).withColumn("slot", F.row_number().over(inside)).withColumn(
        "before", F.col("ahead") + F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens"))
    times = F.col("passes") + (F.col("before") < F.col("rest")).cast("bigint")
    read = each.withColumn("times", times).where("times > 0").withColumn("pass", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))))
    source = F.when(F.col("source") != NO_SOURCE, F.substring("source", 2, 1 << 30))
    order = written(read.select(
        "doc_id", source.alias("source"), "n_tokens", "pass", F.col("turn").cast("bigint").alias("block"),
        F.col("slot").cast("bigint").alias("slot"), "weight", F.lit(x).alias("exponent")), "mixing-order")
    discard(stored, blocks)
    return order

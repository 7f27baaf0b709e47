"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum and a join, so a node with very many neighbours is combined inside the tasks and its
join is left to AQE, which splits hot keys. Edges are written to the shared folder after each round; the driver sees two
numbers per round and nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.storage import discard, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, left: str, right: str, label: str = "components") -> DataFrame:
    """``node``, ``root``: the smallest node reachable, for every node that is not itself a root.

    Nodes without links do not appear. Links to oneself and null ends are ignored; repeated links count once.
    """
    edges = links.select(
        F.greatest(F.col(left), F.col(right)).alias("u"), F.least(F.col(left), F.col(right)).alias("v"),
        F.col(left).isNotNull().alias("l"), F.col(right).isNotNull().alias("r"),
    ).where("l and r and u <> v").select("u", "v").distinct()
    edges, before = written(edges, label), None
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before or not seen[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = seen
        older, edges = edges, written(_small_star(_large_star(edges)), label)
        discard(older)

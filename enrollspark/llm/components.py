"""Connected components of a link table, in rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrollspark.llm.common import stage

MOST_ROUNDS = 60


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link: the root is the smallest node it reaches.

    Each round hangs the larger neighbours of a node on its smallest neighbour, then
    the smaller ones likewise, until every node hangs on its root. A node's
    neighbours are reduced to their minimum before anything is joined, so no list
    of neighbours is ever built; links and minima are staged, so a node with very
    many links is a plain join of two tables that Spark can split. Null ends and
    links to oneself count for nothing; repeated links are one.
    """
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    e = stage(e.distinct(), "links")
    before = None
    for _ in range(MOST_ROUNDS):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "minima")
        # larger neighbours hang on the smallest of the node's neighbourhood
        e = stage(both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links")
        low = stage(e.groupBy("u").agg(F.min("v").alias("m")), "minima")
        near = e.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stage(near.union(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = e.select(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

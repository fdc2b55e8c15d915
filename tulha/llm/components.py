"""Connected components of a distributed graph, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tulha.llm.tables import written


#: Parts that the neighbours of one node are dealt to.
SALTS = 8


def _hung(edges: DataFrame, least: DataFrame) -> DataFrame:
    """The far end of each edge (a, b), hung on the least neighbour of a. A hub's edges are salted, and Spark may split the parts further."""
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    ends = least.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    # Repeated rows look small when compressed; a merge join keeps them from being broadcast.
    return salted.join(ends.hint("merge"), ["a", "salt"]).select(F.col("b").alias("a"), F.col("m").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) for every node of the edges (a, b); nodes without edges are left out.

    A round hangs the neighbours of each node on their least one: first those
    above the node, then those below it. Each round keeps at most as many edges
    as there were, and the rounds needed grow with the logarithm of the longest
    chain. It ends when every node hangs on one other that hangs on none. All of
    it is joins and groupings; the least neighbour of a hub is found by map-side minimum.
    """
    pairs = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b"), "edges")
    while True:
        both = pairs.union(pairs.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = written(_hung(both.filter("b > a"), least), "stars")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _hung(large, least).filter("a <> b")
        pairs = written(small.union(least.select("a", "m")).distinct(), "stars")
        ends = pairs.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(pairs.select("b", F.lit(0), F.lit(1)))
        # A node that hangs on two, or hangs on one and holds another, needs a further round.
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not ends.agg(F.count_if((F.col("up") > 1) | (F.col("up") + F.col("down") > 1))).first()[0]:
            break
    stars = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())

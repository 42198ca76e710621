"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, discard


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of (a, b): the smallest node reachable by edges.

    Alternating large-star and small-star rounds: every node links its larger neighbours, then its
    smaller ones and itself, to the smallest node it sees. Each round is two aggregations with
    map-side combining and two joins, keeps the number of edges at most, and is written out, which
    cuts the lineage. It ends when a round changes no edge; the number of rounds grows with the
    logarithm of a component's diameter. No component is gathered anywhere. Loops are ignored.
    """
    links = cut(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(least, "u")
        small = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(near.select("u", F.col("m").alias("v")))
        links, done = cut(small.distinct(), "edges"), links
        discard(done)
    found = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamwork.operators.salted import lookup
from loamwork.session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the least of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return lookup(both.filter("b > a"), ["a"], ["b"], least).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = lookup(down, ["a"], ["b"], least)
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).filter("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of ``edges`` (a, b) is linked with.

    Rounds end when no link changes; the number of rounds grows with the logarithm of
    the longest chain. Minima are taken before shuffling, and joins deal the
    links of a hub over many tasks. Links of a node with itself, nulls and repeats are
    ignored; an empty table gives an empty result. Nodes that occur only in links with
    themselves are not returned.
    """
    now = materialise(edges.select("a", "b").filter("a <> b").distinct(), "links")
    last = None
    while True:
        now = materialise(_small_star(_large_star(now)).distinct(), "stars")
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == last:
            break
        last = mark
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))

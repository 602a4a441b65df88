"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapework.llm.common import forget, stored


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node that links reach) of every node in links (a, b).

    Every round, nodes take the smallest label of their neighbours and then their label's label, so that paths shorten by half. Rounds are stored.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("component")))
    while True:
        heard = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("least"))
        new = labels.join(heard, labels["node"] == heard["a"]).select("node", F.least("component", "least").alias("new"), F.col("component").alias("old"))
        step = stored(new)
        target = step.select(F.col("node").alias("label"), F.col("new").alias("further"))
        jumped = stored(step.join(target, step["new"] == target["label"]).select("node", F.least("new", "further").alias("component"), (F.least("new", "further") != F.col("old")).alias("moved")))
        forget(labels, step)
        labels = jumped
        if not jumped.filter("moved").limit(1).count():
            forget(both)
            found = labels.select("node", "component")
            found.stored_at = labels.stored_at
            return found


def _are_stars(edges: DataFrame) -> bool:
    """Whether every edge (a, b) leads to a centre: no node leads to two others, and none that is led to leads on."""
    end = lambda c, out: edges.select(F.col(c).alias("v"), F.lit(out).alias("out"), F.lit(1 - out).alias("into"))
    ends = end("a", 1).unionByName(end("b", 0)).groupBy("v").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return ends.filter("out > 1 OR (out = 1 AND into = 1)").isEmpty()


def star_components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node that links reach) of every node in links (a, b), by alternating large-star and small-star.

    A large-star joins each node's larger neighbours to the smallest of its neighbours and itself, a small-star its smaller neighbours and itself. Neither adds
    edges, and both keep components, until every component is a star around its smallest node. A node with very many neighbours is a skewed join key against one row.
    """
    # An edge points from the larger to the smaller node.
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.col("u")).alias("m"))
        large = stored(both.filter("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        rest = large.join(least, F.col("a") == F.col("u")).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = stored(own.unionByName(rest).distinct())
        forget(edges, large)
        edges = small
    found = stored(edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
    forget(edges)
    return found

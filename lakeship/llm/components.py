"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeship.llm.common import settle

MOST_ROUNDS = 40


def _lowest_neighbour(edges: DataFrame) -> DataFrame:
    """(node, low): the smallest of a node and its neighbours in the table of directed edges (node, other)."""
    return edges.groupBy("node").agg(F.min("other").alias("_m")).select("node", F.least("node", "_m").alias("low"))


def _large_star(links: DataFrame) -> DataFrame:
    """Each node ties its larger neighbours to its lowest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = both.select(F.col("a").alias("node"), F.col("b").alias("other"))
    low = _lowest_neighbour(edges)
    out = edges.join(low, "node").where("other > node AND other <> low")
    return out.select(F.col("low").alias("a"), F.col("other").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node ties its smaller neighbours and itself to its lowest neighbour."""
    edges = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
    low = _lowest_neighbour(edges)
    out = edges.join(low, "node")
    tied = out.where("other <> low").select(F.col("low").alias("a"), F.col("other").alias("b"))
    own = low.where("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b"))
    return tied.unionByName(own).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), a <> b; `root` is its component's smallest node.

    Nothing but two numbers a round (rows and a checksum of the links) reaches the driver; each round's links are
    stored in the shared folder. A node with very many links is summed before the shuffle, and its join is one that
    adaptive execution can split. Ends when a round changes nothing: then each link goes from a root to a leaf.
    """
    links = settle(links.select("a", "b").where("a <> b").distinct(), "links")
    state = None
    for _ in range(MOST_ROUNDS):
        links = settle(_small_star(_large_star(links)), "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.expr("xxhash64(a, b) >> 20"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    leaves = links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    roots = links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return leaves.unionByName(roots)

"""Connected components of links by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours. No more links than before."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").distinct()


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of the undirected links (a, b), root the smallest node reachable.

    Nulls and links of a node to itself are left out; repeated links count once. Work and size are those of the
    links; a hot node's links are aggregated before they are shuffled and split by the join.
    """
    files = 8 * edges.sparkSession.sparkContext.defaultParallelism  # at most: the links of many small partitions share them
    state = materialize(_distinct(edges.select("a", "b").dropna().select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))).coalesce(files), "links")
    print_of = F.struct(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    before = state.agg(print_of.alias("p")).first()[0]
    for _ in range(most_rounds):
        if not before[0]:
            break
        after_state = materialize(_distinct(_small_star(_large_star(state))).coalesce(files), "links")
        after = after_state.agg(print_of.alias("p")).first()[0]
        discard(state)
        state = after_state
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components: not settled")
    return state.select(F.col("a").alias("node"), F.col("b").alias("root"))

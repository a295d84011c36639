"""Connected components of a graph of integers, by alternating stars."""

from pyspark.sql import DataFrame, functions as F

from pathkin.session import cut_lineage


def _to_least(edges: DataFrame) -> DataFrame:
    """(a, b, least): each edge with the least neighbour of ``a``, or ``a`` if that is less."""
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return edges.join(least, "a")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (a, b); a component is its least node.

    Edges may repeat and stand in either direction; an edge from a node to itself
    or to null tells nothing. Each round takes larger neighbours of a node, then
    smaller ones, to its least neighbour, until no edge changes; every
    round is stored. Rows of a node with many neighbours are aggregated before
    they are shuffled, and the join that follows may be split.
    """
    down = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = cut_lineage(down.distinct())
    state = None
    while True:
        found = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not found[0] or tuple(found) == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        state = tuple(found)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _to_least(both).filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = cut_lineage(large.distinct())
        small = _to_least(large)
        moved = small.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        now = cut_lineage(moved.unionByName(small.select("a", F.col("least").alias("b"))).distinct())

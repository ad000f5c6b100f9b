"""Connected components of a link table, as Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeload.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links (a long, b long)``; ``root`` is the component's smallest node.

    Alternating star contraction: every node hands its larger neighbours to its
    smallest one, then its smaller neighbours to the smallest of them, until
    nothing changes; a logarithmic number of rounds. Links at a busy node are
    never gathered: its minimum is a partial aggregate, joined back by a join
    that can be split. Nodes without links are absent. An empty table gives an
    empty one.
    """
    edges = written(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    state = _state(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "large-star")
        lows = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lows, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(moved.union(lows.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        before, state = state, _state(edges)
        if state == before:
            break
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(edges.select("b", "b").distinct())

"""Connected components of a table of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import pinned


_EDGES = 200_000  # of a partition: small tables of links stay in few files


def _star(edges: DataFrame, large: bool, parts: int) -> DataFrame:
    """One star step: the neighbours of a node (larger ones, or smaller ones and itself) are linked to its least neighbour."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
    return pinned(out.filter("a <> b").coalesce(parts).distinct().coalesce(parts))


def _state(edges: DataFrame) -> tuple[int, int]:
    """Number of edges, and of nodes that keep them from being stars: nodes with two parents, or with a parent and a child."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    n, open_ = nodes.agg(F.sum("up"), F.count_if(F.expr("up > 1 or (up = 1 and down = 1)"))).first()
    return n or 0, open_


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of links(a, b): root is the least node of its component.

    The edges are stars, each around its least node, when the steps end. Stars of an earlier call may be part of links.
    """
    edges = pinned(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while (state := _state(edges))[1]:
        parts = state[0] // _EDGES + 1
        edges = _star(_star(edges, True, parts), False, parts)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.text import stored


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Points the larger (or the other) neighbours of every node at its smallest neighbour."""
    least = links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = links.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            least.select("a", F.col("m").alias("b"))
        )
    return out.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node with an edge in (a, b); component is the smallest id reached.

    Edges are rewritten as stars until nothing changes, a number of rounds that grows with the
    logarithm of the longest path. Each round is a shuffle of the edges, written to the
    shared folder; nothing but a checksum comes to the driver.
    """
    edges = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(),
        "edges",
    )
    before = _mark(edges)
    while before[0]:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = stored(_star(_star(both, True), False), "edges")
        after = _mark(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return nodes.unionAll(edges.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()


def extended(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` (id, component) after more links (a, b): only the components that they join are
    rewritten, so the rounds are over new links and not over all of them."""
    comp = lambda name: found.select(F.col("id").alias(name), F.col("component").alias("c" + name))
    both = links.join(comp("a"), "a", "left").join(comp("b"), "b", "left")
    both = stored(both.select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb")), "mapped")
    joined = components(both.select(F.col("ca").alias("a"), F.col("cb").alias("b")).where("a != b"))
    nodes = found.unionAll(both.select("a", "ca")).unionAll(both.select("b", "cb")).distinct()
    joined = joined.select(F.col("id").alias("component"), F.col("component").alias("least"))
    return stored(
        nodes.join(joined, "component", "left").select("id", F.coalesce("least", "component").alias("component")), "found"
    )

"""Connected components of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One star round over edges u > v; both forms keep the components.

    large: every larger neighbour of a node is linked to the node's smallest neighbour (or
    itself); small: so are its smaller neighbours and the node itself. Neither gives more
    rows than it takes, so repeated edges are left in rather than shuffled out."""
    around = edges if small else edges.unionByName(
        edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = staged(around.groupBy("u").agg(F.min("v").alias("m"))
                   .select("u", F.least("u", "m").alias("m")), "star")
    moved = around.filter(F.lit(True) if small else F.col("v") > F.col("u")) \
        .join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if small:
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return staged(moved.filter(F.col("u") != F.col("v"))
                  .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")),
                  "links")


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Every node hangs from at most one node, and none from a node that hangs itself."""
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("up"))
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("up"))
    return roots.unionByName(leaves).groupBy("node") \
        .agg(F.min("up").alias("lo"), F.max("up").alias("hi")) \
        .filter(F.col("lo") != F.col("hi")).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (node, component) of every linked node; the component is its smallest
    node. Self links and repeated links change nothing; rows with a null end are ignored."""
    edges = staged(links.filter(F.col("a") != F.col("b"))
                   .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")),
                   "links")
    while not _is_forest_of_stars(edges):
        edges = _star(_star(edges, False), True)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``found`` (staged) after more (a, b) links between them, whose ends are
    components or nodes without one. Only these links go through the star rounds."""
    moved = staged(components(links), "joined")
    to = moved.select(F.col("node").alias("component"), F.col("component").alias("_to"))
    alone = moved.join(found.select("node"), "node", "left_anti")
    return found.join(to, "component", "left").select(
        "node", F.coalesce("_to", "component").alias("component")).unionByName(alone)

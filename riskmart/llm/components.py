"""Connected components of a link table by alternating stars; links never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialise


def _canonical(links: DataFrame) -> DataFrame:
    """Each link once, larger end first."""
    return links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour of a node moves to the node's smallest neighbour; small star: the smaller ones do.

    The smallest neighbours are written first, so that the join has a plain exchange on both sides and a node with very
    many links is split by the skew-join rule.
    """
    sides = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    smallest = materialise(sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "stars")
    joined = sides.join(smallest, "u")
    if large:
        return _canonical(joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
    kept = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        smallest.select("u", F.col("m").alias("v"))
    )
    return _canonical(kept)


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node that has a link to another one; root is the smallest node that can be reached.

    Every round writes its links to the shared folder, so a lost executor costs one round at most. The rounds end when a
    round leaves the links as they were: then each node is linked to its root and to nothing else. Links to null and
    links of a node with itself are left out.
    """
    links = materialise(
        _canonical(links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL")), "links"
    )
    state = None
    while True:
        links = materialise(_star(materialise(_star(links, True), "links"), False), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

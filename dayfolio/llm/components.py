"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfolio.session import cut_lineage


#: Links in a file of a round.
_ROWS = 20_000


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes with a link; the component is its smallest node.

    ``links`` has the columns a and b. Alternates two steps until nothing
    changes: every node hands its larger neighbours its smallest neighbour, then
    its smaller ones. Minima are combined before they move, so a node with very
    many links is no task of its own; the number of rounds grows with the
    logarithm of the longest chain.
    """
    edges = cut_lineage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("_m"))
        edges = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b")).filter("a <> b")
        least = edges.groupBy("a").agg(F.min("b").alias("_m"))
        edges = edges.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("_m").alias("b")), F.struct(F.col("b").alias("a"), F.col("_m").alias("b")))).alias("e"))
        edges = edges.select("e.a", "e.b").filter("a <> b").distinct()
        edges = cut_lineage(edges.coalesce(before[0] // _ROWS + 1) if before else edges)  # few links need few files
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = edges.groupBy("a").agg(F.min("b").alias("component"))
    return stars.select(F.col("a").alias("node"), "component").unionByName(stars.select(F.col("component").alias("node"), "component").distinct())

"""Connected components of links between ids, by alternating stars (Kiveris et al., 2014).

Every round is two aggregations and two joins over the links left; a path gets
shorter by a constant factor in each. Rounds are written to the shared folder,
so none is repeated, and only two numbers of each come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnsilver.llm.shared import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    moved = both.filter("v > u").join(least, "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, name: str = "stars") -> DataFrame:
    """(node, component) of all ids in ``links`` (a, b): the smallest id reachable.

    Links to oneself and links with a null end are left out, repeated ones
    count once; an empty table gives an empty table.
    """
    stars = links.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct()
    before = None
    while True:
        stars = stored(_small_star(_large_star(stars)), name)
        seen = stars.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if seen == before:
            break
        before = seen
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        stars.select("v", "v").distinct()
    )

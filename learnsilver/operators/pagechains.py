"""Chains of landed pages: is every page there that another one says comes next?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnsilver.session import scratch_path

MISSING, ENDLESS = "missing", "endless"


def page_gaps(links: DataFrame) -> DataFrame:
    """(address, more, problem) of pages whose chain does not come to a last page by itself.

    ``links`` (address, more) are those of ``page_links``. ``missing``: the
    page it names was not landed. ``endless``: following the names from here
    leads round in a circle for ever. Pages before a missing one are not
    reported, only the page that names it. A page landed more than once, with
    several successors, is reported for each that is missing, and followed to
    the largest. Rows without address are no pages.
    """
    known = links.filter("address IS NOT NULL").distinct()
    there = known.select(F.col("address").alias("more")).distinct()
    missing = known.filter("more IS NOT NULL").join(there, "more", "left_anti")
    found = missing.select("address", "more", F.lit(MISSING).alias("problem"))
    endless = _endless(known).join(known, "address").select("address", "more", F.lit(ENDLESS).alias("problem"))
    return found.union(endless)


def _endless(links: DataFrame) -> DataFrame:
    """(address) of the pages that no number of steps leads out of the chains.

    Steps double: each round leaves the pages whose chains go on for twice as
    many steps, each with the page that far ahead. A chain that ends and is
    long enough for a round has a page that the round loses; so when a round
    loses none, no chain that is left ends.
    """
    spark = links.sparkSession
    ahead, before = links.groupBy("address").agg(F.max("more").alias("at")).filter("at IS NOT NULL"), None
    while True:
        path = scratch_path(spark, "page_chains")
        ahead.write.parquet(path)
        ahead = spark.read.schema("address string, at string").parquet(path)
        left = ahead.count()
        if not left or left == before:
            return ahead.select("address")
        before = left
        onward = ahead.select(F.col("address").alias("at"), F.col("at").alias("next"))
        ahead = ahead.join(onward, "at").select("address", F.col("next").alias("at"))

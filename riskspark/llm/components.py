"""Connected components over a table of links, by alternating star contraction.

Each node links to the smallest neighbour it knows until every component
is a star around its smallest node. All steps are joins and minima over the
link table; nothing is collected, no group is gathered. Each round is
written to the shared checkpoint folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import Scratch


def _larger_star(links: DataFrame) -> DataFrame:
    """Every neighbour larger than u moves to the smallest node of u's neighbourhood."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _smaller_star(links: DataFrame) -> DataFrame:
    """u and its smaller neighbours move to the smallest of them. Links run from the larger node a to the smaller b."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def _sign(links: DataFrame):
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root): for every node with a link, the smallest node it reaches (roots themselves left out).

    ``links``: two columns of longs, in any direction, repeats allowed.
    """
    a, b = links.columns
    links = scratch.save(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a != b").distinct(), "links-0")
    before, turn = _sign(links), 0
    while before[0]:
        turn += 1
        links = scratch.save(_smaller_star(_larger_star(links)), f"links-{turn}")
        scratch.drop(f"links-{turn - 1}")
        now = _sign(links)
        if now == before:
            break
        before = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))

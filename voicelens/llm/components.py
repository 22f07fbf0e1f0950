"""Connected components of a link table, by alternating large-star and small-star rounds.

Every round is two aggregations and two joins on the link table and is written
to the shared folder, so a lost executor repeats one round at most; nothing is
collected but two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written


def _large_star(links: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to its smallest neighbour (or itself)."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(least, "u").where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours and itself to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for each node of a link, component = smallest node reachable.

    Self links and repeated links are harmless; an empty table gives no rows.
    """
    a, b = F.col(a), F.col(b)
    links = written(links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    before = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        links = written(_small_star(_large_star(links)), "links")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct()

"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywatch.llm.common import stage


def _links(df: DataFrame) -> DataFrame:
    return df.where(F.col("a") > F.col("b")).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
    return _links(both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(least, "a")
    return _links(joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))))


def components(links: DataFrame) -> DataFrame:
    """(node, root): every linked node that is not its component's smallest one, with that one.

    `links` holds pairs (a, b) of long ids, a > b. Each round is stored, so a lost executor costs one round;
    minima are aggregated before the shuffle and joined back, so a node with many links is not one task.
    """
    links = stage(_links(links), "links")
    state = None
    while True:
        now = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
        if tuple(now) == state or not now["n"]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = tuple(now)
        links = stage(_small_star(_large_star(links)), "links")

"""Connected components of a link table, by alternating star rounds in Spark.

Each round hangs the neighbours of every node on the smallest one known: first
those above a node (large star), then those below it (small star). Links only
ever move to smaller ends, so the rounds end with a star per component, after
about as many rounds as the logarithm of the longest chain. Every round is
written to the shared folder; nothing but two sums comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calepin.llm.common import stored


def large_star(links: DataFrame) -> DataFrame:
    """links (low, high), low < high: hang what is above a node on its smallest."""
    both = links.select(F.col("high").alias("node"), F.col("low").alias("near")).union(
        links.select(F.col("low").alias("node"), F.col("high").alias("near"))
    )
    least = both.groupBy("node").agg(F.min("near").alias("least")).select(
        "node", F.least("node", "least").alias("least")
    )
    return (
        links.join(least, links["low"] == least["node"])
        .select(F.col("least").alias("low"), "high")
        .where("low < high")
    )


def small_star(links: DataFrame) -> DataFrame:
    """Hang a node and all below it on the smallest of them."""
    least = links.groupBy("high").agg(F.min("low").alias("least"))
    joined = links.join(least, "high")
    return (
        joined.select(F.col("least").alias("low"), F.col("low").alias("high"))
        .where("low < high")
        .union(least.select(F.col("least").alias("low"), "high"))
    )


def components(links: DataFrame, folder: str, name: str) -> DataFrame:
    """node, component: the smallest node that each linked node can reach."""
    now = stored(
        links.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
        .where("low < high")
        .distinct(),
        folder,
        f"{name}-0",
    )
    before, round_ = None, 0
    while True:
        state = now.agg(
            F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before, round_ = state, round_ + 1
        now = stored(small_star(large_star(now)).distinct(), folder, f"{name}-{round_}")
    return now.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
        now.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    )

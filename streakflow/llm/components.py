"""Connected components of a link table, by alternating star steps.

Each step is an equi-join of the links with one minimum per node (a partial
aggregate, so a hub costs one row a task before the shuffle), and every step's
links are written to the shared folder. No group of neighbours is ever collected."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from streakflow.llm.common import cut


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    near = down.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.unionByName(low.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, root): every node of the links (columns a, b) with the smallest node of
    its component. The number of rounds grows with the logarithm of the longest path."""
    now = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        now = cut(_small_star(_large_star(now).where("a <> b")).where("a <> b").distinct())
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)

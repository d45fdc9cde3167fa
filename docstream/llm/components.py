"""Connected components of a table of links, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstream.llm.dealing import saved

#: Shuffle partitions that share a file: they are counted for texts, and a link has two numbers.
PARTITIONS = 8


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b: long) that is not the smallest of its component.

    Each step is saved, so lineage stays short; links and components stay in tables. Links that are null or lead
    to their own start say nothing.
    """
    spark = links.sparkSession
    few = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // PARTITIONS)
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = saved(pairs.filter("a > b").distinct().coalesce(few), "links")
    mark = None
    while True:
        now = saved(_small_star(_large_star(now)).coalesce(few), "links")
        told = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if told == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = told

"""Connected components by alternating large-star and small-star rounds, each a pair of aggregations and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.shared import drop_path, new_path, write


def _large(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    # repeated links are dropped by the small-star step that follows
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").unionByName(
        least.select("a", F.col("m").alias("b"))
    ).distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b) links of an orderable type -> (node, label), label the least node reachable.

    Only nodes with a link to another node are returned; null ends and loops are ignored, repeated links are harmless.
    Every round goes to the shared folder; the number of rounds grows with the logarithm of the longest path.
    """
    spark = links.sparkSession
    path = new_path(spark, "links")
    e = write(links.select("a", "b").where("a <> b").distinct(), path)
    mark = None
    while True:
        nxt = new_path(spark, "links")
        e = write(_small(_large(e)), nxt)
        drop_path(spark, path)
        path = nxt
        now = e.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == mark:
            return e.select(F.col("a").alias("node"), F.col("b").alias("label"))
        mark = now

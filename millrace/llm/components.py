"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.session import drop_path, scratch, scratch_path, stable


def _mark(links: DataFrame):
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("low", "high"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``; the root is the smallest node of its component.

    Each round lets every node hand its larger neighbours, then its smaller ones, to the
    smallest neighbour; the number of rounds grows with the logarithm of the longest path.
    Links and minima are written tables, so each join is between two plain shuffles (or
    broadcasts what is measured as small), and AQE splits a hub that holds many links over
    tasks.  A round's tables are deleted once the next one's links are written.
    """
    spark = links.sparkSession

    def links_at():
        return scratch_path(spark, "links")

    path = links_at()
    now = stable(links.filter("a <> b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct(), path)
    mark = _mark(now)
    while mark[0]:
        after = links_at()
        with scratch(spark):
            both = now.select(F.col("low").alias("u"), F.col("high").alias("v")).union(now.select(F.col("high").alias("u"), F.col("low").alias("v")))
            least = stable(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
            large = stable(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
            least = stable(large.groupBy("u").agg(F.min("v").alias("m")))
            small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("high"), F.col("m").alias("low"))
            small = small.union(least.select(F.col("u").alias("high"), F.col("m").alias("low")))
            now = stable(small.select("low", "high").distinct(), after)
        drop_path(spark, path)
        path = after
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("high").alias("node"), F.col("low").alias("root")).union(
        now.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct())

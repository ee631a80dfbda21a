"""Counts and summaries of tables."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from millrace.session import stable


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, null_count, filled_count), all columns in a single aggregation."""
    counted = df.agg(*[
        F.struct(
            F.count_if(F.col(c).isNull()).alias("null_count"), F.count(F.col(c)).alias("filled_count")
        ).alias(c) for c in df.columns
    ])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`.null_count"), F.col(f"`{c}`.filled_count"))
        for c in df.columns
    ])
    return counted.select(F.inline(rows))


def quantiles(df: DataFrame, column: str, probs: list[float]) -> DataFrame:
    """(prob, value): exact quantiles, interpolated between neighbours.

    Equal values are counted first, so a value that most rows share is one row from
    there on; distinct values are sorted by range and their counts summed up along it.
    Then only the two neighbours of each quantile are looked at.
    """
    counts = df.select(F.col(column).cast("double").alias("value")).filter("value is not null").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    ranged = stable(counts.repartitionByRange("value").withColumn("part", F.spark_partition_id()))
    # One row per range; within a range only its own distinct values are summed.
    sums = ranged.groupBy("part").agg(F.sum("n").alias("size"))
    ahead = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("part", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("offset"))
    inside = W.partitionBy("part").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    placed = ranged.withColumn("upto", F.sum("n").over(inside)).join(F.broadcast(offsets), "part")
    placed = placed.select("value", "n", (F.col("offset") + F.col("upto")).alias("last"))
    n = ranged.agg(F.sum("n")).first()[0] or 0
    picks = []
    for prob in probs:
        exact = (n - 1) * prob
        low = math.floor(exact)
        picks += [(prob, low + 1, 1 - (exact - low)), (prob, min(low + 2, n), exact - low)]
    # A handful of ranks, held in the expression: a map over the distinct values.
    wanted = F.array(*[F.struct(F.lit(p).alias("prob"), F.lit(at).alias("at"), F.lit(share).alias("share")) for p, at, share in picks])
    here = F.filter(wanted, lambda w: (w["at"] <= F.col("last")) & (w["at"] > F.col("last") - F.col("n")))
    near = placed.select("value", F.inline(here))
    return near.groupBy("prob").agg(F.sum(F.col("value") * F.col("share")).alias("value"))


def summary(df: DataFrame, columns: list[str], quartiles: bool = True) -> DataFrame:
    """count, mean, stddev, min, max and (exact) quartiles of numeric columns, one row each."""
    stats = df.agg(*[
        F.struct(
            F.count(c).alias("count"), F.avg(F.col(c).cast("double")).alias("mean"),
            F.stddev(F.col(c).cast("double")).alias("stddev"),
            F.min(F.col(c).cast("double")).alias("min"), F.max(F.col(c).cast("double")).alias("max"),
        ).alias(c) for c in columns
    ])
    flat = [
        F.struct(
            F.lit(c).alias("column_name"),
            *[F.col(f"`{c}`.{s}").alias(s) for s in ("count", "mean", "stddev", "min", "max")],
        ) for c in columns
    ]
    rows = stats.select(F.inline(F.array(*flat)))
    if not quartiles:
        return rows
    at = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    parts = [
        quantiles(df, c, list(at.values())).groupBy(F.lit(c).alias("column_name")).agg(*[
            F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name) for name, p in at.items()
        ]) for c in columns
    ]
    return rows.join(reduce(DataFrame.unionByName, parts), "column_name", "left")


def composition(hits: DataFrame, by: list[str]) -> DataFrame:
    """How many rows each category (or code) contributes."""
    return hits.groupBy(*by).agg(F.count(F.lit(1)).alias("docs"))

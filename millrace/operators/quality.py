"""Checks of the constraints the star schema declares."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once or are NULL, with their count."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | missing)


def key_report(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Per table: rows, keys that repeat, rows whose key is NULL."""
    reports = []
    for name, (df, keys) in tables.items():
        missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        reports.append(per_key.select(
            F.lit(name).alias("table_name"), F.col("n"), (F.col("n") > 1).alias("dup"), missing.alias("missing"),
        ).groupBy("table_name").agg(
            F.sum("n").alias("row_count"),
            F.count_if("dup").alias("repeated_keys"),
            F.coalesce(F.sum(F.when(F.col("missing"), F.col("n"))), F.lit(0)).alias("null_keys"),
        ))
    return reduce(DataFrame.unionByName, reports)


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose key is filled but not in the dimension.

    The anti join runs over the distinct keys, so a hot key is one row in it.
    """
    keys = fact.filter(F.col(fact_key).isNotNull()).groupBy(fact_key).agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(F.col(dim_key).alias("_k"))
    return keys.join(known, F.col(fact_key) == F.col("_k"), "left_anti")


def bad_domain(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Rows whose value is outside the declared list; NULL is no violation."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(allowed))


def families_filled(families: dict[str, list[str]]) -> Column:
    """How many key families have at least one column filled."""
    filled = [
        F.when(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols]), 1).otherwise(0)
        for cols in families.values()
    ]
    return reduce(lambda a, b: a + b, filled)


def key_family_violations(fact: DataFrame, families: dict[str, list[str]]) -> DataFrame:
    """Fact rows that do not belong to exactly one key family."""
    return fact.filter(families_filled(families) != 1)

"""Row-level shaping: deterministic dedupe, first-of-key, quotas, lag, padding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T


def dedupe(df: DataFrame, keys: list[str], order: list[Column] = ()) -> DataFrame:
    """One row per key: the first by ``order``, then by all other columns.

    The order is total, so the survivor does not depend on partitioning.  Spark
    limits each map task to one row per key before the shuffle (WindowGroupLimit),
    so a key that holds most of the rows still reaches its reducer as few rows.
    """
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    window = W.partitionBy(*keys).orderBy(*order, *(rest or [F.lit(1)]))
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row of each key in the given order."""
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def top_per_key(
    df: DataFrame, keys: list[str], order: list[Column], limit, rank: str = "rank", salts: int = 0,
    most: int | None = None,
) -> DataFrame:
    """The first ``limit`` rows of each key, numbered from 1.

    ``limit`` is an int or the name of a column that is constant within a key.  With
    ``salts`` the rows of a key are first cut in that many independent parts, so a
    key that holds very many rows is never ranked by a single task.  ``most`` says that no
    limit of the column is larger: then every map task passes on at most so many rows of a
    key (a limit that differs per key alone cannot be applied before the shuffle).
    """
    bound = F.lit(limit) if isinstance(limit, int) else F.col(limit) if most is None else F.least(F.col(limit), F.lit(most))

    def kept(name: str) -> Column:
        within = F.col(name) <= bound
        return within if most is None else within & (F.col(name) <= F.lit(most))

    if salts > 1:
        part = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        window = W.partitionBy(*keys, "_salt").orderBy(*order)
        df = part.withColumn("_rn", F.row_number().over(window)).filter(kept("_rn"))
        df = df.drop("_rn", "_salt")
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(kept(rank))


def year_over_year(df: DataFrame, keys: list[str], year: str, values: list[str]) -> DataFrame:
    """Each row next to the one of the year before; rows without one are dropped.

    Needs one row per key and year.  One shuffle on the keys, no self-join.
    """
    window = W.partitionBy(*keys).orderBy(year)
    lagged = {f"prev_{c}": F.lag(c).over(window) for c in [year, *values]}
    return df.withColumns(lagged).filter(F.col(year) == F.col(f"prev_{year}") + 1)


def year_over_year_pairs(df: DataFrame, keys: list[str], year: str, values: list[str]) -> DataFrame:
    """As ``year_over_year`` for data with several rows per year: every pairing."""
    prev = df.select(
        *keys,
        F.col(year).alias(f"prev_{year}"),
        (F.col(year) + 1).alias(year),
        *[F.col(c).alias(f"prev_{c}") for c in values],
    )
    return df.join(prev, [*keys, year], "inner")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, cast to its types; missing ones become typed NULLs."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def stack(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name; columns a side lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def stack_distinct(*dfs: DataFrame) -> DataFrame:
    """UNION by column name: one distinct over everything, not one per side."""
    return reduce(lambda a, b: a.unionByName(b), dfs).distinct()

"""Joins against lookup tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_lookup(
    df: DataFrame, key: Column, lookup: DataFrame, lookup_key: str, value: str, out: str,
    default: Column | str | None = None,
) -> DataFrame:
    """Add ``out`` = the lookup's ``value`` for ``key``, else ``default``.

    ``default`` may be a literal or a column (pass-through of the key, say).
    """
    look = lookup.select(F.col(lookup_key).alias("_lk"), F.col(value).alias("_lv"))
    joined = df.withColumn("_key", key).join(look, F.col("_key") == F.col("_lk"), "left")
    found = F.col("_lv")
    if default is not None:
        found = F.coalesce(found, default if isinstance(default, Column) else F.lit(default))
    return joined.withColumn(out, found).drop("_key", "_lk", "_lv")


def expand_codes(
    df: DataFrame, id_col: str, keywords_col: str, lookup: DataFrame, distinct: bool = True
) -> DataFrame:
    """(id, position, code): the codes of an array of keywords, in keyword order.

    Unknown keywords give nothing.  With ``distinct`` each code keeps its first place.
    The position holds the keyword's place in its upper 32 bits and the code's in the lower.
    """
    look = lookup.select(F.col("keyword").alias("_kw"), F.col("codes").alias("_codes"))
    words = df.select(id_col, F.posexplode(keywords_col).alias("_kpos", "_word"))
    hits = words.join(look, F.lower(F.trim("_word")) == F.col("_kw"))
    codes = hits.select(id_col, "_kpos", F.posexplode("_codes").alias("_cpos", "code"))
    place = (F.shiftleft(F.col("_kpos").cast("bigint"), 32) + F.col("_cpos")).alias("position")
    placed = codes.select(id_col, place, "code")
    if distinct:
        placed = placed.groupBy(id_col, "code").agg(F.min("position").alias("position"))
    return placed.select(id_col, "position", "code")

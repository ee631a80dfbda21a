"""What to land, and how raw shapes become bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.dates import parse_day
from millrace.operators.lookup import with_lookup

# The fields of an envelope's bar and the columns they become.
BAR_NAMES = {"t": "date", "h": "high", "l": "low", "c": "last", "v": "volume"}


def explode_bars(envelopes: DataFrame) -> DataFrame:
    """One row per bar of envelopes of the declared schema, whose types it keeps.

    Pages of a symbol need no merging: each unfolds on its own.
    """
    whose = [c for c in envelopes.columns if c in ("source_file", "ingestion_timestamp")]
    unfolded = envelopes.select("symbol", F.inline("bars"), "type", *whose)
    return unfolded.withColumnsRenamed(BAR_NAMES).withColumn("date", F.left("date", F.lit(10))).select("symbol", *BAR_NAMES.values(), "type", *whose)


def merge_pages(envelopes: DataFrame) -> DataFrame:
    """Bars of all pages with the type each symbol is known by.

    Pages without a type take that of a sibling page, else the one its symbol implies.
    The bars of a symbol are never gathered in one row.
    """
    known = envelopes.groupBy("symbol").agg(F.max("type").alias("_type"))
    implied = F.when(F.col("symbol").contains("/"), "CRYPTO").otherwise("STOCK")
    return (
        explode_bars(envelopes)
        .join(known, "symbol", "left")
        .withColumn("type", F.coalesce("type", "_type", implied))
        .drop("_type")
    )


def day_slice(bars: DataFrame, as_of: Column, lag_days: dict[str, int], date: str = "date_parsed") -> DataFrame:
    """The newest complete day per asset type: ``as_of`` minus the type's lag."""
    wanted = F.lit(None).cast("date")
    for kind, days in lag_days.items():
        wanted = F.when(F.col("type") == kind, F.date_sub(as_of, days)).otherwise(wanted)
    return bars.filter(F.col(date) == wanted)


def not_yet_landed(wanted: DataFrame, landed: DataFrame, key: str = "symbol") -> DataFrame:
    """Wanted rows whose key has not been landed."""
    return wanted.join(landed.select(key).distinct(), key, "left_anti")


def map_codes(df: DataFrame, col: str, lookup: DataFrame, lookup_key: str = "code", value: str = "symbol") -> DataFrame:
    """Translate codes, unknown ones pass through."""
    return with_lookup(df, F.col(col), lookup, lookup_key, value, value, default=F.col(col))


def crypto_rows(raw: DataFrame, codes: DataFrame) -> DataFrame:
    """Rows of the crypto CSV in the bar layout; volume is truncated to whole units."""
    return map_codes(raw, "code", codes).select(
        "symbol",
        F.col("date").cast("string").alias("date"),
        F.col("high").cast("double").alias("high"),
        F.col("low").cast("double").alias("low"),
        F.col("last").cast("double").alias("last"),
        F.col("volume").cast("long").alias("volume"),
        F.lit("CRYPTO").alias("type"),
    )


def with_day(bars: DataFrame) -> DataFrame:
    """Parse the text date; unparseable dates give NULL."""
    day = parse_day(F.col("date"))
    return bars.withColumns({"date_parsed": day, "year": F.year(day)})

"""Raw tables to clean ones.

Bad rows are filtered before duplicates are removed, so a bad duplicate can never
win over a good row; of several good ones the newest ingestion wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace import lookups
from millrace.functions.dates import parse_day
from millrace.operators.rows import dedupe
from millrace.operators.sized import if_small


def _newest(df: DataFrame, order_by: str | None):
    return [F.col(order_by).desc_nulls_last()] if order_by else []


def processed(df: DataFrame, at: Column | None = None) -> DataFrame:
    """The clean table as it is stored: with the time of the job, ``processed_timestamp``, the same in every row."""
    return df.withColumn("processed_timestamp", F.current_timestamp() if at is None else at)


def clean_metadata(meta: DataFrame, newest: str | None = None) -> DataFrame:
    named = meta.filter(F.col("series_id").isNotNull() & F.col("name").isNotNull())
    return dedupe(named, ["series_id"], _newest(named, newest))


def clean_indicators(data: DataFrame, meta: DataFrame, newest: str | None = None) -> DataFrame:
    """One row per series, country and year, with the series' name and description."""
    typed = (
        data.filter(F.col("value").isNotNull() & F.col("year").isNotNull() & F.col("series_id").isNotNull())
        .withColumns({
            "value": F.expr("try_cast(value as decimal(30,10))"),
            "year": F.expr("try_cast(year as int)"),
        })
        .filter(F.col("value").isNotNull() & F.col("year").isNotNull())
    )
    unique = dedupe(typed, ["series_id", "country_code", "year"], _newest(typed, newest))
    names = clean_metadata(meta).select(
        "series_id", F.col("name").alias("indicator_name"), F.col("description").alias("indicator_description")
    )
    # The metadata is unique by series, so the join cannot bring duplicates back.
    return unique.join(names, "series_id", "left").select(
        "series_id", "country_code", "country_name", "year", "value", "indicator_name", "indicator_description"
    )


def clean_regions(regions: DataFrame) -> DataFrame:
    usable = regions.filter(F.col("region").isNotNull() & F.col("region_type").isNotNull())
    return dedupe(usable, ["region_id"])


def clean_housing(
    data: DataFrame, indicators: DataFrame, regions: DataFrame,
    codes: list[str] | None = None, since: str = lookups.HOUSING_SINCE,
) -> DataFrame:
    """Housing figures of the wanted indicators, with indicator name and region path."""
    wanted = codes if codes is not None else lookups.WANTED_HOUSING.split()
    kept = data.filter(
        F.col("region_id").isNotNull() & F.col("date").isNotNull() & F.col("value").isNotNull()
        & F.col("indicator_id").isin(wanted) & (F.col("date") >= F.lit(since).cast("date"))
    ).withColumn("value", F.col("value").cast("decimal(30,10)"))
    names = dedupe(indicators.filter(F.col("indicator").isNotNull()), ["indicator_id"])
    # Few as a rule: dealt by indicator, the figures would meet in as many tasks as there are indicators.
    return (
        kept.join(if_small(names.select("indicator_id", "indicator")), "indicator_id", "left")
        .join(clean_regions(regions).select("region_id", "region_type", "region"), "region_id", "left")
        .select("indicator_id", "region_id", "date", "value", "indicator", "region_type", "region")
    )


def clean_bars(bars: DataFrame, symbols: list[str] | None = None, newest: str | None = None) -> DataFrame:
    """One usable bar per symbol and date, from any number of appended loads."""
    wanted = symbols if symbols is not None else lookups.WANTED_SYMBOLS.split()
    day = parse_day(F.col("date"))
    implied = F.when(F.col("symbol").contains("/"), "CRYPTO").otherwise("STOCK")
    good = bars.filter(F.col("last").isNotNull() & (F.col("volume") > 0) & F.col("symbol").isin(wanted))
    return (
        dedupe(good, ["symbol", "date"], _newest(good, newest))
        .withColumns({"date_parsed": day, "year": F.year(day), "type": F.coalesce("type", implied)})
    )

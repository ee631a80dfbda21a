"""Serving queries over the published star schema.

Parameters are bound as typed literals.  Year ranges are also put on the fact
table's partition column, so other years are not read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from millrace import lookups
from millrace.plans.metrics import state_month


def _years(fact: DataFrame, first: int | None, last: int | None) -> DataFrame:
    if "year" in fact.columns and first is not None:
        fact = fact.filter(F.col("year").between(first, last))
    return fact.drop("year")


def _year_of(day) -> int:
    return day.year if isinstance(day, dt.date) else int(str(day)[:4])


def asset_prices(star: dict[str, DataFrame], asset: str | None = None, start=None, end=None) -> DataFrame:
    """Daily prices: fact x asset x time x value, of all assets or one, for all days or a range."""
    fact = star["fact_value"].filter(F.col("cryptostock_value_key").isNotNull())
    values = star["dim_cryptostock_value"]
    # The value table repeats symbol and date, so the same condition cuts its scan too.
    wide = {"symbol", "date_parsed"} <= set(values.columns)
    if asset is not None:
        fact = fact.filter(F.col("asset_key") == F.lit(asset))
        values = values.filter(F.col("symbol") == F.lit(asset)) if wide else values
    if start is not None:
        first, last = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
        fact = _years(fact, _year_of(start), _year_of(end)).filter(F.col("date_key").between(first, last))
        values = values.filter(F.col("date_parsed").between(first, last)) if wide else values
    values = values.select("cryptostock_value_key", "high", "low", "close", "volume")
    return (
        fact.select("cryptostock_value_key", "date_key", "asset_key")
        .join(star["dim_asset"], "asset_key")
        .join(star["dim_time"].select("date_key", "year", "month_number"), "date_key")
        .join(values, "cryptostock_value_key")
        .select(
            "asset_key", "type", F.col("date_key").alias("date"), "year", "month_number",
            "high", "low", "close", "volume",
        )
    )


def asset_daily(star: dict[str, DataFrame], asset: str, start, end) -> DataFrame:
    """Prices of one asset between two dates, inclusive."""
    return asset_prices(star, asset, start, end).select(
        "date", F.col("asset_key").alias("ticker"), F.col("type").alias("asset_type"),
        F.col("close").alias("close_price"), F.col("high").alias("high_price"),
        F.col("low").alias("low_price"), "volume",
    ).orderBy("date")


def indicator_figures(star: dict[str, DataFrame], where: Column | None = None, years=(None, None)) -> DataFrame:
    """Economic figures with their names: fact x indicator x country x time x value."""
    fact = _years(star["fact_value"], *years).filter(F.col("socioeconomical_indicator_key").isNotNull())
    if where is not None:
        fact = fact.filter(where)
    names = star["dim_socioeconomical_indicator"].select(
        "socioeconomical_indicator_key", F.col("name").alias("indicator_name"),
        F.col("description").alias("indicator_description"),
    )
    return (
        fact.select("socioeconomical_indicator_key", "country_key", "date_key", "value_key")
        .join(names, "socioeconomical_indicator_key")
        .join(star["dim_country"], "country_key")
        .join(star["dim_time"].select("date_key", "year"), "date_key")
        .join(star["dim_value"], "value_key")
        .select(
            F.col("socioeconomical_indicator_key").alias("series_id"), "indicator_name",
            "indicator_description", "country_code", "country_name", "year", "value", "unit",
        )
    )


def housing_figures(star: dict[str, DataFrame], where: Column | None = None, years=(None, None)) -> DataFrame:
    """Housing figures with place and indicator: fact x indicator x region x country x time x value."""
    fact = _years(star["fact_value"], *years).filter(F.col("realestate_indicator_key").isNotNull())
    if where is not None:
        fact = fact.filter(where)
    return (
        fact.select("realestate_indicator_key", "region_key", "date_key", "value_key")
        .join(star["dim_realestate_indicator"], "realestate_indicator_key")
        .join(star["dim_region"], "region_key")
        .join(star["dim_country"], "country_key")
        .join(star["dim_time"], "date_key")
        .join(star["dim_value"], "value_key")
    )


def cpi(
    star: dict[str, DataFrame], first_year: int, last_year: int,
    series: str = lookups.CPI_SERIES, country: str = lookups.DEFAULT_COUNTRY[0],
) -> DataFrame:
    """A price index of one country per year; both ends inclusive."""
    figures = indicator_figures(
        star, F.col("socioeconomical_indicator_key") == F.lit(series), (first_year, last_year)
    )
    return (
        figures.filter((F.col("country_code") == F.lit(country)) & F.col("year").between(first_year, last_year))
        .select("year", F.col("value").alias("cpi_value"), "unit")
        .distinct()
        .orderBy("year")
    )


def inflation_adjusted(
    star: dict[str, DataFrame], asset: str, start, end, base_cpi: float = lookups.BASE_CPI,
    series: str = lookups.CPI_SERIES, country: str = lookups.DEFAULT_COUNTRY[0],
) -> DataFrame:
    """Prices in money of the base year; days of a year without an index are dropped."""
    asset = dict(lookups.pairs(lookups.TICKER_ALIASES)).get(asset, asset)
    index = cpi(star, _year_of(start), _year_of(end), series, country).select(
        F.col("year").alias("cpi_year"), F.lit(base_cpi) / F.col("cpi_value").cast("double")
    ).toDF("cpi_year", "factor")
    scaled = {
        c: F.col(c).cast("double") * F.col("factor") for c in ("close_price", "high_price", "low_price")
    }
    return (
        asset_daily(star, asset, start, end)
        .join(index, F.year("date") == F.col("cpi_year"))
        .withColumns(scaled)
        .select("date", "ticker", "asset_type", "close_price", "high_price", "low_price", "volume")
        .orderBy("date")
    )


def housing_monthly(star: dict[str, DataFrame], year: int, state: str) -> DataFrame:
    """Monthly statistics of one state and year per indicator, newest month first."""
    return state_month(housing_figures(star, years=(year, year)), year, state).orderBy(
        F.desc("month_number"), "realestate_indicator_key"
    )


def housing_series(star: dict[str, DataFrame], year: int, state: str) -> DataFrame:
    """One row per indicator with its months as an ordered list (at most 12)."""
    month = F.struct(
        "month_number", "month_name", "avg_value", "min_value", "max_value", "stddev_value",
        "data_points", "unit",
    )
    return (
        state_month(housing_figures(star, years=(year, year)), year, state)
        .groupBy(
            F.col("state_name").alias("state"), "year", "indicator_name",
            F.col("realestate_indicator_key").alias("indicator_id"),
        )
        .agg(F.sort_array(F.collect_list(month), asc=False).alias("series"))
    )

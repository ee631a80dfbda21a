"""Aggregates and trends over prices, indicators and housing figures.

Price functions take ``prices``: asset_key, type, date, year, month_number, high,
low, close, volume - from ``prices.asset_prices`` or straight from clean bars.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.rows import top_per_key, year_over_year


def mean(name: str) -> Column:
    """Average in double.  Sums of decimals stay exact up to the final division."""
    return F.sum(name).cast("double") / F.count(name)


def prices_of_bars(bars: DataFrame) -> DataFrame:
    return bars.select(
        F.col("symbol").alias("asset_key"), "type", F.col("date_parsed").alias("date"),
        F.year("date_parsed").alias("year"), F.month("date_parsed").alias("month_number"),
        "high", "low", F.col("last").alias("close"), "volume",
    )


def asset_month(prices: DataFrame) -> DataFrame:
    return prices.groupBy("asset_key", "year", "month_number").agg(
        mean("close").alias("avg_price"),
        F.min("low").alias("min_price"),
        F.max("high").alias("max_price"),
        mean("volume").alias("avg_volume"),
        F.count(F.lit(1)).alias("trading_days"),
    )


def asset_year(prices: DataFrame, min_days: int = 2) -> DataFrame:
    """Yearly figures per asset.

    ``min_close``/``max_close`` are the extremes of the year; ``first_close`` and
    ``last_close`` are the prices of its first and last day.
    """
    return prices.groupBy("asset_key", "year").agg(
        F.min("close").alias("min_close"),
        F.max("close").alias("max_close"),
        F.min_by("close", "date").alias("first_close"),
        F.max_by("close", "date").alias("last_close"),
        F.min("low").alias("year_low"),
        F.max("high").alias("year_high"),
        mean("close").alias("avg_price"),
        F.coalesce(F.stddev(F.col("close").cast("double")), F.lit(0.0)).alias("price_stddev"),
        F.sum("volume").alias("total_volume"),
        mean("volume").alias("avg_volume"),
        F.count(F.lit(1)).alias("trading_days"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    ).filter(F.col("trading_days") >= min_days)


def asset_year_over_year(prices: DataFrame) -> DataFrame:
    """Each year's averages and extremes next to those of the year before."""
    yearly = prices.groupBy("asset_key", "year").agg(
        mean("close").alias("avg_price"),
        F.min("low").alias("min_price"),
        F.max("high").alias("max_price"),
        mean("volume").alias("avg_volume"),
    )
    return year_over_year(yearly, ["asset_key"], "year", ["avg_price", "min_price", "max_price", "avg_volume"])


def asset_lifetime(prices: DataFrame, min_years: int = 3) -> DataFrame:
    """Whole-history figures per asset.

    Built on the yearly aggregate: one shuffle of partial sums, then few rows per
    asset, instead of a distinct count of years over all bars.
    """
    yearly = prices.groupBy("asset_key", "year").agg(
        F.min("close").alias("low"), F.max("high").alias("high"),
        F.sum("close").alias("close_sum"), F.count("close").alias("close_count"),
        F.sum("volume").alias("volume"),
    )
    return yearly.groupBy("asset_key").agg(
        F.min("year").alias("start_year"),
        F.max("year").alias("end_year"),
        F.count(F.lit(1)).alias("num_years"),
        F.min("low").alias("all_time_low"),
        F.max("high").alias("all_time_high"),
        (F.sum("close_sum").cast("double") / F.sum("close_count")).alias("overall_avg_price"),
        F.sum("volume").alias("total_volume"),
    ).filter(F.col("num_years") >= min_years)


def asset_yearly_averages(prices: DataFrame) -> DataFrame:
    """Per asset the ordered list of (year, average close); as long as its years are."""
    yearly = prices.groupBy("asset_key", "year").agg(mean("close").alias("avg_price"))
    return yearly.groupBy("asset_key").agg(
        F.array_sort(F.collect_list(F.struct("year", "avg_price"))).alias("yearly")
    )


def trend(df: DataFrame, keys: list[str], year: str, value: str, min_points: int = 3) -> DataFrame:
    """First and last value by year, change and percent change, number of points.

    Needs one row per key and year for a definite result.
    """
    ends = df.groupBy(*keys).agg(
        F.min(year).alias("start_year"),
        F.max(year).alias("end_year"),
        F.min_by(value, year).alias("start_value"),
        F.max_by(value, year).alias("end_value"),
        F.count(F.lit(1)).alias("points"),
    ).filter(F.col("points") >= min_points)
    change = F.col("end_value").cast("double") - F.col("start_value").cast("double")
    start = F.col("start_value").cast("double")
    return ends.withColumns({
        "change": change,
        "change_pct": F.when(start != 0, change / start * 100).otherwise(F.lit(0.0)),
    })


def _figures() -> list[Column]:
    return [
        mean("value").alias("avg_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.stddev(F.col("value").cast("double")).alias("stddev_value"),
        F.count(F.lit(1)).alias("data_points"),
    ]


_STATE = ["realestate_indicator_key", "indicator_name", "indicator_description", "state_name", "state_code", "year"]


def in_range(figures: DataFrame, first: str | None, last: str | None) -> DataFrame:
    """Figures dated from ``first`` to ``last``; a bound that is None does not cut."""
    if first is not None:
        figures = figures.filter(F.col("date_key") >= F.lit(first).cast("date"))
    if last is not None:
        figures = figures.filter(F.col("date_key") <= F.lit(last).cast("date"))
    return figures


def state_year(figures: DataFrame, first: str | None = None, last: str | None = None, min_points: int = 3) -> DataFrame:
    """Housing figures per indicator, state and year within a range of dates."""
    return (
        in_range(figures, first, last).filter(F.col("state_code").isNotNull())
        .groupBy(*_STATE, "unit").agg(*_figures())
        .filter(F.col("data_points") >= min_points)
    )


def state_month(figures: DataFrame, year: int, state: str, min_points: int = 3) -> DataFrame:
    """Housing figures per indicator and month of one state and year."""
    return (
        figures.filter((F.col("year") == year) & (F.col("state_code") == state))
        .groupBy(*_STATE, "month_number", "month_name", "unit").agg(*_figures())
        .filter(F.col("data_points") >= min_points)
    )


def examples_per(df: DataFrame, keys: list[str], order: list[Column], n: int = 3) -> DataFrame:
    """A few example rows of each kind."""
    return top_per_key(df, keys, order, n, rank="example")

"""Dates without exceptions under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_day(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """The date, or NULL for text that is not one."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def first_of_year(year: Column) -> Column:
    return F.make_date(year, F.lit(1), F.lit(1))


def calendar(date: Column) -> dict[str, Column]:
    """The descriptive columns of a date."""
    return {
        "day_name": F.date_format(date, "EEEE"),
        "week_number": F.weekofyear(date),
        "month_number": F.month(date),
        "month_name": F.date_format(date, "MMMM"),
        "year": F.year(date),
    }

"""Number wording used by the documents.  All of it is built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace import lookups


def fmt(value: Column, places: int = 2, thousands: bool = False) -> Column:
    """Fixed-point text, rounded half-even on the binary value; exact to 15 digits in all."""
    text = F.format_number(value.cast("double"), places)
    return text if thousands else F.replace(text, F.lit(","), F.lit(""))


def magnitude(value: Column) -> Column:
    """``12.00 million`` and so on; below a million, and for negatives, plain digits."""
    v = value.cast("double")
    return (
        F.when(v >= 1e12, F.concat(fmt(v / 1e12), F.lit(" trillion")))
        .when(v >= 1e9, F.concat(fmt(v / 1e9), F.lit(" billion")))
        .when(v >= 1e6, F.concat(fmt(v / 1e6), F.lit(" million")))
        .otherwise(fmt(v, 2, True))
    )


def by_unit(value: Column, unit: Column) -> Column:
    """A housing figure in the notation of its unit, ``N/A`` when there is none."""
    return (
        F.when(value.isNull(), "N/A")
        .when(unit == "USD_CURRENT", F.concat(F.lit("$"), fmt(value, 2, True)))
        .when(unit == "PERCENTAGE", F.concat(fmt(value), F.lit("%")))
        .when(unit == "DAYS", F.concat(fmt(value, 0), F.lit(" days")))
        .otherwise(fmt(value, 2, True))
    )


def housing_unit_words(unit: Column) -> Column:
    return (
        F.when(unit == "USD_CURRENT", "US dollars")
        .when(unit == "PERCENTAGE", "percent")
        .when(unit == "DAYS", "days")
        .otherwise("units")
    )


def unit_words(unit: Column) -> Column:
    words = F.lit("units")
    for name, text in lookups.pairs(lookups.UNIT_WORDS):
        words = F.when(unit == name, text).otherwise(words)
    return words


def pct_change(current: Column, previous: Column, positive_only: bool = False) -> Column:
    """Percent change, 0 where the earlier value is 0 (or not positive)."""
    cur, prev = current.cast("double"), previous.cast("double")
    usable = prev > 0 if positive_only else prev != 0
    return F.when(usable, (cur - prev) / prev * 100).otherwise(F.lit(0.0))


def range_pct(high: Column, low: Column, last: Column) -> Column:
    """The day's range as a percentage of the last price, 0 without a positive price."""
    close = last.cast("double")
    return F.when(close > 0, (high - low).cast("double") / close * 100).otherwise(F.lit(0.0))


def volatility_class(deviation: Column, average: Column) -> Column:
    ratio = F.when(average > 0, deviation / average).otherwise(F.lit(0.0))
    return F.when(ratio > 0.3, "high").when(ratio > 0.1, "moderate").otherwise("low")


def asset_kind(code: Column) -> Column:
    return F.when(code.contains("/"), "cryptocurrency").otherwise("stock")


def asset_label(code: Column) -> Column:
    return F.replace(code, F.lit("/"), F.lit(" to "))


def rose(change: Column, up: str, down: str) -> Column:
    return F.when(change > 0, up).otherwise(down)


def signed(change: Column, text: Column, minus: str = "") -> Column:
    return F.concat(F.when(change > 0, "+").otherwise(minus), text)


def yearly_list(years: Column) -> Column:
    """``year: text`` joined over an array of (year, text) structs, in year order."""
    line = lambda y: F.concat(y["year"].cast("string"), F.lit(": "), y["text"])
    return F.array_join(F.transform(F.array_sort(years), line), ", ")

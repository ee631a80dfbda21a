"""Tables to sentences.  One row in, one document out, all as built-in expressions.

Every document has text, doc_kind, year_key, region_key, socio_indicator_key,
realestate_indicator_key and asset_key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import text as X
from millrace.operators.rows import stack, year_over_year
from millrace.operators.sized import if_small
from millrace.plans import metrics
from millrace.session import stable

KEYS = {
    "year_key": "int", "region_key": "int", "socio_indicator_key": "string",
    "realestate_indicator_key": "string", "asset_key": "string",
}


def say(*parts) -> Column:
    """Concatenate; plain strings are literal text, columns their value or "unknown"."""
    return F.concat(*[
        F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("unknown")) for p in parts
    ])


def _doc(df: DataFrame, kind: str, text: Column, **keys: Column) -> DataFrame:
    return df.select(
        text.alias("text"), F.lit(kind).alias("doc_kind"),
        *[keys.get(k, F.lit(None)).cast(t).alias(k) for k, t in KEYS.items()],
    )


def _asset(df: DataFrame, kind: str, text: Column, year: str = "year") -> DataFrame:
    return _doc(df, kind, text, year_key=F.col(year), asset_key=F.col("asset_key"))


def doc_asset_day(prices: DataFrame) -> DataFrame:
    c, code, date = F.col, F.col("asset_key"), F.col("date")
    spread = (c("high") - c("low")).cast("double")
    text = say(
        X.asset_label(code), ", a ", X.asset_kind(code), " listed as ", code, ", on ",
        F.date_format(date, "MMMM"), " ", F.dayofmonth(date), ", ", F.year(date), " (", date, "): closed at ",
        X.fmt(c("close")), " USD, highest ", X.fmt(c("high")), " USD, lowest ", X.fmt(c("low")),
        " USD. The range of the day was ", X.fmt(spread), " USD or ",
        X.fmt(X.range_pct(c("high"), c("low"), c("close"))), "% of the close, on a volume of ",
        X.fmt(c("volume"), 0, True), " units.",
    )
    return _asset(prices, "asset_day", text)


def doc_asset_month(monthly: DataFrame) -> DataFrame:
    c = F.col
    text = say(
        c("asset_key"), " in month ", c("month_number"), " of ", c("year"), ": mean close ", X.fmt(c("avg_price")),
        " USD over ", c("trading_days"), " trading days, between ", X.fmt(c("min_price")), " and ",
        X.fmt(c("max_price")), " USD, with ", X.fmt(c("avg_volume"), 0, True), " units a day.",
    )
    return _asset(monthly, "asset_month", text)


def doc_asset_year(yearly: DataFrame) -> DataFrame:
    c, code = F.col, F.col("asset_key")
    change = c("max_close").cast("double") - c("min_close").cast("double")
    pct = X.pct_change(c("max_close"), c("min_close"), positive_only=True)
    spread = (c("year_high") - c("year_low")).cast("double")
    text = say(
        "Year ", c("year"), " of ", X.asset_label(code), " (", code, "), a ", X.asset_kind(code), ": ",
        c("trading_days"), " trading days between ", c("first_date"), " and ", c("last_date"),
        ". Closing prices ran from ", X.fmt(c("min_close")), " to ", X.fmt(c("max_close")), " USD, a ",
        X.rose(change, "gain", "loss"), " of ", X.fmt(F.abs(pct)), "% (",
        X.signed(change, X.fmt(F.abs(change)), "-"), " USD). Highest ", X.fmt(c("year_high")), ", lowest ",
        X.fmt(c("year_low")), ", range ", X.fmt(spread), " USD. Mean close ", X.fmt(c("avg_price")),
        " USD with a deviation of ", X.fmt(c("price_stddev")), " USD: ",
        X.volatility_class(c("price_stddev"), c("avg_price")), " volatility. Volume ",
        X.fmt(c("total_volume"), 0, True), " units in all and ", X.fmt(c("avg_volume"), 0, True), " a day.",
    )
    return _asset(yearly, "asset_year", text)


def doc_asset_year_over_year(pairs: DataFrame) -> DataFrame:
    c, code = F.col, F.col("asset_key")
    avg, vol, high, low = [
        X.pct_change(c(n), c(f"prev_{n}"), positive_only=True)
        for n in ("avg_price", "avg_volume", "max_price", "min_price")
    ]
    text = say(
        X.asset_label(code), " (", code, "), ", c("year"), " against ", c("prev_year"), ": mean close ",
        X.rose(avg, "increased", "decreased"), " from ", X.fmt(c("prev_avg_price")), " to ",
        X.fmt(c("avg_price")), " USD (", X.fmt(F.abs(avg)), "%). High of the year ",
        X.fmt(c("prev_max_price")), " to ", X.fmt(c("max_price")), " USD (", X.signed(high, X.fmt(high)),
        "%), low of the year ", X.fmt(c("prev_min_price")), " to ", X.fmt(c("min_price")), " USD (",
        X.signed(low, X.fmt(low)), "%). Daily volume ", X.rose(vol, "increased", "decreased"), " by ",
        X.fmt(F.abs(vol)), "%, from ", X.fmt(c("prev_avg_volume"), 0, True), " to ",
        X.fmt(c("avg_volume"), 0, True), " units: a year of ", X.rose(avg, "growth", "decline"), ".",
    )
    return _asset(pairs, "asset_year_over_year", text)


def asset_trends(prices: DataFrame, min_years: int = 3) -> DataFrame:
    """Whole-history figures of each asset with its ordered yearly averages."""
    return metrics.asset_lifetime(prices, min_years).join(metrics.asset_yearly_averages(prices), "asset_key")


def doc_asset_trend(trends: DataFrame) -> DataFrame:
    c, code = F.col, F.col("asset_key")
    first = F.get("yearly", F.lit(0))["avg_price"]
    last = F.try_element_at("yearly", F.lit(-1))["avg_price"]
    pct = X.pct_change(last, first, positive_only=True)
    lines = F.transform(
        "yearly", lambda y: F.concat(y["year"].cast("string"), F.lit(": $"), X.fmt(y["avg_price"]))
    )
    text = say(
        X.asset_label(code), " (", code, "), a ", X.asset_kind(code), ", over ", c("num_years"), " years from ",
        c("start_year"), " to ", c("end_year"), ": ", X.rose(pct, "growth", "decline"), " of ",
        X.fmt(F.abs(pct)), "%, from a mean of ", X.fmt(first), " USD to ", X.fmt(last),
        " USD. All-time high ", X.fmt(c("all_time_high")), " USD, all-time low ", X.fmt(c("all_time_low")),
        " USD, mean of all days ", X.fmt(c("overall_avg_price")), " USD, total volume ",
        X.fmt(c("total_volume"), 0, True), " units. Yearly means: ", F.array_join(lines, ", "), ".",
    )
    return _asset(trends, "asset_trend", text, "end_year")


def _socio(df: DataFrame, kind: str, text: Column, year: str = "year") -> DataFrame:
    return _doc(df, kind, text, year_key=F.col(year), socio_indicator_key=F.col("series_id"))


def doc_indicator_year(figures: DataFrame) -> DataFrame:
    c = F.col
    text = say(
        c("country_name"), " (", c("country_code"), "), ", c("year"), ": ", c("indicator_name"), " was ",
        X.magnitude(c("value")), " ", X.unit_words(c("unit")), ". Series ", c("series_id"), ": ",
        c("indicator_description"), ".",
    )
    return _socio(figures, "indicator_year", text)


_SERIES = ["country_code", "country_name", "series_id", "indicator_name", "unit"]


def indicator_trends(figures: DataFrame, min_points: int = 3) -> DataFrame:
    """Trend of each series and country, with its yearly values as text.

    Clean figures have one row per series, country and year, so the list is as long
    as the series has years.
    """
    ends = metrics.trend(figures, _SERIES, "year", "value", min_points)
    listed = figures.groupBy(*_SERIES).agg(
        X.yearly_list(F.collect_list(F.struct("year", X.magnitude(F.col("value")).alias("text")))).alias("summary"),
        F.min_by("indicator_description", "year").alias("indicator_description"),
    )
    return ends.join(listed, _SERIES)


def doc_indicator_trend(trends: DataFrame) -> DataFrame:
    c = F.col
    change = c("change")
    text = say(
        c("indicator_name"), " of ", c("country_name"), " (", c("country_code"), ") from ", c("start_year"),
        " to ", c("end_year"), ", ", c("points"), " years: ", X.rose(change, "increased", "decreased"), " from ",
        X.magnitude(c("start_value")), " to ", X.magnitude(c("end_value")), ", a ",
        X.rose(change, "growth", "decline"), " of ", X.fmt(F.abs(c("change_pct"))), "%. By year: ", c("summary"),
        ". In ", X.unit_words(c("unit")), ". Series ", c("series_id"), ": ", c("indicator_description"), ".",
    )
    return _socio(trends, "indicator_trend", text, "end_year")


def indicator_year_over_year(figures: DataFrame) -> DataFrame:
    return year_over_year(figures, ["country_code", "series_id"], "year", ["value"])


def doc_indicator_year_over_year(pairs: DataFrame) -> DataFrame:
    c = F.col
    change = c("value").cast("double") - c("prev_value").cast("double")
    pct = X.pct_change(c("value"), c("prev_value"))
    text = say(
        c("indicator_name"), " of ", c("country_name"), " (", c("country_code"), ") ",
        X.rose(change, "increased", "decreased"), " from ", X.magnitude(c("prev_value")), " in ", c("prev_year"),
        " to ", X.magnitude(c("value")), " in ", c("year"), ": ", X.fmt(F.abs(pct)), "% or ",
        X.signed(change, X.magnitude(F.abs(change))), " in ", X.unit_words(c("unit")), ", a ",
        X.rose(change, "growth", "decline"), ". Series ", c("series_id"), ": ", c("indicator_description"), ".",
    )
    return _socio(pairs, "indicator_year_over_year", text)


def location_phrase() -> Column:
    """The known parts of a place, most specific first."""
    def known(name: str, *parts) -> Column:
        return F.when(F.coalesce(F.col(name), F.lit("")) != "", say(*parts))

    c = F.col
    phrase = F.concat_ws(
        ", ",
        known("neighborhood_name", "neighborhood ", c("neighborhood_name")),
        known("city_name", "city of ", c("city_name")),
        known("county_name", c("county_name"), " County"),
        known("metro_name", c("metro_name"), " metro area"),
        known("state_name", "state of ", c("state_name")),
        known("state_code", "state code ", c("state_code")),
        known("zip_key", "ZIP ", c("zip_key")),
        known("country_name", c("country_name"), " (", c("country_code"), ")"),
    )
    return F.when(phrase == "", "an unspecified place").otherwise(phrase)


def recent_housing(
    figures: DataFrame, codes: list[str] | None = None, first: str | None = None, last: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Housing figures of some indicators and dates (default all), newest first within a region.

    With a ``limit`` the order is total, so the same rows are kept every time.
    """
    kept = figures if codes is None else figures.filter(F.col("realestate_indicator_key").isin(list(codes)))
    kept = metrics.in_range(kept, first, last)
    if limit is None:
        return kept
    order = ["region_key", F.desc("year"), F.desc("month_number"), F.desc("date_key"),
             "realestate_indicator_key", "value_key"]
    return kept.orderBy(*order).limit(limit)


def doc_housing(figures: DataFrame) -> DataFrame:
    c = F.col
    text = say(
        "Housing in ", location_phrase(), ", ", c("month_name"), " ", c("year"), " (week ", c("week_number"),
        "): ", c("realestate_indicator_key"), "-", c("indicator_name"), ", ", c("indicator_description"),
        ", stood at ", X.by_unit(c("value"), c("unit")), " (", X.housing_unit_words(c("unit")),
        "). Level: ", c("region_type"), ".",
    )
    return _doc(
        figures, "housing", text, year_key=c("year"), region_key=c("region_key"),
        realestate_indicator_key=c("realestate_indicator_key"),
    )


def doc_housing_state_year(stats: DataFrame) -> DataFrame:
    c = F.col
    value = lambda name: X.by_unit(c(name), c("unit"))
    text = say(
        "Annual real estate summary, ", F.coalesce(c("state_name"), F.lit("unknown state")), " (", c("state_code"),
        "), ", c("year"), ": ", c("realestate_indicator_key"), "-", c("indicator_name"), ", ",
        c("indicator_description"), ". Mean ", value("avg_value"), ", minimum ", value("min_value"),
        ", maximum ", value("max_value"), ", standard deviation ", value("stddev_value"), ", from ",
        c("data_points"), " figures.",
    )
    return _doc(
        stats, "housing_state_year", text, year_key=c("year"),
        realestate_indicator_key=c("realestate_indicator_key"),
    )


def corpus(
    prices: DataFrame, indicators: DataFrame, housing: DataFrame,
    first: str | None = None, last: str | None = None, codes: list[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """All documents with ids that depend on their content alone.

    ``content_id`` (128 bits) names a document for good: two of them are equal where their
    content is.  ``id`` is a 64-bit number for searches within one set of chunks.

    ``first``, ``last`` and ``codes`` narrow the housing figures; by default all are told.
    """
    documents = stack(
        doc_housing(recent_housing(housing, codes, first, last, limit)),
        doc_housing_state_year(metrics.state_year(housing, first, last)),
        doc_asset_day(prices),
        doc_indicator_year(indicators),
        doc_indicator_trend(indicator_trends(indicators)),
        doc_indicator_year_over_year(indicator_year_over_year(indicators)),
        doc_asset_month(metrics.asset_month(prices)),
        doc_asset_year(metrics.asset_year(prices)),
        doc_asset_year_over_year(metrics.asset_year_over_year(prices)),
        doc_asset_trend(asset_trends(prices)),
    )
    content = F.md5(F.to_json(F.struct("doc_kind", "text", *KEYS), {"ignoreNullFields": "false"}))
    return documents.withColumns({"id": F.xxhash64("text", *KEYS), "content_id": content}).select("id", *documents.columns, "content_id")


def corpus_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Documents that only one of two versions has: the row, and ``change`` 'added' or 'removed'.

    A document whose text changed is one of each.  Versions meet by content_id, counted in one
    pass over both, so nothing but ids is shuffled before those that differ are known; few of
    them go to where the rows are made, and no other row moves.
    """
    told = old.select("content_id", F.lit(-1).alias("side")).unionByName(new.select("content_id", F.lit(1).alias("side")))
    sides = told.groupBy("content_id").agg(F.min("side").alias("low"), F.max("side").alias("high"))
    differ = stable(sides.filter("low = high"))
    come, gone = (if_small(differ.filter(F.col("low") == side).select("content_id")) for side in (1, -1))
    changed = [df.join(ids, "content_id", "left_semi").dropDuplicates(["content_id"]).withColumn("change", F.lit(word))
               for df, ids, word in ((new, come, "added"), (old, gone, "removed"))]
    return changed[0].unionByName(changed[1])

"""The star schema: eight dimensions and one sparse fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace import lookups, schemas
from millrace.functions import paths
from millrace.functions.dates import calendar, first_of_year
from millrace.functions.hashing import content_md5, hash_key, leading_bits
from millrace.operators.keys import dense_key, unique_hash_key
from millrace.operators.lookup import with_lookup
from millrace.operators.rows import conform, dedupe, stack, stack_distinct
from millrace.session import scratch_path, side_by_side, stable


# -- dimensions ---------------------------------------------------------------

def dim_time(indicators: DataFrame, housing: DataFrame, bars: DataFrame) -> DataFrame:
    """Every date any source mentions; a yearly figure counts as 1 January."""
    dates = stack_distinct(
        indicators.select(first_of_year(F.col("year")).alias("date_key")),
        housing.select(F.col("date").cast("date").alias("date_key")),
        bars.select(F.col("date_parsed").alias("date_key")),
    ).filter(F.col("date_key").isNotNull())
    return dates.withColumns(calendar(F.col("date_key")))


def dim_country(indicators: DataFrame, default: tuple[str, str] = lookups.DEFAULT_COUNTRY) -> DataFrame:
    """Countries by code, the default one always among them.

    One name per code (the first in order) and one key per code, so facts cannot fan out.
    """
    spark = indicators.sparkSession
    forced = lookups.literal_table(spark, [default], "country_code string, country_name string")
    named = stack_distinct(indicators.select("country_code", "country_name"), forced)
    once = dedupe(named.filter(F.col("country_code").isNotNull()), ["country_code"])
    # The default country keeps its plain hash, which dim_region computes for itself.
    return unique_hash_key(once, "country_code", "country_key", first=default[0]).select("country_key", "country_name", "country_code")


def decode_region(df: DataFrame, states: DataFrame) -> DataFrame:
    """Add the place columns held in ``region`` (a path) and ``region_type``."""
    path, kind = F.col("region"), F.col("region_type")
    named = with_lookup(df, path, states, "state_name", "state_code", "_of_state")
    coded = named.withColumn("state_code", paths.state_code(path, kind, F.col("_of_state"))).drop("_of_state")
    placed = with_lookup(coded, F.trim("state_code"), states, "state_code", "state_name", "state_name")
    return placed.withColumns({
        "metro_name": paths.metro_name(path, kind),
        "county_name": paths.county_name(path, kind),
        "city_name": paths.city_name(path, kind),
        "zip_key": paths.zip_key(path, kind),
        "neighborhood_name": paths.neighborhood_name(path, kind),
    })


def dim_region(housing: DataFrame, states: DataFrame, country: str = lookups.DEFAULT_COUNTRY[0]) -> DataFrame:
    """One row per region seen in the housing data, decoded after deduplication."""
    seen = housing.filter(F.col("region_id").isNotNull() & F.col("region_type").isNotNull())
    regions = dedupe(seen.select("region_id", "region_type", "region").distinct(), ["region_id"])
    return decode_region(regions, states).select(
        F.col("region_id").cast("int").alias("region_key"),
        hash_key(F.lit(country)).alias("country_key"),
        "region_type", "zip_key", "neighborhood_name", "city_name", "county_name", "metro_name",
        "state_name", "state_code",
    )


def indicator_values(indicators: DataFrame, units: DataFrame) -> DataFrame:
    return with_lookup(indicators, F.col("series_id"), units, "series_id", "unit", "unit", "UNKNOWN")


def housing_values(housing: DataFrame, units: DataFrame) -> DataFrame:
    return with_lookup(housing, F.col("indicator_id"), units, "indicator_id", "unit", "unit", "USD_CURRENT")


def dim_value(
    indicators: DataFrame, housing: DataFrame, series_units: DataFrame, housing_units: DataFrame, key_type: str = "int",
) -> DataFrame:
    """Distinct (value, unit), numbered in the order of the pair's MD5."""
    distinct = stack_distinct(
        indicator_values(indicators, series_units).select("value", "unit"),
        housing_values(housing, housing_units).select("value", "unit"),
    )
    # The bytes of a digest have the order of its hex text in half the length.
    hashed = distinct.withColumn("value_hash", F.unhex(content_md5(F.col("value"), F.col("unit"))))
    return dense_key(
        hashed, ["value_hash"], "value_key", key_type=key_type, spread=leading_bits(F.col("value_hash")),
        unneeded=("value_hash",),
    )


def dim_socioeconomical_indicator(meta: DataFrame) -> DataFrame:
    return meta.select(
        F.col("series_id").alias("socioeconomical_indicator_key"), "name", "description"
    ).distinct()


def dim_realestate_indicator(housing: DataFrame, descriptions: DataFrame) -> DataFrame:
    seen = housing.select(
        F.col("indicator_id").alias("realestate_indicator_key"), F.col("indicator").alias("indicator_name")
    ).distinct()
    return with_lookup(
        seen, F.col("realestate_indicator_key"), descriptions, "indicator_id", "description",
        "indicator_description", "",
    )


def dim_asset(bars: DataFrame) -> DataFrame:
    return bars.select(F.col("symbol").alias("asset_key"), "type").distinct()


def dim_asset_value(bars: DataFrame, key_type: str = "int") -> DataFrame:
    """Distinct bars, numbered in the order of all their columns."""
    values = bars.select(
        "symbol", "date_parsed", "high", "low",
        F.col("volume").cast(schemas.VALUE).alias("volume"), F.col("last").alias("close"),
    ).distinct()
    return dense_key(
        values, ["symbol", "date_parsed", "high", "low", "close", "volume"], "cryptostock_value_key", key_type=key_type
    )


# -- facts --------------------------------------------------------------------
# Dimensions are joined without hints: Spark broadcasts those it measures as small
# and sort-merges the rest, splitting skewed keys (AQE).

def fact_indicator(indicators, series_units, values, countries, times) -> DataFrame:
    with_unit = indicator_values(indicators, series_units)
    return (
        with_unit.withColumn("date_key", first_of_year(F.col("year")))
        .join(times.select("date_key"), "date_key")
        .join(countries.select("country_code", "country_key"), "country_code")
        .join(values, ["value", "unit"])
        .select(
            "value_key", F.col("series_id").alias("socioeconomical_indicator_key"), "country_key", "date_key"
        )
        .distinct()
    )


def fact_housing(housing, housing_units, values, indicators, times, regions) -> DataFrame:
    keyed = housing_values(housing, housing_units).withColumns({
        "date_key": F.col("date").cast("date"), "region_key": F.expr("try_cast(region_id as int)"),
    })
    return (
        keyed.join(times.select("date_key"), "date_key")
        .join(
            indicators.select("realestate_indicator_key").distinct(),
            F.col("indicator_id") == F.col("realestate_indicator_key"),
        )
        .join(regions.select("region_key", "country_key"), "region_key")
        .join(values, ["value", "unit"])
        .select("value_key", "realestate_indicator_key", "region_key", "country_key", "date_key")
        .distinct()
    )


def fact_asset(bars, asset_values, assets, times) -> DataFrame:
    """NULL in any of the six joined columns drops the bar."""
    keyed = bars.select(
        F.col("symbol"), "date_parsed", "high", "low",
        F.col("volume").cast(schemas.VALUE).alias("volume"), F.col("last").alias("close"),
    )
    return (
        keyed.join(asset_values, ["symbol", "date_parsed", "high", "low", "volume", "close"])
        .join(times.select(F.col("date_key")), F.col("date_parsed") == F.col("date_key"))
        .join(assets.select("asset_key").distinct(), F.col("symbol") == F.col("asset_key"))
        .select("cryptostock_value_key", "date_key", "asset_key")
        .distinct()
    )


def fact_distinct_bars(asset_values, assets, times) -> DataFrame:
    """``fact_asset`` of the very bars that ``asset_values`` was made from, without the join back.

    NULL in any of the six columns drops the bar, as the join does.
    """
    return (
        asset_values.dropna(subset=["symbol", "date_parsed", "high", "low", "volume", "close"])
        .join(times.select("date_key"), F.col("date_parsed") == F.col("date_key"))
        .join(assets.select("asset_key").distinct(), F.col("symbol") == F.col("asset_key"))
        .select("cryptostock_value_key", "date_key", "asset_key")
    )


def fact_value(*facts: DataFrame, key_type: str = "int") -> DataFrame:
    """The sparse fact table: columns a source does not fill are typed NULLs."""
    return conform(stack(*facts), schemas.fact(key_type)).withColumn("year", F.year("date_key"))


# -- everything ---------------------------------------------------------------

def build_star(indicators, meta, housing, bars, series_units=None, key_type: str = "int", path: str | None = None) -> dict[str, DataFrame]:
    """All tables of the star schema from the three clean tables.

    Each dimension is written once, to its folder in ``path`` (else in the scratch folder); they
    do not need each other and are written side by side.  The facts read those tables.
    ``key_type`` is that of the dense keys: ``bigint`` for more than 2^31 values or bars.
    """
    spark = bars.sparkSession
    units = series_units if series_units is not None else lookups.series_units(spark)
    house_units = lookups.housing_units(spark)
    states, descriptions = lookups.states(spark), lookups.housing_descriptions(spark)
    root = path or scratch_path(spark, "dimensions")
    dims = {
        "dim_value": lambda: dim_value(indicators, housing, units, house_units, key_type),
        "dim_region": lambda: dim_region(housing, states),
        "dim_time": lambda: dim_time(indicators, housing, bars),
        "dim_country": lambda: dim_country(indicators),
        "dim_socioeconomical_indicator": lambda: dim_socioeconomical_indicator(meta),
        "dim_realestate_indicator": lambda: dim_realestate_indicator(housing, descriptions),
        "dim_asset": lambda: dim_asset(bars),
        "dim_cryptostock_value": lambda: dim_asset_value(bars, key_type),
    }
    star = side_by_side(spark, {
        name: lambda name=name, dim=dim: stable(dim(), f"{root}/{name}") for name, dim in dims.items()
    })
    star["fact_value"] = fact_value(
        fact_indicator(indicators, units, star["dim_value"], star["dim_country"], star["dim_time"]),
        fact_housing(
            housing, house_units, star["dim_value"], star["dim_realestate_indicator"], star["dim_time"],
            star["dim_region"],
        ),
        fact_distinct_bars(star["dim_cryptostock_value"], star["dim_asset"], star["dim_time"]),
        key_type=key_type,
    )
    return star

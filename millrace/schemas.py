"""Row types of the raw files and of the star schema."""

from pyspark.sql import types as T

VALUE = T.DecimalType(30, 10)

INDICATOR_CSV = T.StructType([
    T.StructField("series_id", T.StringType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("country_name", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("value", VALUE),
])

INDICATOR_META_CSV = T.StructType([
    T.StructField("series_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
])

HOUSING_CSV = T.StructType([
    T.StructField("indicator_id", T.StringType()),
    T.StructField("region_id", T.IntegerType()),
    T.StructField("date", T.DateType()),
    T.StructField("value", VALUE),
])

HOUSING_INDICATOR_CSV = T.StructType([
    T.StructField("indicator_id", T.StringType()),
    T.StructField("indicator", T.StringType()),
    T.StructField("category", T.StringType()),
])

HOUSING_REGION_CSV = T.StructType([
    T.StructField("region_id", T.IntegerType()),
    T.StructField("region_type", T.StringType()),
    T.StructField("region", T.StringType()),
])

CRYPTO_CSV = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("last", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
])

BAR = T.StructType([
    T.StructField("t", T.StringType()),
    T.StructField("h", T.DoubleType()),
    T.StructField("l", T.DoubleType()),
    T.StructField("c", T.DoubleType()),
    T.StructField("v", T.LongType()),
])

ENVELOPE = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("bars", T.ArrayType(BAR)),
    T.StructField("next_page_token", T.StringType()),
    T.StructField("fetched_at", T.StringType()),
])

TRADE = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("size", T.DoubleType()),
    T.StructField("time", T.TimestampType()),
])

FACT = T.StructType([
    T.StructField("value_key", T.IntegerType()),
    T.StructField("socioeconomical_indicator_key", T.StringType()),
    T.StructField("realestate_indicator_key", T.StringType()),
    T.StructField("region_key", T.IntegerType()),
    T.StructField("cryptostock_value_key", T.IntegerType()),
    T.StructField("country_key", T.IntegerType()),
    T.StructField("date_key", T.DateType()),
    T.StructField("asset_key", T.StringType()),
])


def fact(key_type: str) -> T.StructType:
    """``FACT`` with its two dense keys in the given type."""
    kind = T.LongType() if key_type == "bigint" else T.IntegerType()
    dense = ("value_key", "cryptostock_value_key")
    return T.StructType([T.StructField(f.name, kind if f.name in dense else f.dataType) for f in FACT])


# Exactly one of these column sets is filled in a fact row.
FACT_FAMILIES = {
    "socioeconomic": ["socioeconomical_indicator_key"],
    "realestate": ["realestate_indicator_key"],
    "asset": ["asset_key"],
}

CHUNK = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("year_key", T.IntegerType()),
    T.StructField("region_key", T.IntegerType()),
    T.StructField("socio_indicator_key", T.StringType()),
    T.StructField("realestate_indicator_key", T.StringType()),
    T.StructField("asset_key", T.StringType()),
])

"""Writes.

A job to a new path is seen whole or not at all.  Overwriting in place is not atomic: a
reader that comes while old files go may miss rows, so write a new path where that matters.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
    touched_only: bool = False, sort_by: list[str] = (),
) -> None:
    """Write Parquet, rows of a file in the order of ``sort_by`` so that scans can skip row groups.

    With ``partition_by`` rows are first rebalanced on those columns, so a partition
    gets few files, while AQE still splits one that holds most of the data.
    ``touched_only`` replaces just the partitions that occur in ``df``.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        df = df.sortWithinPartitions(*(partition_by or []), *sort_by)
    writer = df.write.mode(mode)
    if touched_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def with_casts(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Exactly the listed columns in the listed types."""
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in casts.items()])


# Column types of the tables handed to the serving layer; working columns are dropped.
SERVING = {
    "dim_time": {"date_key": "date", "day_name": "string", "week_number": "int", "month_number": "int",
                 "month_name": "string", "year": "int"},
    "dim_country": {"country_key": "int", "country_name": "string", "country_code": "string"},
    "dim_region": {"region_key": "int", "country_key": "int", "region_type": "string", "zip_key": "string",
                   "neighborhood_name": "string", "city_name": "string", "county_name": "string",
                   "metro_name": "string", "state_name": "string", "state_code": "string"},
    "dim_value": {"value_key": "int", "value": "decimal(30,10)", "unit": "string"},
    "dim_socioeconomical_indicator": {"socioeconomical_indicator_key": "string", "name": "string",
                                      "description": "string"},
    "dim_realestate_indicator": {"realestate_indicator_key": "string", "indicator_name": "string",
                                 "indicator_description": "string"},
    "dim_asset": {"asset_key": "string", "type": "string"},
    "dim_cryptostock_value": {"cryptostock_value_key": "int", "high": "double", "low": "double",
                              "volume": "double", "close": "double"},
    "fact_value": {"value_key": "int", "socioeconomical_indicator_key": "string",
                   "realestate_indicator_key": "string", "region_key": "int", "cryptostock_value_key": "int",
                   "country_key": "int", "date_key": "date", "asset_key": "string"},
}


def publish(tables: dict[str, DataFrame], path: str, views: bool = False) -> dict[str, DataFrame]:
    """Write the serving copy of each table to a new version folder and return readers of it.

    All tables are of one version, and readers of an earlier one keep their files.  The
    views are switched once everything is written.  Dense keys keep the wider type they
    came with.  A table with a year beside its serving columns is partitioned by it.
    """
    version, out = f"{path}/version-{uuid.uuid4().hex}", {}
    for name, df in tables.items():
        wide = {c for c, t in df.dtypes if t == "bigint"}
        types = {c: "bigint" if c in wide and t == "int" else t for c, t in SERVING[name].items()}
        by = ["year"] if "year" in df.columns and "year" not in types else []
        types |= {c: "int" for c in by}
        write_table(with_casts(df, types), f"{version}/{name}", partition_by=by or None)
        out[name] = df.sparkSession.read.schema(", ".join(f"{c} {t}" for c, t in types.items())).parquet(f"{version}/{name}")
    for name in out:
        if views:
            out[name].createOrReplaceTempView(name)
    return out


def envelopes(bars: DataFrame) -> DataFrame:
    """Bars folded into one envelope per symbol and year.

    A year bounds the list (one bar a day), whatever the history of a symbol is.
    Needs bars unique by (symbol, date).
    """
    bar = F.struct(
        F.col("date_parsed").cast("string").alias("t"),
        F.col("high").cast("double").alias("h"),
        F.col("low").cast("double").alias("l"),
        F.col("last").cast("double").alias("c"),
        F.col("volume").cast("long").alias("v"),
    )
    return (
        bars.groupBy("symbol", F.year("date_parsed").alias("page"))
        .agg(F.max("type").alias("type"), F.array_sort(F.collect_list(bar)).alias("bars"))
        .select(
            "symbol", "type", "bars", F.lit(None).cast("string").alias("next_page_token"),
            F.current_timestamp().cast("string").alias("fetched_at"), "page",
        )
    )


def write_envelopes(bars: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON file per envelope, in folders named after a path-safe symbol and its page.

    The checksum keeps apart symbols that are equal once made path-safe.
    """
    safe = F.concat_ws(
        "-", F.replace(F.col("symbol"), F.lit("/"), F.lit("_")), F.lower(F.hex(F.crc32(F.encode("symbol", "UTF-8"))))
    )
    (
        envelopes(bars).withColumn("safe_symbol", safe)
        .repartition("safe_symbol", "page")
        .write.mode(mode).partitionBy("safe_symbol", "page").json(path)
    )

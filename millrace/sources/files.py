"""Scans.  Schemas are given; where none is known, types are told from all values by one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace import schemas


def read_csv(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """CSV with a header; a field that does not parse becomes NULL."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


# From narrow to wide: what a text must look like.  Other values leave a column as text.
_LOOKS = {
    "boolean": "(?i)^(true|false)$",
    "bigint": "^[+-]?[0-9]{1,18}$",
    "double": "^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$",
    "date": "^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp": "^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?$",
}


def infer_types(df: DataFrame) -> dict[str, str]:
    """The narrowest type every text of a column can be read as, from one aggregation over all rows.

    Nulls and blank texts do not count; a column of nothing else stays a string, and so does
    one whose whole numbers have leading zeros (codes, not numbers) or exceed 18 digits.
    """
    ask = []
    for i, name in enumerate(df.columns):
        text = F.trim(F.col(f"`{name}`"))
        told = text != ""
        ask.append(F.count_if(told).alias(f"n{i}"))
        for kind, look in _LOOKS.items():
            good = text.rlike(look)
            if kind in ("bigint", "double"):
                good = good & ~text.rlike("^[+-]?0[0-9]")
            if kind in ("date", "timestamp"):
                good = good & text.try_cast(kind).isNotNull()
            ask.append(F.count_if(told & ~F.coalesce(good, F.lit(False))).alias(f"{kind}{i}"))
    # One row, whatever the table's size.
    seen = df.agg(*ask).first()
    fits = lambda i: next((kind for kind in _LOOKS if seen[f"n{i}"] and not seen[f"{kind}{i}"]), "string")
    return {name: fits(i) for i, name in enumerate(df.columns)}


def read_csv_typed(spark: SparkSession, path, view: str | None = None) -> DataFrame:
    """CSV with a header and no known schema, typed by its values, and registered as ``view`` for SQL."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    types = infer_types(raw)
    blank = lambda c: F.when(F.trim(c) != "", F.trim(c))
    typed = raw.select(*[
        (F.col(f"`{c}`") if kind == "string" else blank(F.col(f"`{c}`")).cast(kind)).alias(c) for c, kind in types.items()
    ])
    if view:
        typed.createOrReplaceTempView(view)
    return typed


def read_envelopes(spark: SparkSession, path, multi_line: bool = True) -> DataFrame:
    """Market-data envelopes, one JSON object per file (or per line)."""
    return spark.read.schema(schemas.ENVELOPE).option("multiLine", multi_line).json(path)


def read_table(spark: SparkSession, path: str, where=None) -> DataFrame:
    """A lake table; ``where`` reaches the scan as a partition or row-group filter."""
    df = spark.read.parquet(path)
    return df if where is None else df.filter(where)


def with_provenance(df: DataFrame, from_file: bool = True, source: str | None = None) -> DataFrame:
    """Stamp when a row was read and which file (or named source) it came from."""
    origin = F.lit(source) if source is not None or not from_file else F.col("_metadata.file_path")
    return df.select("*", F.current_timestamp().alias("ingestion_timestamp"), origin.alias("source_file"))

"""Reading tables, the held-out fold, and bounded training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.session import stable


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id's decimal text is a multiple of five; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample_ids(rows: DataFrame, key: str, size: int, per: str | None = None) -> DataFrame:
    """At most ``size`` rows with the smallest hashes of ``key``, in all or for each ``per``.

    A pick by hash, so the same on every run; rows past the bound leave before the shuffle.
    The result is written, so its size is known where it is joined.
    """
    order = [F.xxhash64(F.col(key)), F.col(key)]
    if per is None:
        picked = rows.orderBy(*order).limit(size)
    else:
        rank = F.row_number().over(Window.partitionBy(per).orderBy(*order))
        picked = rows.withColumn("__rank", rank).filter(F.col("__rank") <= size).drop("__rank")
    return stable(picked)

"""Dense surrogate keys without a single-partition sort, and hash keys without collisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.functions.hashing import hash_key
from millrace.session import stable


def dense_key(
    df: DataFrame, sort_cols: list[str], out: str, partitions: int | None = None, key_type: str = "int",
    spread: Column | None = None, unneeded: tuple[str, ...] = (),
) -> DataFrame:
    """Number the rows 1..n in the order of ``sort_cols``, which must be unique together.

    Same result as ``row_number().over(Window.orderBy(...))``, but the sort is
    distributed: rows are range-partitioned, sorted within each partition and given
    partition-local positions; only one count per partition is summed up centrally.
    Range bounds are sampled, so the positioned rows are written to the shared folder:
    recomputing a lost partition against other bounds would renumber it.

    ``spread`` is a number that never falls along the order and deals the rows evenly, such as
    the first bits of a digest.  Rows are then dealt by it: no bounds are sampled, which
    would compute ``df`` twice.  ``unneeded`` columns serve the order only and are not stored.

    The star schema's keys are int; more than 2^31 rows raise an error rather than
    wrap around, and need ``key_type="bigint"``.
    """
    at, kept = F.monotonically_increasing_id(), [c for c in df.columns if c not in unneeded]
    if spread is None:
        ranged = (
            df.repartitionByRange(partitions, *sort_cols) if partitions else df.repartitionByRange(*sort_cols)
        )
        placed = stable(ranged.sortWithinPartitions(*sort_cols).withColumn("_at", at).drop(*unneeded))
        placed = placed.withColumn("_part", F.shiftright("_at", 33))
    else:
        by = df.withColumn("_part", spread)
        dealt = by.repartition(partitions, "_part") if partitions else by.repartition("_part")
        placed = stable(dealt.sortWithinPartitions("_part", *sort_cols).withColumn("_at", at).drop(*unneeded))
    # One row per partition, or per value of spread: the only data that meets in one task.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_offset"))
    key = (F.col("_offset") + F.col("_at") + 1).cast(key_type)
    return placed.join(F.broadcast(offsets), "_part").select(key.alias(out), *kept)


def unique_hash_key(df: DataFrame, column: str, out: str, first: str | None = None, tries: int = 16) -> DataFrame:
    """Add the 32-bit hash of ``column`` (unique in ``df``) as a key that no two rows share.

    Nearly all rows keep the plain hash.  Where values meet in one hash the smallest keeps
    it - ``first`` before all others - and the rest take the hash of value and number of tries,
    until all differ.  The key depends on the set of values alone.
    """
    order = [F.col("_try"), F.col(column) != F.lit(first) if first is not None else F.lit(0), F.col(column)]
    now = df.withColumns({"_try": F.lit(0), out: hash_key(F.col(column))})
    for _ in range(tries):
        now = stable(now.withColumn("_rn", F.row_number().over(W.partitionBy(out).orderBy(*order))))
        if not now.filter("_rn > 1").take(1):
            return now.drop("_rn", "_try")
        again = F.col("_rn") > 1
        key = F.when(again, hash_key(F.col(column), F.col("_try") + 1)).otherwise(F.col(out))
        now = now.withColumn(out, key).withColumn("_try", F.col("_try") + again.cast("int")).drop("_rn")
    raise ValueError(f"hashes of {column} still collide after {tries} tries")

"""Incremental loading of envelope files and upkeep of the clean table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace import schemas
from millrace.operators.rows import dedupe
from millrace.plans.clean import clean_bars
from millrace.session import path_exists
from millrace.sinks.files import write_table
from millrace.sources.landing import explode_bars
from millrace.streaming.bars import among


def envelope_stream(
    spark: SparkSession, src: str, archive: str | None = None, files_per_batch: int = 1000
) -> DataFrame:
    """New envelope files as bars with provenance.

    With ``archive`` a read file is moved there - once a later batch has new files, so
    the newest ones stay in place until then.
    """
    reader = (
        spark.readStream.schema(schemas.ENVELOPE).option("multiLine", True)
        .option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    raw = reader.json(src).select(
        "*", F.current_timestamp().alias("ingestion_timestamp"), F.col("_metadata.file_path").alias("source_file")
    )
    return explode_bars(raw)


def ingest_envelopes(
    spark: SparkSession, src: str, dst: str, checkpoint: str, archive: str | None = None,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Append the bars of all files not yet seen to ``dst`` and stop."""
    return (
        envelope_stream(spark, src, archive, files_per_batch).writeStream.format("parquet").option("path", dst)
        .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    )


def _plain(path: Column) -> Column:
    """A path without its scheme, percent signs resolved, as listings and row metadata write it differently."""
    return F.url_decode(F.regexp_replace(F.regexp_replace(path, "^[a-z0-9]+:/*", "/"), "[+]", "%2B"))


def _files(spark: SparkSession, folder: str) -> DataFrame:
    if not path_exists(spark, folder):
        return spark.createDataFrame([], "file string")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(folder)
    return listed.select(_plain(F.col("path")).alias("file"))  # contents are not read


def audit_files(spark: SparkSession, src: str, landed: str, archive: str) -> DataFrame:
    """(file, rows, in_place, archived) of every raw file that is or was in ``src``.

    ``file`` is relative to ``src``; ``rows`` says how many rows of the landed table came
    from it (0: not read), by the provenance each row carries.
    """
    def under(folder: str) -> Column:
        return F.expr(f"substring(file, length('{_plain_text(folder)}') + 2)").alias("file")

    read = spark.read.parquet(landed).groupBy(_plain(F.col("source_file")).alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    read = read.select(under(src), "rows")
    here = _files(spark, src).select(under(src), F.lit(True).alias("in_place"))
    moved = _files(spark, archive).select(under(archive), F.lit(True).alias("archived"))
    both = here.join(read, "file", "full").join(moved, "file", "full")
    return both.select("file", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("in_place", F.lit(False)).alias("in_place"),
                       F.coalesce("archived", F.lit(False)).alias("archived"))


def _plain_text(folder: str) -> str:
    return "/" + re.sub("^[a-z0-9]+:/*", "", folder).strip("/").replace("'", "''")


def sweep_landed(spark: SparkSession, src: str, landed: str, archive: str) -> int:
    """Move every file of ``src`` that has landed to ``archive``; returns how many.

    To be run between two starts of the stream.  Only files whose rows are in the table move,
    so what was not read, or read by a start that failed before its commit, stays.  A sweep
    that died is run again.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(src).getFileSystem(spark._jsc.hadoopConfiguration())
    done = 0
    # Names only, fetched part by part: a rename is a call to the store, not work on data.
    for row in audit_files(spark, src, landed, archive).filter("rows > 0 and in_place").select("file").toLocalIterator():
        target = hadoop.Path(f"{archive}/{row.file}")
        files.mkdirs(target.getParent())
        done += files.rename(hadoop.Path(f"{src}/{row.file}"), target)
    return done


def upsert_by_year(batch: DataFrame, path: str, symbols: list[str] | None = None) -> None:
    """Merge a batch of bars into the clean table; only the years it touches are rewritten.

    The years are replaced in place, so this is for a table with one writer that can be
    built again; where a job may die on the way, use ``append_bars``.  Running the same batch again changes nothing, so a retried batch is harmless.  Bars
    without a readable date are kept in the partition of the NULL year, as ``clean_bars`` does.
    """
    spark = batch.sparkSession
    clean = clean_bars(batch, symbols, newest="ingestion_timestamp")
    if path_exists(spark, path):
        # One row per calendar year in the batch.
        years = [r.year for r in clean.select("year").distinct().collect()]
        if not years:
            return
        old = spark.read.parquet(path).filter(among("year", years))
        both = old.unionByName(clean.select(*old.columns))
        clean = dedupe(both, ["symbol", "date"], [F.col("ingestion_timestamp").desc_nulls_last()])
    write_table(clean, path, "overwrite", ["year"], touched_only=True)


def append_bars(batch: DataFrame, path: str, symbols: list[str] | None = None) -> None:
    """Add a batch of clean bars to the log at ``path``; nothing that is there is touched.

    Only the batch is written, however long the years it touches are.  A job that dies
    loses nothing, and a batch written twice, or in part and then again, reads as once.
    """
    write_table(_part(clean_bars(batch, symbols, newest="ingestion_timestamp"), "added"), path, "append", ["part", "year"])


def _part(bars: DataFrame, part: str) -> DataFrame:
    """``added`` rows may hold several versions of a bar, ``merged`` ones hold each bar once."""
    return bars.withColumn("part", F.lit(part))


def current_bars(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of every bar in the log, bars without a readable date included.

    Only years to which something was added since the log was merged are ranked; the others
    are a plain scan.  Which years those are is told by the partitions of the added part.  The
    year follows from the date, so naming it as a key changes no row but lets a filter on
    year reach the partitions.
    """
    log = spark.read.parquet(path)
    # One row per calendar year; a scan of partition values, no column is read.
    years = [r[0] for r in log.filter("part = 'added'").select("year").distinct().collect()]
    newest = [F.col("ingestion_timestamp").desc_nulls_last()]
    ranked = dedupe(log.filter(among("year", years)).drop("part"), ["symbol", "date", "year"], newest)
    return log.filter(~F.coalesce(among("year", years), F.lit(False))).drop("part").unionByName(ranked)


def compact_bars(spark: SparkSession, path: str, target: str) -> DataFrame:
    """Write the current bars as the merged part of a new log at ``target`` and return its reader.

    ``path`` stays as it is: its readers go on, and a writer moves over between two runs.
    """
    write_table(_part(current_bars(spark, path), "merged"), target, "errorifexists", ["part", "year"], sort_by=["symbol", "date"])
    return current_bars(spark, target)


def maintain_clean_bars(
    bars: DataFrame, path: str, checkpoint: str, symbols: list[str] | None = None
) -> StreamingQuery:
    """Append a stream of bars to the log at ``path``, then stop; read it by ``current_bars``."""
    return (
        bars.writeStream.foreachBatch(lambda batch, _: append_bars(batch, path, symbols))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )

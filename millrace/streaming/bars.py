"""Live trades to bars, and bars without repeats."""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.rows import dedupe
from millrace.session import path_exists, scratch, stable


def ohlcv(trades: DataFrame, window: str = "1 day", watermark: str = "3 days") -> DataFrame:
    """Open, high, low, close and volume per symbol and tumbling window.

    Works on a stream or a table.  On a stream, trades later than ``watermark``
    behind the newest one are dropped and a bar is final once it is that old.  The
    state is one small row per symbol and open window, however many trades it has.
    """
    if trades.isStreaming:
        trades = trades.withWatermark("time", watermark)
    at = F.struct("time", "price")
    return trades.groupBy(F.window("time", window).alias("span"), "symbol").agg(
        F.min_by("price", at).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", at).alias("close"),
        F.sum("size").alias("volume"),
        F.count(F.lit(1)).alias("trades"),
    ).select(
        "symbol", F.col("span.start").alias("start"), F.col("span.end").alias("end"),
        "open", "high", "low", "close", "volume", "trades",
    )


def bars_stream(trades: DataFrame, path: str, checkpoint: str, window: str = "1 day", watermark: str = "3 days") -> StreamingQuery:
    """Append the final bars of a stream of trades to ``path`` until its input is used up."""
    return (
        ohlcv(trades, window, watermark).writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def late_trades(trades: DataFrame, bars: DataFrame, window: str = "1 day") -> DataFrame:
    """(symbol, start, late): how many trades of a final window came too late for its bar.

    ``trades`` is the table the stream was read from, ``bars`` what it wrote.  A window is
    final when it ended no later than the newest bar; a symbol whose trades in it were all late has
    no bar and is reported too.
    """
    newest = bars.agg(F.max("end")).first()[0]
    arrived = trades.groupBy(F.window("time", window).alias("span"), "symbol").agg(F.count(F.lit(1)).alias("arrived"))
    arrived = arrived.filter(F.col("span.end") <= F.lit(newest)).select("symbol", F.col("span.start").alias("start"), "arrived")
    both = arrived.join(bars.select("symbol", "start", "trades"), ["symbol", "start"], "left")
    return both.select("symbol", "start", (F.col("arrived") - F.coalesce("trades", F.lit(0))).alias("late")).filter("late > 0")


def stream_dedupe(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within ``delay`` of each other; on a table, all repeats."""
    if not stream.isStreaming:
        return dedupe(stream, keys)
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def first_arrivals(stream: DataFrame, keys: list[str], arrival: str, hold: int) -> DataFrame:
    """Of a batch's rows of a key the first to arrive, and none if the key came in the last ``hold`` seconds.

    Equal arrivals are ordered by content.  The state is one flag per key for ``hold`` seconds
    from its last row, so it grows with what arrives in that time and not with the history.
    Rows of a key are read in batches, whatever their number.
    """
    names = stream.columns
    # The clock of the batch is the event time, so no row is ever late, and a start ends with
    # its input (a timeout by processing time would keep it running).
    marked = stream.withColumns({"_digest": F.md5(F.to_json(F.struct(*names))), "_seen": F.current_timestamp()})
    marked = marked.withWatermark("_seen", "0 seconds").withColumn("_ms", F.unix_millis("_seen"))

    def pick(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        first, now = None, 0
        for frame in frames:
            now = max(now, int(frame["_ms"].max()))
            frame = frame if first is None else pd.concat([first, frame])
            first = frame.sort_values([arrival, "_digest"], kind="stable").head(1)
        if not state.exists and first is not None:
            yield first[names]
        state.update((True,))
        state.setTimeoutTimestamp(max(now, state.getCurrentWatermarkMs()) + hold * 1000)

    return marked.groupBy(*keys).applyInPandasWithState(pick, stream.schema, "seen boolean", "append", "EventTimeTimeout")


def among(column: str, values: list) -> Column:
    """Whether a column is one of ``values``, of which null may be one."""
    known = F.col(column).isin([v for v in values if v is not None])
    return known | F.col(column).isNull() if None in values else known


def append_new(batch: DataFrame, path: str, keys: list[str], partition_by: str) -> None:
    """Append the rows of ``batch`` whose key is not yet in the table at ``path``.

    Only partitions that the batch touches are looked up.  A batch that is run again after
    its write finds all its keys there and writes nothing.
    """
    spark = batch.sparkSession
    with scratch(spark):
        rows = stable(batch)
        if path_exists(spark, path):
            # One row per partition value of the batch, such as its calendar years.
            touched = [r[0] for r in rows.select(partition_by).distinct().collect()]
            old = spark.read.schema(rows.schema).parquet(path).filter(among(partition_by, touched)).select(*[F.col(k).alias(f"_{k}") for k in keys])
            same = [rows[k].eqNullSafe(old[f"_{k}"]) for k in keys]
            rows = rows.join(old, same, "left_anti")
        rows.write.mode("append").partitionBy(partition_by).parquet(path)


def land_once(
    stream: DataFrame, path: str, checkpoint: str, keys: list[str], arrival: str, partition_by: str, hold_days: float = 3,
) -> StreamingQuery:
    """Append each key of a stream once to the table at ``path``, however late it comes again.

    Keys of the last ``hold_days`` are known from the state; the few rows that pass are compared
    with the table itself.  The row kept is the first by ``arrival``, then by content, as long as
    the source hands out its files in order of arrival; how many make a batch changes nothing.
    ``partition_by`` must follow from the key.
    """
    fresh = first_arrivals(stream, keys, arrival, max(1, round(hold_days * 86_400)))
    return (
        fresh.writeStream.foreachBatch(lambda batch, _: append_new(batch, path, keys, partition_by))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )

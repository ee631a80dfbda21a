"""Streaming jobs, run over the given tables until their input is used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.session import scratch_path, stable
from millrace.sinks.files import write_envelopes, write_table
from millrace.streaming import bars as B, ingest as I
from registry.basics import rounded
from registry.book import query
from registry.fixtures import SYMBOLS

c = F.col


def trades(d):
    return d.events.select(
        c("event_type").alias("symbol"), c("value").alias("price"), c("user_id").cast("double").alias("size"), c("ts").alias("time")
    )


@query("str01_bars_from_trades", """
select event_type as symbol, cast(date_trunc('day', ts) as date) as day, min_by(value, (ts, value)) as open, max(value) as high, min(value) as low,
 max_by(value, (ts, value)) as close, sum(user_id) :: double as volume, count(*) as trades from events group by 1, 2""")
def _(d):
    return rounded(B.ohlcv(trades(d)).select(
        "symbol", c("start").cast("date").alias("day"), "open", "high", "low", "close", "volume", "trades"
    ))


@query("str02_ingest_envelopes", """
select symbol, cast(date_parsed as varchar) as date, cast(high as double) as high, cast(low as double) as low, cast(last as double) as last, volume, type from fx_bars""")
def _(d):
    src, dst = scratch_path(d.spark, "incoming"), scratch_path(d.spark, "landed")
    write_envelopes(d.fx_bars, src)
    # A second start finds nothing new: the checkpoint knows the files.
    for _ in range(2):
        I.ingest_envelopes(d.spark, src, dst, f"{dst}-checkpoint").awaitTermination()
    return d.spark.read.parquet(dst).select("symbol", "date", "high", "low", "last", "volume", "type")


# Five spans of days, each trade's day counted one later for every other user, so spans overlap
# by a day; users whose number ends in 3 are days late.
_SPAN = "least(4, cast((datediff(time, date '2024-01-01') + cast(size as int) % 2) / 6 as int))"


@query("str01_live_bars", """
select event_type as symbol, cast(date_trunc('day', ts) as date) as day, min_by(value, (ts, value)) filter (user_id % 10 <> 3) as open, max(value) filter (user_id % 10 <> 3) as high,
 min(value) filter (user_id % 10 <> 3) as low, max_by(value, (ts, value)) filter (user_id % 10 <> 3) as close, sum(user_id) filter (user_id % 10 <> 3) :: double as volume,
 count(*) filter (user_id % 10 <> 3) as trades, count(*) filter (user_id % 10 = 3) as late from events group by 1, 2""")
def _(d):
    """Trades in eight batches, out of order and some too late: final bars, and the late trades by window."""
    src, dst = scratch_path(d.spark, "trades"), scratch_path(d.spark, "live_bars")
    rows = trades(d).withColumn("time", c("time").cast("timestamp")).withColumn("span", F.expr(f"case when size % 10 = 3 then 7 else {_SPAN} end"))
    # Trades of another symbol days after the last one move the watermark on.
    steps = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(s).alias("span")) for k, s in ((1, 5), (2, 6), (3, 8))])).alias("step")
    ahead = rows.agg(F.max("time").alias("newest")).select("newest", steps).select(
        F.lit("~").alias("symbol"), F.lit(1.0).alias("price"), F.lit(1.0).alias("size"),
        (c("newest") + c("step.k") * F.expr("interval 10 days")).alias("time"), c("step.span").alias("span"))
    whole = stable(rows.union(ahead))
    for span in range(9):
        whole.filter(c("span") == span).drop("span").coalesce(1).write.mode("append").parquet(src)
    stream = d.spark.readStream.schema(whole.drop("span").schema).option("maxFilesPerTrigger", 1).parquet(src)
    B.bars_stream(stream, dst, f"{dst}-checkpoint").awaitTermination()
    bars = d.spark.read.parquet(dst)
    late = B.late_trades(d.spark.read.parquet(src), bars)
    out = bars.join(late, ["symbol", "start"], "full").filter("symbol <> '~'")
    return rounded(out.select(
        "symbol", c("start").cast("date").alias("day"), "open", "high", "low", "close", "volume",
        F.coalesce("trades", F.lit(0)).alias("trades"), F.coalesce("late", F.lit(0)).alias("late"),
    ))


_WAVES = """
select *, 1 as wave from fx_raw_bars where load_id = 1 and volume % 2 = 0 union all select *, 2 from fx_raw_bars where load_id = 2
union all select *, 3 from fx_raw_bars where load_id = 1 and volume % 2 = 1 union all select *, 4 from fx_raw_bars"""


@query("str03_stream_dedupe", f"""
select symbol, type, date, high, low, last, volume, wave from (select *, row_number() over (partition by symbol, date order by wave, load_id) as rn
 from ({_WAVES.replace('union all select *, 4 from fx_raw_bars', 'union all select *, 4 from fx_raw_bars where load_id = 1')})) where rn = 1""")
def _(d):
    """Bars that are sent again, changed or not, up to three days later; each is landed as it came first."""
    src, dst = scratch_path(d.spark, "raw_bars"), scratch_path(d.spark, "once")
    one, two = d.fx_raw_bars.filter("load_id = 1"), d.fx_raw_bars.filter("load_id = 2")
    for wave, rows in enumerate((one.filter("volume % 2 = 0"), two, one.filter("volume % 2 = 1"), one), 1):
        rows = rows.drop("load_id").withColumns({"wave": F.lit(wave), "arrival": F.timestamp_seconds(F.lit(wave * 86_400)), "year": F.year(c("date").cast("date"))})
        rows.repartition(2).write.mode("append").parquet(src)
    stream = d.spark.readStream.schema(d.spark.read.parquet(src).schema).option("maxFilesPerTrigger", 3).parquet(src)
    B.land_once(stream, dst, f"{dst}-checkpoint", ["symbol", "date"], "arrival", "year").awaitTermination()
    return d.spark.read.parquet(dst).select("symbol", "type", "date", "high", "low", "last", "volume", "wave")


@query("str04_upsert_by_year", "select symbol, type, date, high, low, last, volume, date_parsed, year from sv_bars")
def _(d):
    src, dst = scratch_path(d.spark, "loads"), scratch_path(d.spark, "clean_bars")
    stamped = d.fx_raw_bars.withColumn("ingestion_timestamp", F.timestamp_seconds(c("load_id")))
    for load in (1, 2):
        write_table(stamped.filter(c("load_id") == load).drop("load_id"), src, "append")
        stream = d.spark.readStream.schema(stamped.drop("load_id").schema).parquet(src)
        I.maintain_clean_bars(stream, dst, f"{dst}-checkpoint", SYMBOLS).awaitTermination()
    return I.current_bars(d.spark, dst).drop("ingestion_timestamp")


@query("str04_merged_log", "select symbol, type, date, high, low, last, volume, date_parsed, year from sv_bars")
def _(d):
    """A log that is merged after its first load and then goes on: only years of the second load are ranked."""
    path, merged = scratch_path(d.spark, "bar_log"), scratch_path(d.spark, "merged_log")
    stamped = d.fx_raw_bars.withColumn("ingestion_timestamp", F.timestamp_seconds(c("load_id")))
    I.append_bars(stamped.filter(c("load_id") == 1).drop("load_id"), path, SYMBOLS)
    I.compact_bars(d.spark, path, merged)
    I.append_bars(stamped.filter(c("load_id") == 2).drop("load_id"), merged, SYMBOLS)
    return I.current_bars(d.spark, merged).drop("ingestion_timestamp")


@query("str04_upsert_in_place", "select symbol, type, date, high, low, last, volume, date_parsed, year from sv_bars")
def _(d):
    """Two loads merged into the clean table, the second twice as a retried batch is."""
    path = scratch_path(d.spark, "clean_bars")
    stamped = d.fx_raw_bars.withColumn("ingestion_timestamp", F.timestamp_seconds(c("load_id")))
    for load in (1, 2, 2):
        I.upsert_by_year(stamped.filter(c("load_id") == load).drop("load_id"), path, SYMBOLS)
    return d.spark.read.parquet(path).drop("ingestion_timestamp")

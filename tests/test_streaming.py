"""Late data, restarts, archiving and idempotent upserts."""

import datetime as dt
import json
import os
import time

from pyspark.sql import functions as F

from millrace import schemas
from millrace.streaming import bars as B, ingest as I

c = F.col


def at(day, hour=0, minute=0):
    return dt.datetime(2024, 1, day, hour, minute)


def run_batches(spark, tmp_path, schema, batches, plan, mode="append"):
    """Feed each batch as one file; returns the rows written."""
    src, dst = tmp_path / "src", tmp_path / "dst"
    src.mkdir()
    for i, rows in enumerate(batches):
        stage = tmp_path / f"stage{i}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(stage))
        part = next(f for f in os.listdir(stage) if f.endswith(".parquet"))
        os.rename(stage / part, src / f"{i}.parquet")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
        plan(stream).writeStream.format("parquet").outputMode(mode).option("path", str(dst)).option(
            "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(str(dst))


def test_late_trades_and_window_edges(spark, tmp_path):
    batches = [
        [("A", 10.0, 1.0, at(1, 1)), ("A", 12.0, 2.0, at(1, 23, 59)), ("A", 9.0, 1.0, at(2))],
        [("A", 5.0, 1.0, at(9))],  # moves the watermark to day 6
        [("A", 99.0, 1.0, at(1, 2)), ("A", 6.0, 1.0, at(8))],  # day 1 is final: dropped; day 8 is not
        [("A", 7.0, 1.0, at(20))],
        [("A", 7.0, 1.0, at(30))],
    ]
    out = run_batches(spark, tmp_path, schemas.TRADE, batches, lambda s: B.ohlcv(s, "1 day", "3 days"))
    got = {r.start.day: (r.open, r.high, r.low, r.close, r.volume, r.trades) for r in out.collect()}
    assert got[1] == (10.0, 12.0, 10.0, 12.0, 3.0, 2)
    assert got[2] == (9.0, 9.0, 9.0, 9.0, 1.0, 1)
    assert got[8][:1] == (6.0,) and got[9][:1] == (5.0,) and got[20][:1] == (7.0,)


def test_repeats_within_the_delay_are_dropped(spark, tmp_path):
    schema = "symbol string, date string, time timestamp"
    batches = [[("A", "d1", at(1)), ("A", "d1", at(1))], [("A", "d1", at(2)), ("A", "d2", at(2))]]
    out = run_batches(spark, tmp_path, schema, batches, lambda s: B.stream_dedupe(s, ["symbol", "date"], "time", "5 days"))
    assert sorted((r.symbol, r.date) for r in out.collect()) == [("A", "d1"), ("A", "d2")]


def test_late_trades_are_counted(spark, tmp_path):
    batches = [
        [("A", 10.0, 1.0, at(1, 1)), ("B", 1.0, 1.0, at(2))],
        [("A", 5.0, 1.0, at(9))],
        [("A", 6.0, 1.0, at(20))],
        [("A", 99.0, 1.0, at(1, 2)), ("A", 99.0, 1.0, at(1, 3)), ("C", 7.0, 1.0, at(2)), ("A", 5.0, 1.0, at(21))],
        [("A", 7.0, 1.0, at(30))],
    ]
    bars = run_batches(spark, tmp_path, schemas.TRADE, batches, lambda s: B.ohlcv(s, "1 day", "3 days"))
    late = B.late_trades(spark.read.parquet(str(tmp_path / "src")), bars)
    assert sorted((r.symbol, r.start.day, r.late) for r in late.collect()) == [("A", 1, 2), ("C", 2, 1)]


def land(spark, folder, files, per_batch, hold_days=3.0, pause=0.0):
    """Files of (symbol, date, value, arrival day) landed once; the rows, and the state's size after each start."""
    schema = "symbol string, date string, value int, arrival timestamp, year int"
    src, dst, sizes = str(folder / "src"), str(folder / "dst"), []
    for rows in files:
        spark.createDataFrame([(s, d, v, at(a), int(d[:4]) if d else None) for s, d, v, a in rows], schema).coalesce(1).write.mode("append").parquet(src)
        if per_batch is None:  # a start for each file
            stream = spark.readStream.schema(schema).parquet(src)
            q = B.land_once(stream, dst, f"{dst}-cp", ["symbol", "date"], "arrival", "year", hold_days)
            q.awaitTermination()
            sizes.append(q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
            time.sleep(pause)
    if per_batch is not None:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(src)
        B.land_once(stream, dst, f"{dst}-cp", ["symbol", "date"], "arrival", "year", hold_days).awaitTermination()
    return sorted((r.symbol, r.date or "", r.value) for r in spark.read.parquet(dst).collect()), sizes


WAVES = [
    [("A", "2020-01-01", 1, 1), ("A", "2020-01-01", 2, 1), ("B", "2021-01-01", 3, 2), ("C", None, 4, 2)],
    [("A", "2020-01-01", 9, 3), ("B", "2021-01-02", 5, 3), ("C", None, 8, 3)],
    [("B", "2021-01-02", 7, 4), ("D", "1999-01-01", 6, 4), ("B", "2021-01-02", 6, 4)],
]


def test_each_key_lands_once_however_files_are_batched(spark, tmp_path):
    want = None
    for n in (1, 2, 3):
        (tmp_path / str(n)).mkdir()
        got, _ = land(spark, tmp_path / str(n), WAVES, n)
        want = want or got
        assert got == want
    assert [(s, d) for s, d, _ in want] == [("A", "2020-01-01"), ("B", "2021-01-01"), ("B", "2021-01-02"), ("C", ""), ("D", "1999-01-01")]
    assert [v for *_, v in want][1:] == [3, 5, 4, 6] and want[0][2] in (1, 2)


def test_state_forgets_and_the_table_does_not(spark, tmp_path):
    days = [[(f"S{i}", f"2020-01-{1 + k:02d}", k, k + 1) for i in range(40)] for k in range(3)]
    rows, sizes = land(spark, tmp_path, [*days, days[0], days[0][:1]], None, hold_days=1 / 86_400, pause=2.0)
    assert len(rows) == 120  # the first day came twice, long after its keys had left the state
    assert max(sizes) <= 80 and sizes[-1] <= 41, sizes


def test_a_batch_written_twice_lands_once(spark, tmp_path):
    rows = spark.createDataFrame([("A", "2020-01-01", 2020), ("B", None, None)], "symbol string, date string, year int")
    for _ in range(2):
        B.append_new(rows, str(tmp_path / "t"), ["symbol", "date"], "year")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def envelope(symbol, *bars, kind="STOCK"):
    return json.dumps({"symbol": symbol, "type": kind, "bars": [
        {"t": f"2024-01-{d:02d}T05:00:00Z", "h": p + 1, "l": p - 1, "c": p, "v": 10} for d, p in bars
    ]}, indent=1)


def test_ingest_restart_and_archive(spark, tmp_path):
    src, dst, cp, archive = (str(tmp_path / n) for n in ("in", "out", "cp", "old"))
    os.mkdir(src)
    go = lambda: I.ingest_envelopes(spark, src, dst, cp, archive).awaitTermination()
    (tmp_path / "in" / "a.json").write_text(envelope("AAPL", (2, 10.0), (3, 11.0)))
    go()
    go()  # nothing new
    assert spark.read.parquet(dst).count() == 2
    (tmp_path / "in" / "b.json").write_text(envelope("BTC/USD", (2, 5.0), kind="CRYPTO"))
    go()
    (tmp_path / "in" / "c.json").write_text(envelope("AAPL", (4, 5.0)))
    go()
    rows = spark.read.parquet(dst)
    assert rows.count() == 4 and rows.filter("source_file is null or ingestion_timestamp is null").count() == 0
    moved = [f for _, _, fs in os.walk(archive) for f in fs if f.endswith(".json")]
    assert "a.json" in moved and "c.json" not in moved


def test_upsert_touches_only_its_years(spark, tmp_path):
    path = str(tmp_path / "bars")
    ddl = "symbol string, type string, date string, high double, low double, last double, volume long, ingestion_timestamp timestamp"
    load = lambda *rows: spark.createDataFrame([(s, "STOCK", d, 2.0, 1.0, p, 5, at(day)) for s, d, p, day in rows], ddl)
    I.upsert_by_year(load(("AAPL", "2023-05-01", 1.0, 1), ("AAPL", "2024-05-01", 1.0, 1)), path)
    before = set(os.listdir(f"{path}/year=2023"))
    second = load(("AAPL", "2024-05-01", 2.0, 2), ("MSFT", "2024-05-02", 3.0, 2))
    for _ in range(2):  # a retried batch changes nothing
        I.upsert_by_year(second, path)
    I.upsert_by_year(load(("AAPL", "2024-05-01", 9.0, 1)), path)  # older than what is there
    got = sorted((r.symbol, r.date, r["last"], r.year) for r in spark.read.parquet(path).collect())
    assert got == [("AAPL", "2023-05-01", 1.0, 2023), ("AAPL", "2024-05-01", 2.0, 2024), ("MSFT", "2024-05-02", 3.0, 2024)]
    assert set(os.listdir(f"{path}/year=2023")) == before
    for _ in range(2):  # a bar without a readable date stays, once
        I.upsert_by_year(load(("AAPL", "bad", 3.0, 2)), path)
    undated = [(r.symbol, r.date, r.year) for r in spark.read.parquet(path).filter("year is null").collect()]
    assert undated == [("AAPL", "bad", None)] and spark.read.parquet(path).count() == 4


def test_appended_bars_survive_a_broken_batch(spark, tmp_path):
    path, compacted = str(tmp_path / "log"), str(tmp_path / "compacted")
    ddl = "symbol string, type string, date string, high double, low double, last double, volume long, ingestion_timestamp timestamp"
    load = lambda *rows: spark.createDataFrame([(s, "STOCK", d, 2.0, 1.0, p, 5, at(day)) for s, d, p, day in rows], ddl)
    I.append_bars(load(("AAPL", "2023-05-01", 1.0, 1), ("AAPL", "2024-05-01", 1.0, 1)), path)
    first = {os.path.join(r, f) for r, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    second = [("AAPL", "2024-05-01", 2.0, 2), ("MSFT", "2024-05-02", 3.0, 2), ("AAPL", "bad", 3.0, 2)]
    I.append_bars(load(*second[:1]), path)  # dies after a part of the batch
    I.append_bars(load(*second), path)  # the batch again, as a whole
    I.append_bars(load(("AAPL", "2024-05-01", 9.0, 1)), path)  # older than what is there
    assert all(os.path.exists(f) for f in first)
    want = [("AAPL", "2023-05-01", 1.0, 2023), ("AAPL", "2024-05-01", 2.0, 2024), ("AAPL", "bad", 3.0, None), ("MSFT", "2024-05-02", 3.0, 2024)]
    rows = lambda df: sorted((r.symbol, r.date, r["last"], r.year) for r in df.collect())
    assert rows(I.current_bars(spark, path)) == want
    assert rows(I.compact_bars(spark, path, compacted)) == want and spark.read.parquet(compacted).count() == 4
    one_year = I.current_bars(spark, path).filter("year = 2024")
    assert "PartitionFilters: [isnotnull(year" in one_year._jdf.queryExecution().toString()
    assert rows(one_year) == [want[1], want[3]]
    # After a merge only the years that something was added to are ranked, the undated ones among them.
    merged = I.current_bars(spark, compacted)
    assert rows(merged) == want and "Window" not in merged._jdf.queryExecution().optimizedPlan().toString()
    I.append_bars(load(("AAPL", "2024-05-01", 7.0, 3), ("AAPL", "bad", 4.0, 3), ("MSFT", "2025-01-02", 8.0, 3)), compacted)
    newer = [want[0], ("AAPL", "2024-05-01", 7.0, 2024), ("AAPL", "bad", 4.0, None), want[3], ("MSFT", "2025-01-02", 8.0, 2025)]
    assert rows(I.current_bars(spark, compacted)) == sorted(newer, key=lambda r: r[:2])
    assert rows(I.current_bars(spark, compacted).filter("year = 2023")) == [want[0]]


def test_audit_and_sweep(spark, tmp_path):
    src, dst, cp, archive = (str(tmp_path / n) for n in ("in put", "out", "cp", "old"))
    os.makedirs(f"{src}/x=1 2")
    go = lambda: I.ingest_envelopes(spark, src, dst, cp).awaitTermination()
    (tmp_path / "in put" / "a.json").write_text(envelope("AAPL", (2, 10.0), (3, 11.0)))
    (tmp_path / "in put" / "x=1 2" / "b+c.json").write_text(envelope("MSFT", (2, 10.0)))
    go()
    (tmp_path / "in put" / "late.json").write_text(envelope("AAPL", (4, 5.0)))
    files = lambda: sorted((r.file, r.rows, r.in_place, r.archived) for r in I.audit_files(spark, src, dst, archive).collect())
    assert files() == [("a.json", 2, True, False), ("late.json", 0, True, False), ("x=1 2/b+c.json", 1, True, False)]
    assert I.sweep_landed(spark, src, dst, archive) == 2 and I.sweep_landed(spark, src, dst, archive) == 0
    assert files() == [("a.json", 2, False, True), ("late.json", 0, True, False), ("x=1 2/b+c.json", 1, False, True)]
    assert os.path.exists(f"{archive}/x=1 2/b+c.json")
    go()
    assert files()[1] == ("late.json", 1, True, False) and spark.read.parquet(dst).count() == 4

"""Hand-made tables for what the given tables do not contain."""

import datetime as dt
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace import lookups, schemas
from millrace.functions import dates, paths, text as X
from millrace.operators import quality
from millrace.operators.rows import conform, dedupe, stack, top_per_key, year_over_year, year_over_year_pairs
from millrace.plans import clean, documents, metrics, star
from millrace.sources import files, landing

c = F.col


def values(df, *cols):
    return sorted([tuple(r) for r in df.select(*cols).collect()], key=repr)


REGIONS = [
    (1, "state", "Ohio"), (2, "state", "Atlantis"), (3, "metro", "Dayton, Springfield, OH"), (4, "metro", "Toledo"),
    (5, "metro", "Toledo;OH"), (6, "county", "Lucas"), (7, "county", "Lucas; OH ;Toledo, OH"), (8, "city", "Lima;OH;nan;Allen"),
    (9, "city", "Lima;OH"), (10, "zip", "nan;OH;Toledo, OH;Lucas"), (11, "zip", "45801"), (12, "neigh", "Old;OH;nan;Lima;Allen"),
    (13, "neigh", "Old;OH"), (14, None, "x;OH"), (15, "city", None), (16, "planet", "Mars;MA"),
]


def test_region_paths(spark):
    df = spark.createDataFrame(REGIONS, "region_id int, region_type string, region string")
    cols = ["state_code", "state_name", "metro_name", "county_name", "city_name", "zip_key", "neighborhood_name"]
    rows = {r.region_id: tuple(r[x] for x in cols) for r in star.decode_region(df, lookups.states(spark)).collect()}
    assert rows[1] == ("OH", "Ohio", None, None, None, None, None)
    assert rows[2] == (None,) * 7
    assert rows[3] == ("OH", "Ohio", "Dayton, Springfield", None, None, None, None)
    assert rows[4] == (None, None, "Toledo", None, None, None, None)
    assert rows[5] == ("OH", "Ohio", "Toledo;OH", None, None, None, None)
    assert rows[6] == (None, None, None, "Lucas", None, None, None)
    assert rows[7] == (" OH ", "Ohio", "Toledo", "Lucas", None, None, None)
    assert rows[8] == ("OH", "Ohio", None, "Allen", "Lima", None, None)
    assert rows[9] == ("OH", "Ohio", None, None, "Lima", None, None)
    assert rows[10] == ("OH", "Ohio", "Toledo", "Lucas", "Lucas", "00000", None)
    assert rows[11] == (None, None, None, None, None, "45801", None)
    assert rows[12] == ("OH", "Ohio", None, "Allen", "Lima", None, "Old")
    assert rows[13] == ("OH", "Ohio", None, None, None, None, "Old")
    assert rows[14] == rows[15] == rows[16] == (None,) * 7


NUMBERS = [0.0, -0.005, 0.125, 2.675, 2.5, 1.005, 999999.995, 1e6, 1e9, 1e12, -1e6, -1e9, -1e12, -2.675, 123456789.125, 0.375]


def test_number_text_equals_python(spark):
    df = spark.createDataFrame([(x,) for x in NUMBERS], "x double").select(
        "x", X.fmt(c("x")).alias("two"), X.fmt(c("x"), 2, True).alias("comma"), X.fmt(c("x"), 0, True).alias("whole"),
        X.magnitude(c("x")).alias("mag"),
    )
    for r in df.collect():
        assert (r.two, r.comma, r.whole) == (f"{r.x:.2f}", f"{r.x:,.2f}", f"{r.x:,.0f}")
        for size, word in ((1e12, "trillion"), (1e9, "billion"), (1e6, "million")):
            if r.x >= size:
                assert r.mag == f"{r.x / size:.2f} {word}"
                break
        else:
            assert r.mag == f"{r.x:,.2f}"


def test_random_number_text_equals_python(spark):
    rng = random.Random(4)
    numbers = [rng.uniform(-1, 1) * 10 ** rng.randint(-3, 11) for _ in range(3000)]
    numbers += [round(rng.uniform(0, 1000), 3) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in numbers], "x double").select(
        "x", X.fmt(c("x")).alias("two"), X.fmt(c("x"), 0, True).alias("whole"), X.fmt(c("x"), 3).alias("three")
    )
    for r in df.collect():
        assert (r.two, r.whole, r.three) == (f"{r.x:.2f}", f"{r.x:,.0f}", f"{r.x:.3f}")


def test_exact_quartiles(spark):
    from millrace.operators.profile import summary

    for numbers in ([3.0], [1.0, 2.0], [5.0, 1.0, 1.0, 2.0, 8.0, 9.5, 1.0], [float(i % 17) for i in range(1000)]):
        df = spark.createDataFrame([(x,) for x in numbers] + [(None,)], "x double").repartition(3)
        r = summary(df, ["x"]).first()
        assert r["count"] == len(numbers)
        assert (r.q25, r.q50, r.q75) == pytest.approx(tuple(np.percentile(numbers, [25, 50, 75])))
    r = summary(spark.createDataFrame([(None,)], "x double"), ["x"]).first()
    assert r["count"] == 0 and r.q50 is None


def test_units_and_nulls(spark):
    df = spark.createDataFrame(
        [(None, "DAYS"), (2.5, "DAYS"), (-3.0, "USD_CURRENT"), (1234.5, "UNITS"), (7.0, "PERCENTAGE"), (1.0, None)], "v double, u string"
    ).select(X.by_unit(c("v"), c("u")).alias("t"), X.housing_unit_words(c("u")).alias("w"))
    assert [tuple(r) for r in df.collect()] == [
        ("N/A", "days"), ("2 days", "days"), ("$-3.00", "US dollars"), ("1,234.50", "units"), ("7.00%", "percent"), ("1.00", "units")
    ]


def test_pct_change_guards(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, -2.0), (3.0, 2.0), (1.0, None)], "a double, b double").select(
        X.pct_change(c("a"), c("b")).alias("any"), X.pct_change(c("a"), c("b"), True).alias("pos")
    )
    assert [tuple(r) for r in df.collect()] == [(0.0, 0.0), (-150.0, 0.0), (50.0, 50.0), (0.0, 0.0)]


def test_bad_dates_and_numbers_become_null(spark):
    df = spark.createDataFrame([("2024-02-30",), ("",), ("2024-02-29",), (None,), ("soon",)], "t string")
    got = [r[0] for r in df.select(dates.parse_day(c("t"))).collect()]
    assert got == [None, None, dt.date(2024, 2, 29), None, None]
    assert [r[0] for r in df.select(c("t").try_cast("int")).collect()] == [None] * 5


def test_dedupe_is_total_and_keeps_null_keys(spark):
    rows = [("a", 1, None), ("a", 2, 5.0), ("a", 2, 4.0), ("b", 1, 1.0), ("b", 1, 1.0), (None, 1, 2.0), (None, 3, 2.0)]
    for n in (1, 5):
        df = spark.createDataFrame(rows, "k string, load int, v double").repartition(n)
        assert values(dedupe(df, ["k"], [F.desc("load")]), "k", "load", "v") == sorted(
            [("a", 2, 4.0), ("b", 1, 1.0), (None, 3, 2.0)], key=repr
        )


def test_bad_duplicate_never_wins(spark):
    raw = spark.createDataFrame([
        ("AAPL", "STOCK", "2024-01-02", 2.0, 1.0, 1.5, 10, 1), ("AAPL", "STOCK", "2024-01-02", 2.0, 1.0, None, 10, 2),
        ("AAPL", None, "2024-01-03", 2.0, 1.0, 1.5, 0, 1), ("BTC/USD", None, "2024-01-03", 2.0, 1.0, 1.5, 4, 1),
        ("AAPL", "STOCK", "oops", 2.0, 1.0, 1.5, 4, 1), ("ZZZ", "STOCK", "2024-01-03", 2.0, 1.0, 1.5, 4, 1),
    ], "symbol string, type string, date string, high double, low double, last double, volume long, load int")
    got = values(clean.clean_bars(raw, newest="load"), "symbol", "type", "date", "date_parsed", "year", "last")
    assert got == [
        ("AAPL", "STOCK", "2024-01-02", dt.date(2024, 1, 2), 2024, 1.5), ("AAPL", "STOCK", "oops", None, None, 1.5),
        ("BTC/USD", "CRYPTO", "2024-01-03", dt.date(2024, 1, 3), 2024, 1.5),
    ]


def test_clean_indicators_bad_rows(spark):
    raw = spark.createDataFrame([
        ("S", "X", "Land", 2014, "1.5"), ("S", "X", "Land", 2014, "1.5"), ("S", "X", "Land", 2015, "junk"),
        (None, "X", "Land", 2014, "1"), ("S", "Y", "Sea", None, "1"), ("T", "X", "Land", 2014, "2"),
    ], "series_id string, country_code string, country_name string, year int, value string")
    meta = spark.createDataFrame([("S", "Name", "About"), ("S", None, "x"), ("T", None, "y")], "series_id string, name string, description string")
    got = values(clean.clean_indicators(raw, meta), "series_id", "country_code", "year", "value", "indicator_name")
    assert got == [("S", "X", 2014, Decimal("1.5000000000"), "Name"), ("T", "X", 2014, Decimal("2.0000000000"), None)]


def test_year_over_year_needs_consecutive_years(spark):
    rows = [("a", 2014, 0.0), ("a", 2015, 2.0), ("a", 2017, 5.0), ("a", 2018, 6.0), ("b", 2014, 1.0)]
    df = spark.createDataFrame(rows, "k string, year int, v double")
    want = [("a", 2015, 2014, 2.0, 0.0), ("a", 2018, 2017, 6.0, 5.0)]
    cols = ("k", "year", "prev_year", "v", "prev_v")
    assert values(year_over_year(df, ["k"], "year", ["v"]), *cols) == want
    assert values(year_over_year_pairs(df, ["k"], "year", ["v"]), *cols) == want
    twice = df.unionByName(spark.createDataFrame([("a", 2014, 9.0)], df.schema))
    assert len(values(year_over_year_pairs(twice, ["k"], "year", ["v"]), *cols)) == 3


def test_asset_facts_drop_null_columns(spark):
    full = ("A", dt.date(2024, 1, 2), 2.0, 1.0, 1.5, 10)
    rows = [full] + [tuple(None if i == j else v for j, v in enumerate(full)) for i in range(6)]
    bars = spark.createDataFrame(
        [(*r, "STOCK") for r in rows], "symbol string, date_parsed date, high double, low double, last double, volume long, type string"
    )
    dim = star.dim_asset_value(bars)
    times = spark.createDataFrame([(dt.date(2024, 1, 2),)], "date_key date")
    facts = star.fact_asset(bars, dim, star.dim_asset(bars), times)
    assert facts.count() == 1


def test_value_dimension_numbers_by_md5(spark):
    import hashlib

    ind = spark.createDataFrame([("X", Decimal(i)) for i in range(300)], "series_id string, value decimal(30,10)")
    house = spark.createDataFrame([("LRAW", Decimal(i)) for i in range(200)], "indicator_id string, value decimal(30,10)")
    dim = star.dim_value(ind, house, lookups.series_units(spark), lookups.housing_units(spark)).collect()
    md5 = lambda r: hashlib.md5(f"{r.value:f}||{r.unit}".encode()).hexdigest()
    assert [r.value_key for r in sorted(dim, key=md5)] == list(range(1, 501))


def test_country_one_name_per_code(spark):
    ind = spark.createDataFrame([("A", "Land"), ("A", "Other"), ("USA", "United States"), (None, "x")], "country_code string, country_name string")
    got = values(star.dim_country(ind), "country_code", "country_name")
    assert got == [("A", "Land"), ("USA", "United States")]


def test_envelopes_empty_and_untyped(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{\n "symbol": "AAPL",\n "type": "STOCK",\n "bars": [\n  {"t": "2024-01-02T05:00:00Z", "h": 2, "l": 1, "c": 1.5, "v": 0}\n ]\n}'
    )
    (tmp_path / "b.json").write_text('{"symbol": "AAPL", "bars": [{"t": "2024-01-03T05:00:00Z", "h": 3, "l": 1, "c": 2.5, "v": 7}]}')
    (tmp_path / "c.json").write_text('{"symbol": "ETH/USD", "type": null, "bars": []}')
    env = files.read_envelopes(spark, f"{tmp_path}/*.json")
    assert env.count() == 3
    got = values(landing.merge_pages(env), "symbol", "type", "date", "last", "volume")
    assert got == [("AAPL", "STOCK", "2024-01-02", 1.5, 0), ("AAPL", "STOCK", "2024-01-03", 2.5, 7)]


def test_csv_bad_fields_become_null(spark, tmp_path):
    (tmp_path / "x.csv").write_text("indicator_id,region_id,date,value\nLRAW,12,2020-01-04,1.5\nLRAW,x,2020-13-01,1\n")
    got = values(files.read_csv(spark, str(tmp_path / "x.csv"), schemas.HOUSING_CSV), "region_id", "date", "value")
    assert got == sorted([(12, dt.date(2020, 1, 4), Decimal("1.5000000000")), (None, None, Decimal("1.0000000000"))], key=repr)


def test_crypto_codes_pass_through_and_truncate(spark):
    raw = spark.createDataFrame([("BTCUSD", "2020-01-01", 1.0, 1.0, 1.0, 7.9), ("XYZ", "2020-01-01", 1.0, 1.0, 1.0, -7.9)],
                                "code string, date string, high double, low double, last double, volume double")
    got = values(landing.crypto_rows(raw, lookups.crypto_codes(spark)), "symbol", "volume", "type")
    assert got == [("BTC/USD", 7, "CRYPTO"), ("XYZ", -7, "CRYPTO")]


def test_quality_checks_find_what_is_wrong(spark):
    dim = spark.createDataFrame([(1, "STOCK"), (1, "ORE"), (None, "CRYPTO"), (2, None)], "k int, type string")
    assert values(quality.duplicate_keys(dim, ["k"]), "k", "n") == [(1, 2), (None, 1)]
    fact = spark.createDataFrame([(1,), (3,), (3,), (None,)], "fk int")
    assert values(quality.orphans(fact, dim, "fk", "k"), "fk", "n") == [(3, 2)]
    assert values(quality.bad_domain(dim, "type", ["STOCK", "CRYPTO"]), "k", "type") == [(1, "ORE")]
    rows = spark.createDataFrame([("s", None, None), ("s", "r", None), (None, None, None)], """
        socioeconomical_indicator_key string, realestate_indicator_key string, asset_key string""")
    assert quality.key_family_violations(rows, schemas.FACT_FAMILIES).count() == 2


def test_union_by_name_pads_and_casts(spark):
    a = spark.createDataFrame([(1, "x")], "region_key bigint, asset_key string")
    b = spark.createDataFrame([(dt.date(2024, 1, 1),)], "date_key date")
    got = conform(stack(a, b), schemas.FACT)
    assert got.schema.simpleString() == schemas.FACT.simpleString()
    assert got.count() == 2


def test_location_phrase_skips_what_is_unknown(spark):
    cols = "neighborhood_name county_name city_name metro_name state_name state_code zip_key country_name country_code".split()
    ddl = ", ".join(f"{n} string" for n in cols)
    df = spark.createDataFrame([(None, "Lucas", "", None, "Ohio", "OH", None, "United States", "USA"), (None,) * 9], ddl)
    got = [r[0] for r in df.select(documents.location_phrase()).collect()]
    assert got == ["Lucas County, state of Ohio, state code OH, United States (USA)", "an unspecified place"]


def test_trend_needs_three_points(spark):
    df = spark.createDataFrame([("a", 2014, 0.0), ("a", 2016, 5.0), ("a", 2015, 4.0), ("b", 2014, 1.0), ("b", 2015, 2.0)], "k string, year int, v double")
    r = metrics.trend(df, ["k"], "year", "v").collect()
    assert [(x.k, x.start_year, x.end_year, x.start_value, x.end_value, x.points, x.change_pct) for x in r] == [("a", 2014, 2016, 0.0, 5.0, 3, 0.0)]


@pytest.mark.parametrize("salts", [0, 4])
def test_top_per_key_with_one_hot_key(spark, salts):
    df = spark.range(20000).select(F.when(c("id") % 3 == 0, 0).otherwise(c("id")).alias("k"), "id").repartition(7)
    top = top_per_key(df, ["k"], [F.desc("id")], 5, salts=salts)
    assert [r.id for r in top.filter("k = 0").orderBy("rank").collect()] == [19998 - 3 * i for i in range(5)]
    assert top.count() == 5 + sum(1 for i in range(20000) if i % 3)


def test_lookup_of_last_comma(spark):
    df = spark.createDataFrame([("a, b, c",), ("a",), (",",), ("",), (None,), ("x\ny, z",)], "t string")
    got = [tuple(r) for r in df.select(paths.before_last_comma(c("t")), paths.after_last_comma(c("t"))).collect()]
    assert got == [("a, b", "c"), ("a", "a"), ("", ""), ("", ""), (None, None), ("x\ny", "z")]


def test_keys_beyond_int(spark):
    from datetime import date

    from millrace import schemas
    from millrace.operators.rows import conform
    from millrace.plans import star

    bars = spark.createDataFrame(
        [("A", date(2020, 1, 1), 2.0, 1.0, 5.0, 1.5), ("A", date(2020, 1, 2), None, 1.0, 5.0, 1.5)],
        "symbol string, date_parsed date, high double, low double, volume double, last double").withColumn("type", F.lit("STOCK"))
    values = star.dim_asset_value(bars, "bigint")
    assert dict(values.dtypes)["cryptostock_value_key"] == "bigint"
    moved = values.withColumn("cryptostock_value_key", F.col("cryptostock_value_key") + 2**31)
    times = bars.select(F.col("date_parsed").alias("date_key"))
    found = star.fact_distinct_bars(moved, star.dim_asset(bars), times)
    facts = star.fact_value(found, key_type="bigint")
    assert [r.cryptostock_value_key for r in facts.collect()] == [r.cryptostock_value_key for r in moved.filter("high is not null").collect()]
    assert facts.first().cryptostock_value_key > 2**31
    assert conform(found, schemas.fact("bigint")).schema["value_key"].dataType.simpleString() == "bigint"


def test_published_versions(spark, tmp_path):
    from millrace.sinks.files import publish

    one = publish({"dim_asset": spark.sql("select 'A' as asset_key, 'STOCK' as type")}, str(tmp_path))["dim_asset"]
    two = publish({"dim_asset": spark.sql("select 'B' as asset_key, 'STOCK' as type")}, str(tmp_path))["dim_asset"]
    assert (one.first().asset_key, two.first().asset_key) == ("A", "B")


def test_scratch_is_emptied(spark, tmp_path, monkeypatch):
    import os

    from millrace import session

    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    with session.scratch(spark):
        assert session.stable(spark.range(3)).count() == 3
        with session.scratch(spark):
            session.stable(spark.range(2))
    assert os.listdir(tmp_path) == []


def test_countries_of_one_hash_get_keys_of_their_own(spark):
    from millrace.functions.hashing import hash_key
    from millrace.operators.keys import unique_hash_key
    from millrace.plans.star import dim_country

    codes = spark.range(300_000).select(F.concat(F.lit("C"), "id").alias("code")).withColumn("h", hash_key(F.col("code")))
    pairs = codes.groupBy("h").agg(F.sort_array(F.collect_list("code")).alias("codes")).filter("size(codes) > 1").collect()
    assert pairs
    one, two = pairs[0]["codes"][:2]
    rows = spark.createDataFrame([(one, "One"), (two, "Two"), ("X", "Other"), (None, "None")], "country_code string, country_name string")
    keys = {r.country_code: r.country_key for r in dim_country(rows).collect()}
    assert set(keys) == {one, two, "X", "USA"} and len(set(keys.values())) == 4 and keys[one] == pairs[0]["h"]
    later = {r.country_code: r.country_key for r in dim_country(rows, default=(two, "Two")).collect()}
    assert later[two] == pairs[0]["h"] != later[one]
    whole = unique_hash_key(codes.drop("h"), "code", "key")
    assert whole.select("key").distinct().count() == 300_000
    assert whole.filter(hash_key(F.col("code")) == F.col("key")).count() == 300_000 - sum(len(p["codes"]) - 1 for p in pairs)


def test_types_are_told_from_all_values(spark, tmp_path):
    import duckdb

    from millrace.sources.files import read_csv_typed

    rows = [("1", "1.5", "2020-02-29", "2020-01-01 10:00:00", "true", "007", "x", "", "12"), ("-20", "2", "1999-12-31", "2021-05-05 00:00:01", "false", "12", " y", "", "3.5e3"),
            ("", "", "", "", "", "1", "3", "", "")]
    path = tmp_path / "t.csv"
    path.write_text("\n".join(["i,d,day,at,flag,code,text,none,mixed", *(",".join(r) for r in rows)]) + "\n")
    df = read_csv_typed(spark, str(path), "typed_file")
    assert dict(df.dtypes) == {"i": "bigint", "d": "double", "day": "date", "at": "timestamp", "flag": "boolean", "code": "string", "text": "string", "none": "string", "mixed": "double"}
    assert spark.sql("select sum(i), max(day), count(flag), sum(mixed) from typed_file").first()[:] == (-19, dt.date(2020, 2, 29), 2, 3512.0)
    told = {n: t for n, t, *_ in duckdb.sql(f"describe select * from read_csv('{path}')").fetchall()}
    for name, kind in (("i", "BIGINT"), ("d", "DOUBLE"), ("day", "DATE"), ("at", "TIMESTAMP"), ("flag", "BOOLEAN"), ("text", "VARCHAR"), ("mixed", "DOUBLE")):
        assert told[name] == kind
    bad = tmp_path / "bad.csv"
    bad.write_text("day,n\n2021-02-30,1\n2021-01-01,99999999999999999999\n")
    assert dict(read_csv_typed(spark, str(bad)).dtypes) == {"day": "string", "n": "double"}
    empty = tmp_path / "empty.csv"
    empty.write_text("a,b\n")
    assert dict(read_csv_typed(spark, str(empty)).dtypes) == {"a": "string", "b": "string"}

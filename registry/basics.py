"""Sources, sinks, projections, filters, joins, aggregates, windows, sorts, sets, scalars."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window as W, functions as F, types as T

from millrace import lookups, schemas
from millrace.functions import dates, hashing, paths, text as X
from millrace.operators import lookup, predicates as P, profile, rows
from millrace.operators.rows import conform, dedupe, stack, stack_distinct
from millrace.plans import clean, metrics, star
from millrace.session import scratch_path
from millrace.sinks import files as sinks
from millrace.sources import files as sources, landing
from registry.book import query
from registry.fixtures import HOUSING_CODES, SYMBOLS, _in
from registry.lake import silver, units

BAR_COLS = "symbol, type, date_parsed, high, low, last, volume"


# -- sources ------------------------------------------------------------------

@query("src01_csv_round_trip", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def _(d):
    path = scratch_path(d.spark, "csv")
    customer = d.customer
    customer.write.option("header", True).csv(path)
    return sources.read_csv(d.spark, path, customer.schema)


def _envelope_files(d):
    path = scratch_path(d.spark, "envelopes")
    sinks.write_envelopes(d.fx_bars, path)
    return path


@query("src02_envelope_json", """
select symbol, type, cast(year(date_parsed) as int) as page, count(*) as bars, cast(sum(volume) as bigint) as volume, min(cast(date_parsed as varchar)) as first_day
from fx_bars group by all""")
def _(d):
    env = sources.read_envelopes(d.spark, f"{_envelope_files(d)}/*/*/*.json")
    days = F.transform("bars", lambda b: b["t"])
    return env.select(
        "symbol", "type", F.substring(F.array_min(days), 1, 4).cast("int").alias("page"),
        F.size("bars").cast("long").alias("bars"),
        F.aggregate("bars", F.lit(0).cast("long"), lambda acc, b: acc + b["v"]).alias("volume"),
        F.array_min(days).alias("first_day"),
    )


@query("src03_table_scan", "select o_orderkey, o_custkey, o_totalprice from orders where o_orderdate >= timestamp '1998-01-01' and o_orderstatus = 'F'")
def _(d):
    where = (F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp")) & (F.col("o_orderstatus") == "F")
    return sources.read_table(d.spark, f"{d.sf_dir}/orders.parquet", where).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query("src04_inline_table", """
select o.o_orderkey, coalesce(u.unit, 'NONE') as unit from orders o
left join (values ('1-URGENT','DAYS'),('2-HIGH','UNITS'),('3-MEDIUM','PERCENTAGE')) as u(priority, unit) on o.o_orderpriority = u.priority""")
def _(d):
    units = lookups.table(
        d.spark, [("1-URGENT", "DAYS"), ("2-HIGH", "UNITS"), ("3-MEDIUM", "PERCENTAGE")], "priority string, unit string"
    )
    joined = lookup.with_lookup(d.orders, F.col("o_orderpriority"), units, "priority", "unit", "unit", "NONE")
    return joined.select("o_orderkey", "unit")


@query("src08_provenance", "select s_suppkey, true as stamped, 'supplier.parquet' as file_name from supplier")
def _(d):
    stamped = sources.with_provenance(d.supplier)
    return stamped.select(
        "s_suppkey", F.col("ingestion_timestamp").isNotNull().alias("stamped"),
        F.element_at(F.split("source_file", "/"), -1).alias("file_name"),
    )


@query("src09_explode_bars", """
select symbol, cast(date_parsed as varchar) as date, cast(high as double) as high, cast(low as double) as low, cast(last as double) as last, volume, type from fx_bars""")
def _(d):
    return landing.explode_bars(sinks.envelopes(d.fx_bars))


@query("src10_merge_pages", """
select symbol, cast(date_parsed as varchar) as date, cast(high as double) as high, cast(low as double) as low, cast(last as double) as last, volume, type from fx_bars""")
def _(d):
    pages = sinks.envelopes(d.fx_bars)
    # Only the first page of a symbol says its type.
    untyped = pages.withColumn("type", F.when(F.col("page") == 1995, F.col("type")))
    return landing.merge_pages(untyped)


@query("src11_day_slice", f"""
select {BAR_COLS} from fx_bars, (select max(date_parsed) as as_of from fx_bars)
where date_parsed = as_of - case type when 'STOCK' then 3 else 1 end""")
def _(d):
    as_of = d.lineitem.agg(F.max(F.col("l_shipdate").cast("date"))).first()[0]
    return landing.day_slice(d.fx_bars, F.lit(as_of), lookups.LAG_DAYS)


@query("src12_not_yet_landed", """
select distinct p_type as symbol from part where p_type not in (select symbol from fx_bars)""")
def _(d):
    wanted = d.part.select(F.col("p_type").alias("symbol")).distinct()
    return landing.not_yet_landed(wanted, d.fx_bars)


@query("src13_map_codes", """
select case p_brand when 'Brand#11' then 'BTC/USD' when 'Brand#12' then 'ETH/USD' else p_brand end as symbol,
 cast(cast(l_shipdate as date) as varchar) as date, l_extendedprice as high, l_discount as low, l_extendedprice as last,
 cast(trunc(l_quantity * 1.37) as bigint) as volume, 'CRYPTO' as type
from lineitem join part on l_partkey = p_partkey""")
def _(d):
    raw = d.lineitem.join(d.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_brand").alias("code"), F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_extendedprice").alias("high"), F.col("l_discount").alias("low"),
        F.col("l_extendedprice").alias("last"), (F.col("l_quantity") * 1.37).alias("volume"),
    )
    codes = lookups.table(d.spark, [("Brand#11", "BTC/USD"), ("Brand#12", "ETH/USD")], "code string, symbol string")
    return landing.crypto_rows(raw, codes)


# -- sinks --------------------------------------------------------------------

@query("snk01_overwrite", "select n_nationkey, n_name, cast(n_regionkey as bigint) as region, 'x' as note from nation")
def _(d):
    path = scratch_path(d.spark, "overwrite")
    sinks.write_table(d.nation, path)
    changed = d.nation.select(
        "n_nationkey", "n_name", F.col("n_regionkey").cast("long").alias("region"), F.lit("x").alias("note")
    )
    sinks.write_table(changed, path)
    return d.spark.read.parquet(path)


@query("snk02_append", f"select symbol, date, high, low, last, volume, load_id, type, date_parsed, year from sv_bars")
def _(d):
    path = scratch_path(d.spark, "append")
    for _ in range(2):
        sinks.write_table(d.fx_raw_bars, path, "append")
    return clean.clean_bars(d.spark.read.parquet(path), SYMBOLS, newest="load_id")


@query("snk03_partition_by_year", f"select {BAR_COLS}, cast(year(date_parsed) as int) as year from fx_bars where year(date_parsed) between 1997 and 1998")
def _(d):
    path = scratch_path(d.spark, "by_year")
    sinks.write_table(d.fx_bars.withColumn("year", F.year("date_parsed")), path, partition_by=["year"])
    return sources.read_table(d.spark, path, F.col("year").between(1997, 1998))


@query("snk04_publish", """
select cryptostock_value_key, cast(high as double) as high, cast(low as double) as low, cast(volume as double) as volume, cast(close as double) as close from o_dim_asset_value""")
def _(d):
    values = star.dim_asset_value(clean.clean_bars(d.fx_raw_bars, SYMBOLS, newest="load_id"))
    return sinks.publish({"dim_cryptostock_value": values}, scratch_path(d.spark, "serving"))["dim_cryptostock_value"]


@query("snk06_remove_read_files", """
with s as (select symbol, case type when 'CRYPTO' then 2 else 1 end as loads, count(*) as n, count(distinct year(date_parsed)) as files from fx_bars group by symbol, type)
select symbol, n * loads as bars, files * loads as read, files * loads as archived, case loads when 1 then files else 0 end as unread, 0 as left_behind from s""")
def _(d):
    """Two loads are read and their files moved away, a third is not: files per symbol by the audit."""
    from millrace.streaming.ingest import audit_files, ingest_envelopes, sweep_landed

    src, dst, archive = (scratch_path(d.spark, n) for n in ("incoming", "landed", "archive"))
    later = lambda kind, months: d.fx_bars.filter(F.col("type") == kind).withColumn("date_parsed", F.add_months("date_parsed", months))
    sinks.write_envelopes(d.fx_bars, src)
    for load in (later("CRYPTO", 120), later("STOCK", 240)):
        ingest_envelopes(d.spark, src, dst, f"{dst}-checkpoint").awaitTermination()
        sweep_landed(d.spark, src, dst, archive)
        sinks.write_envelopes(load, src, "append")
    files = audit_files(d.spark, src, dst, archive)
    symbol = F.replace(F.regexp_extract("file", "safe_symbol=([^/]*?)-[0-9a-f]+/", 1), F.lit("_"), F.lit("/"))
    return files.groupBy(symbol.alias("symbol")).agg(
        F.sum("rows").alias("bars"), F.count_if(F.col("rows") > 0).alias("read"), F.count_if(F.col("archived") & (F.col("rows") > 0)).alias("archived"),
        F.count_if(F.col("in_place") & (F.col("rows") == 0)).alias("unread"), F.count_if(F.col("in_place") & (F.col("rows") > 0)).cast("int").alias("left_behind"))


@query("src06_auto_typed", """
select cast(year(cast(o_orderdate as date)) as int) as year, o_orderstatus, count(*) as orders, round(sum(cast(o_totalprice as double)), 2) as total, max(o_custkey) as customer,
 max(cast(o_orderdate as date)) as newest, min(o_orderpriority) as priority from orders group by 1, 2""")
def _(d):
    """Text of no known type to a view that SQL can calculate with."""
    path = scratch_path(d.spark, "orders_csv")
    text = d.orders.withColumns({"o_orderdate": F.col("o_orderdate").cast("date"), "o_totalprice": F.col("o_totalprice").cast("decimal(18,2)")})
    text.select(*[F.col(c).cast("string") for c in text.columns]).write.option("header", True).csv(path)
    sources.read_csv_typed(d.spark, path, "typed_orders")
    return d.spark.sql("""
select year(o_orderdate) as year, o_orderstatus, count(*) as orders, round(sum(o_totalprice), 2) as total, max(o_custkey) as customer,
 max(o_orderdate) as newest, min(o_orderpriority) as priority from typed_orders group by 1, 2""")


@query("snk07_write_envelopes", """
select symbol, type, cast(date_parsed as varchar) as date, cast(high as double) as high, cast(low as double) as low, cast(last as double) as last, volume,
       replace(symbol, '/', '_') as folder from fx_bars""")
def _(d):
    path = _envelope_files(d)
    env = d.spark.read.schema(
        T.StructType(schemas.ENVELOPE.fields + [T.StructField("safe_symbol", T.StringType())])
    ).option("multiLine", True).json(path)
    folder = F.regexp_replace("safe_symbol", "-[0-9a-f]+$", "")
    bars = env.withColumn("source_file", folder)
    return landing.explode_bars(bars).withColumnRenamed("source_file", "folder")


@query("snk08_table_counts", """
select 'orders' as table_name, count(*) as row_count from orders union all select 'lineitem', count(*) from lineitem
union all select 'fx_bars', count(*) from fx_bars union all select 'fx_regions', count(*) from fx_regions""")
def _(d):
    return profile.table_counts({n: getattr(d, n) for n in ("orders", "lineitem", "fx_bars", "fx_regions")})


# -- projections --------------------------------------------------------------

@query("prj01_select_alias", "select o_orderkey as id, o_custkey as buyer, o_totalprice as amount from orders")
def _(d):
    return d.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("buyer"), F.col("o_totalprice").alias("amount")
    )


@query("prj02_add_columns", "select *, cast(year(date) as int) as year, 'USA' as country_code, cast(value * 2 as decimal(30,10)) as twice from fx_housing")
def _(d):
    return d.fx_housing.withColumns({
        "year": F.year("date"), "country_code": F.lit("USA"), "twice": (F.col("value") * 2).cast("decimal(30,10)"),
    })


@query("prj03_drop_columns", "select l_orderkey, l_partkey, l_quantity from lineitem")
def _(d):
    return d.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_tax", "l_discount").drop("l_tax", "l_discount")


@query("prj04_rename", "select distinct symbol as asset_key, type from fx_bars")
def _(d):
    return d.fx_bars.select("symbol", "type").distinct().withColumnRenamed("symbol", "asset_key")


@query("prj05_casts", """
select try_cast(p_partkey as varchar) as s, try_cast(p_size as bigint) as l, try_cast(p_retailprice as decimal(30,10)) as d,
 try_cast(p_brand as int) as bad_int, try_cast(p_size as double) as f, try_cast(p_name as date) as bad_date from part""")
def _(d):
    return d.part.select(
        F.col("p_partkey").try_cast("string").alias("s"), F.col("p_size").try_cast("long").alias("l"),
        F.col("p_retailprice").try_cast("decimal(30,10)").alias("d"), F.col("p_brand").try_cast("int").alias("bad_int"),
        F.col("p_size").try_cast("double").alias("f"), F.col("p_name").try_cast("date").alias("bad_date"),
    )


# -- filters ------------------------------------------------------------------

@query("flt01_not_null", "select * from fx_raw_bars where last is not null and type is not null and date is not null")
def _(d):
    return d.fx_raw_bars.filter(P.all_of({"last": P.NotNull, "type": P.NotNull, "date": P.NotNull}))


@query("flt02_membership", f"select * from fx_housing where indicator_id in ({_in(HOUSING_CODES)})")
def _(d):
    return d.fx_housing.filter(F.col("indicator_id").isin(HOUSING_CODES))


@query("flt03_comparison", "select * from fx_housing where value > 150000 and date >= date '1998-06-01'")
def _(d):
    return d.fx_housing.filter((F.col("value") > 150000) & (F.col("date") >= F.lit("1998-06-01").cast("date")))


@query("flt04_between", "select * from fx_bars where date_parsed between date '1996-02-01' and date '1997-01-31'")
def _(d):
    return d.fx_bars.filter(P.all_of({"date_parsed": (dt.date(1996, 2, 1), dt.date(1997, 1, 31))}))


@query("flt05_parameter", "select * from fx_bars where symbol = 'SMALL/USD'")
def _(d):
    return d.spark.sql("select * from {bars} where symbol = :asset", args={"asset": "SMALL/USD"}, bars=d.fx_bars)


@query("flt06_contains_any", "select doc_id, lang from documents where contains(lower(text), 'ing the') or contains(lower(text), '100%') or contains(lower(text), 'und_')")
def _(d):
    return d.documents.filter(P.contains_any(F.col("text"), ["ING the", "100%", "und_"])).select("doc_id", "lang")


@query("flt07_from_dict", "select id, year_key from fx_chunks where socio_indicator_key is not null and year_key between 2015 and 2019 and socio_indicator_key = 'FP.CPI.TOTL'")
def _(d):
    wanted = P.all_of({
        "socio_indicator_key": P.NotNull, "year_key": (2015, 2019),
        "only": F.col("socio_indicator_key") == "FP.CPI.TOTL",
    })
    return d.fx_chunks.filter(wanted).select("id", "year_key")


@query("flt08_category", """
select id, case when socio_indicator_key is not null then 'socioeconomic' when asset_key is not null then 'asset' when realestate_indicator_key is not null then 'realestate' end as category
from fx_chunks""")
def _(d):
    kind = P.category(F.col("socio_indicator_key"), F.col("asset_key"), F.col("realestate_indicator_key"))
    return d.fx_chunks.select("id", kind.alias("category"))


# -- joins --------------------------------------------------------------------

@query("jn01_left_enrich", """
select h.indicator_id, h.region_id, h.value, r.region from fx_housing h left join (select * from fx_regions where region_type <> 'zip') r on h.region_id = r.region_id""")
def _(d):
    known = d.fx_regions.filter(F.col("region_type") != "zip").select("region_id", "region")
    return d.fx_housing.join(known, "region_id", "left").select("indicator_id", "region_id", "value", "region")


@query("jn02_star_chain", """
select r.r_name, n.n_name, p.p_type, cast(sum(cast(l.l_extendedprice as decimal(18,2))) as decimal(28,2)) as revenue
from lineitem l join orders o on l.l_orderkey = o.o_orderkey join customer c on o.o_custkey = c.c_custkey
join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey
join part p on l.l_partkey = p.p_partkey group by all""")
def _(d):
    c = F.col
    return (
        d.lineitem.select("l_orderkey", "l_partkey", c("l_extendedprice").cast("decimal(18,2)").alias("price"))
        .join(d.part.select("p_partkey", "p_type"), c("l_partkey") == c("p_partkey"))
        .join(d.orders.select("o_orderkey", "o_custkey"), c("l_orderkey") == c("o_orderkey"))
        .join(d.customer.select("c_custkey", "c_nationkey"), c("o_custkey") == c("c_custkey"))
        .join(d.nation, c("c_nationkey") == c("n_nationkey"))
        .join(d.region, c("n_regionkey") == c("r_regionkey"))
        .groupBy("r_name", "n_name", "p_type")
        .agg(F.sum("price").cast("decimal(28,2)").alias("revenue"))
    )


@query("jn03_value_and_unit", """
select h.region_id, h.date, v.value_key from sv_housing h left join lk_house_units u on h.indicator_id = u.indicator_id
join o_dim_value v on v.value = h.value and v.unit = coalesce(u.unit, 'USD_CURRENT')""")
def _(d):
    indicators, housing, _ = _silver(d)
    house_units = lookups.housing_units(d.spark)
    values = star.dim_value(indicators, housing, units(d), house_units)
    return star.housing_values(housing, house_units).join(values, ["value", "unit"]).select("region_id", "date", "value_key")


@query("jn04_six_columns", """
select v.cryptostock_value_key, b.symbol, b.date_parsed from sv_bars b join o_dim_asset_value v on b.symbol = v.symbol and b.date_parsed = v.date_parsed
and b.high = v.high and b.low = v.low and b.volume = v.volume and b.last = v.close""")
def _(d):
    bars = _silver(d)[2]
    keyed = bars.select(
        "symbol", "date_parsed", "high", "low", F.col("volume").cast(schemas.VALUE).alias("volume"),
        F.col("last").alias("close"),
    )
    return keyed.join(
        star.dim_asset_value(bars), ["symbol", "date_parsed", "high", "low", "volume", "close"]
    ).select("cryptostock_value_key", "symbol", "date_parsed")


@query("jn05_computed_key", """
select i.series_id, i.country_code, t.date_key, t.day_name from fx_indicators i join o_dim_time t on make_date(i.year, 1, 1) = t.date_key""")
def _(d):
    times = star.dim_time(*_silver(d))
    keyed = d.fx_indicators.withColumn("date_key", dates.first_of_year(F.col("year")))
    return keyed.join(times, "date_key").select("series_id", "country_code", "date_key", "day_name")


@query("jn06_cast_key", """
select o.o_orderkey, r.region_type from orders o join fx_regions r on try_cast(cast(o.o_custkey as varchar) as int) = r.region_id""")
def _(d):
    orders = d.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("region_text"))
    keyed = orders.withColumn("region_id", F.expr("try_cast(region_text as int)"))
    return keyed.join(d.fx_regions, "region_id").select("o_orderkey", "region_type")


_YOY_SQL = """
select c.series_id, c.country_code, c.year, p.year as prev_year, c.value, p.value as prev_value
from fx_indicators c left join fx_indicators p on c.country_code = p.country_code and c.series_id = p.series_id and c.year = p.year + 1
where p.year is not null"""


@query("jn07_previous_year_pairs", _YOY_SQL)
def _(d):
    return rows.year_over_year_pairs(
        d.fx_indicators.select("series_id", "country_code", "year", "value"), ["series_id", "country_code"], "year", ["value"]
    ).select("series_id", "country_code", "year", "prev_year", "value", "prev_value")


@query("jn08_three_tables", """
select h.indicator_id, h.region_id, h.date, h.value, i.indicator, i.category, r.region_type, r.region
from fx_housing h join fx_housing_indicators i on h.indicator_id = i.indicator_id join fx_regions r on h.region_id = r.region_id
where i.indicator_id = 'CRAW' and h.date >= date '1999-01-01'""")
def _(d):
    kept = d.fx_housing.filter((F.col("indicator_id") == "CRAW") & (F.col("date") >= F.lit("1999-01-01").cast("date")))
    return kept.join(d.fx_housing_indicators, "indicator_id").join(d.fx_regions, "region_id").select(
        "indicator_id", "region_id", "date", "value", "indicator", "category", "region_type", "region"
    )


@query("jn09_lookup_default", """
select h.indicator_id, h.region_id, h.date, coalesce(u.unit, 'USD_CURRENT') as unit, coalesce(x.description, '') as description
from fx_housing h left join lk_house_units u on h.indicator_id = u.indicator_id left join lk_house_desc x on h.indicator_id = x.indicator_id""")
def _(d):
    key = F.col("indicator_id")
    unit = lookup.with_lookup(
        d.fx_housing, key, lookups.housing_units(d.spark), "indicator_id", "unit", "unit", "USD_CURRENT"
    )
    both = lookup.with_lookup(
        unit, key, lookups.housing_descriptions(d.spark), "indicator_id", "description", "description", ""
    )
    return both.select("indicator_id", "region_id", "date", "unit", "description")


@query("jn10_keyword_codes", """
with asked as (select c_custkey as question_id, case c_custkey % 4 when 0 then ['Rent ', 'home price', 'rents'] when 1 then ['condo', 'nothing'] when 2 then ['Home Values', 'condos'] else ['x'] end as keywords from customer),
words as (select question_id, unnest(keywords) as word, unnest(range(len(keywords))) as kpos from asked),
codes as (select question_id, kpos, unnest(string_split(k.codes, ' ')) as code, unnest(range(len(string_split(k.codes, ' ')))) as cpos from words join lk_housing k on lower(trim(word)) = k.keyword)
select question_id, min(kpos * 4294967296 + cpos) as position, code from codes group by question_id, code""")
def _(d):
    words = lambda *w: F.array(*[F.lit(x) for x in w])
    kind = F.col("c_custkey") % 4
    asked = d.customer.select(
        F.col("c_custkey").alias("question_id"),
        F.when(kind == 0, words("Rent ", "home price", "rents")).when(kind == 1, words("condo", "nothing"))
        .when(kind == 2, words("Home Values", "condos")).otherwise(words("x")).alias("keywords"),
    )
    return lookup.expand_codes(asked, "question_id", "keywords", lookups.housing_keywords(d.spark))


# -- aggregates ---------------------------------------------------------------

def _silver(d):
    """Clean indicators, housing and bars of the fixtures."""
    tables = silver(d)
    return tables["indicators"], tables["housing"], tables["bars"]


def prices(d):
    return metrics.prices_of_bars(silver(d)["bars"])


def rounded(df, digits=6):
    """Doubles to so many places, for comparison between engines."""
    return df.select(*[
        F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes
    ])


_AVG = "round(cast(sum({0}) as double) / count({0}), 6)"


@query("agg01_asset_month", f"""
select asset_key, year, month_number, {_AVG.format('close')} as avg_price, min(low) as min_price, max(high) as max_price,
 {_AVG.format('volume')} as avg_volume, count(*) as trading_days from o_prices group by asset_key, year, month_number""")
def _(d):
    return rounded(metrics.asset_month(prices(d)))


ASSET_YEAR_SQL = f"""
select asset_key, year, min(close) as min_close, max(close) as max_close, min_by(close, date) as first_close, max_by(close, date) as last_close,
 min(low) as year_low, max(high) as year_high, {_AVG.format('close')} as avg_price, round(coalesce(stddev(cast(close as double)), 0), 3) as price_stddev,
 cast(sum(volume) as bigint) as total_volume, {_AVG.format('volume')} as avg_volume, count(*) as trading_days, min(date) as first_date, max(date) as last_date
from o_prices group by asset_key, year having count(*) >= 2"""


@query("agg02_asset_year", ASSET_YEAR_SQL)
def _(d):
    return rounded(metrics.asset_year(prices(d))).withColumn("price_stddev", F.round("price_stddev", 3))


@query("agg04_asset_lifetime", f"""
select asset_key, min(year) as start_year, max(year) as end_year, count(distinct year) as num_years, min(close) as all_time_low,
 max(high) as all_time_high, {_AVG.format('close')} as overall_avg_price, cast(sum(volume) as bigint) as total_volume
from o_prices group by asset_key having count(distinct year) >= 3""")
def _(d):
    return rounded(metrics.asset_lifetime(prices(d)))


@query("agg05_yearly_list", f"""
select asset_key, cast(row_number() over (partition by asset_key order by year) - 1 as int) as pos, year, avg_price
from (select asset_key, year, {_AVG.format('close')} as avg_price from o_prices group by asset_key, year)""")
def _(d):
    lists = metrics.asset_yearly_averages(prices(d))
    return rounded(lists.select("asset_key", F.posexplode("yearly").alias("pos", "y")).select("asset_key", "pos", "y.*"))


_FIGURES = f"""{_AVG.format('value')} as avg_value, min(value) as min_value, max(value) as max_value,
 round(stddev(cast(value as double)), 3) as stddev_value, count(*) as data_points"""
_STATE = "realestate_indicator_key, indicator_name, indicator_description, state_name, state_code, year"


def house_figures(d):
    """Housing figures straight from the clean table, in the layout of the star's."""
    _, housing, _ = _silver(d)
    decoded = star.decode_region(
        star.housing_values(housing, lookups.housing_units(d.spark)), lookups.states(d.spark)
    )
    described = lookup.with_lookup(
        decoded, F.col("indicator_id"), lookups.housing_descriptions(d.spark), "indicator_id", "description",
        "indicator_description", "",
    )
    return (
        described.withColumns({"date_key": F.col("date"), **dates.calendar(F.col("date"))})
        .withColumnRenamed("indicator_id", "realestate_indicator_key").withColumnRenamed("indicator", "indicator_name")
        .select(
            "realestate_indicator_key", "indicator_name", "indicator_description", "region_id", "state_name",
            "state_code", "date_key", "year", "month_number", "month_name", "value", "unit",
        ).distinct()
    )


@query("agg06_state_year", f"""
select {_STATE}, {_FIGURES}, unit from o_housing_figures where date_key between date '1996-01-01' and date '1999-12-31' and state_code is not null
group by {_STATE}, unit having count(*) >= 3""")
def _(d):
    stats = metrics.state_year(house_figures(d), "1996-01-01", "1999-12-31")
    return rounded(stats).withColumn("stddev_value", F.round("stddev_value", 3))


@query("agg07_state_month", f"""
select {_STATE}, month_number, month_name, {_FIGURES}, unit from o_housing_figures where year = 1998 and state_code = 'OH'
group by {_STATE}, month_number, month_name, unit having count(*) >= 3""")
def _(d):
    stats = metrics.state_month(house_figures(d), 1998, "OH")
    return rounded(stats).withColumn("stddev_value", F.round("stddev_value", 3))


@query("agg08_group_as_distinct", "select region_type from fx_regions group by region_type")
def _(d):
    return d.fx_regions.select("region_type").distinct()


@query("agg09_distinct_rows", "select distinct o_orderpriority, o_orderstatus, cast(o_orderdate as date) as day from orders")
def _(d):
    return d.orders.select("o_orderpriority", "o_orderstatus", F.col("o_orderdate").cast("date").alias("day")).distinct()


@query("agg10_dedupe", """
select symbol, type, date, high, low, last, volume, load_id from (select *, row_number() over (partition by symbol, date order by load_id desc) as rn from fx_raw_bars) where rn = 1""")
def _(d):
    return dedupe(d.fx_raw_bars, ["symbol", "date"], [F.desc("load_id")])


_TREND_SQL = """
select country_code, country_name, series_id, indicator_name, unit, min(year) as start_year, max(year) as end_year,
 min_by(value, year) as start_value, max_by(value, year) as end_value, count(*) as points,
 round(cast(max_by(value, year) as double) - cast(min_by(value, year) as double), 6) as change,
 round(case when min_by(value, year) <> 0 then (cast(max_by(value, year) as double) - cast(min_by(value, year) as double)) / cast(min_by(value, year) as double) * 100 else 0 end, 6) as change_pct
from o_indicator_figures group by country_code, country_name, series_id, indicator_name, unit having count(*) >= 3"""
_SERIES = ["country_code", "country_name", "series_id", "indicator_name", "unit"]


def figures(d):
    return star.indicator_values(_silver(d)[0], units(d)).select(
        "series_id", "indicator_name", "indicator_description", "country_code", "country_name", "year", "value", "unit"
    )


@query("agg12_trend", _TREND_SQL)
def _(d):
    return rounded(metrics.trend(figures(d), _SERIES, "year", "value"))


@query("agg13_ordered_text", """
select series_id, country_code, string_agg(cast(year as varchar) || ': ' || format('{:,.2f}', cast(value as double)), ', ' order by year) as summary
from fx_indicators group by series_id, country_code""")
def _(d):
    line = F.struct("year", X.fmt(F.col("value"), 2, True).alias("text"))
    return d.fx_indicators.groupBy("series_id", "country_code").agg(
        X.yearly_list(F.collect_list(line)).alias("summary")
    )


@query("agg14_summary", " union all ".join(f"""
select '{c}' as column_name, count({c}) as count, round(cast(sum(cast({c} as decimal(18,2))) as double) / count({c}), 4) as mean,
 round(stddev({c}), 4) as stddev, min({c}) as min, max({c}) as max, round(quantile_cont({c}, 0.25), 4) as q25, round(quantile_cont({c}, 0.5), 4) as q50,
 round(quantile_cont({c}, 0.75), 4) as q75 from lineitem""" for c in ("l_quantity", "l_extendedprice")))
def _(d):
    return rounded(profile.summary(d.lineitem, ["l_quantity", "l_extendedprice"]), 4)


@query("agg15_composition", """
select case when socio_indicator_key is not null then 'socioeconomic' when asset_key is not null then 'asset' else 'realestate' end as category,
 coalesce(socio_indicator_key, asset_key, realestate_indicator_key) as code, count(*) as docs from fx_chunks group by 1, 2""")
def _(d):
    kind = P.category(F.col("socio_indicator_key"), F.col("asset_key"), F.col("realestate_indicator_key"))
    code = F.coalesce("socio_indicator_key", "asset_key", "realestate_indicator_key")
    hits = d.fx_chunks.select(kind.alias("category"), code.alias("code"))
    return profile.composition(hits, ["category", "code"])


_RAW = ["symbol", "type", "date", "high", "low", "last", "volume"]


@query("agg16_null_counts", " union all ".join(
    f"select '{c}' as column_name, count(*) - count({c}) as null_count, count({c}) as filled_count from fx_raw_bars" for c in _RAW))
def _(d):
    return profile.null_counts(d.fx_raw_bars.select(*_RAW))


# -- windows ------------------------------------------------------------------

@query("win01_dense_key", """
select cast(row_number() over (order by h) as int) as value_key, value, unit from (
 select distinct value, indicator_id as unit, md5(concat_ws('||', cast(value as varchar), indicator_id)) as h from fx_housing)""")
def _(d):
    from millrace.operators.keys import dense_key

    pairs = d.fx_housing.select("value", F.col("indicator_id").alias("unit")).distinct()
    hashed = pairs.withColumn("h", hashing.content_md5(F.col("value"), F.col("unit")))
    return dense_key(hashed, ["h"], "value_key").drop("h")


@query("win02_dense_key_columns", """
select cast(row_number() over (order by symbol, date_parsed, high, low, last, volume) as int) as bar_key, symbol, date_parsed, high, low, last, volume
from (select distinct symbol, date_parsed, high, low, last, volume from fx_bars)""")
def _(d):
    from millrace.operators.keys import dense_key

    cols = ["symbol", "date_parsed", "high", "low", "last", "volume"]
    return dense_key(d.fx_bars.select(*cols).distinct(), cols, "bar_key")


_STAGED = """(select 1 as stage, l_suppkey as qid, l_partkey as id, cast(l_extendedprice as decimal(18,2)) as score from lineitem where l_returnflag = 'R'
 union all select 2, l_suppkey, l_partkey, cast(l_extendedprice as decimal(18,2)) from lineitem where l_returnflag <> 'R')"""


def _staged(d):
    line = d.lineitem.select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(2).alias("stage"), F.col("l_suppkey").alias("qid"),
        F.col("l_partkey").alias("id"), F.col("l_extendedprice").cast("decimal(18,2)").alias("score"),
    )
    return line


@query("win03_first_per_id", f"""
select qid, id, stage, score from (select *, row_number() over (partition by qid, id order by stage, score desc) as rn from {_STAGED}) where rn = 1""")
def _(d):
    return rows.first_per_key(_staged(d), ["qid", "id"], [F.asc("stage"), F.desc("score")]).select(
        "qid", "id", "stage", "score"
    )


@query("win04_quota", """
select l_returnflag as category, l_orderkey, l_linenumber, price, cast(rn as int) as position from (
 select *, row_number() over (partition by l_returnflag order by price desc, l_orderkey, l_linenumber, l_partkey) as rn
 from (select l_returnflag, l_orderkey, l_linenumber, l_partkey, cast(l_extendedprice as decimal(18,2)) as price from lineitem)) where rn <= case l_returnflag when 'A' then 10 when 'N' then 33 else 20 end""")
def _(d):
    order = [F.desc("price"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey")]
    line = d.lineitem.withColumns({
        "price": F.col("l_extendedprice").cast("decimal(18,2)"),
        "quota": F.when(F.col("l_returnflag") == "A", 10).when(F.col("l_returnflag") == "N", 33).otherwise(20),
    })
    kept = rows.top_per_key(line, ["l_returnflag"], order, "quota", rank="position", salts=8, most=33)
    return kept.select(F.col("l_returnflag").alias("category"), "l_orderkey", "l_linenumber", "price", "position")


@query("win05_previous_year", _YOY_SQL)
def _(d):
    return rows.year_over_year(
        d.fx_indicators.select("series_id", "country_code", "year", "value"), ["series_id", "country_code"], "year", ["value"]
    ).select("series_id", "country_code", "year", "prev_year", "value", "prev_value")


# -- sorts and limits ---------------------------------------------------------

@query("srt01_order_by", "select region_id, indicator_id, date, value from fx_housing order by region_id, date desc, indicator_id, value")
def _(d):
    return d.fx_housing.select("region_id", "indicator_id", "date", "value").orderBy(
        F.asc("region_id"), F.desc("date"), F.asc("indicator_id"), F.asc("value")
    )


@query("srt02_ordered_limit", """
select region_id, indicator_id, date, value from fx_housing where indicator_id in ('LRAW','CRAW') order by region_id, date desc, indicator_id, value limit 10000""")
def _(d):
    kept = d.fx_housing.filter(F.col("indicator_id").isin("LRAW", "CRAW"))
    return kept.select("region_id", "indicator_id", "date", "value").orderBy(
        F.asc("region_id"), F.desc("date"), F.asc("indicator_id"), F.asc("value")
    ).limit(10000)


@query("srt03_examples", """
select region_type, region_id, region, cast(rn as int) as example from (select *, row_number() over (partition by region_type order by region_id) as rn from fx_regions) where rn <= 3""")
def _(d):
    return metrics.examples_per(d.fx_regions, ["region_type"], [F.asc("region_id")]).select(
        "region_type", "region_id", "region", "example"
    )


# -- set operations -----------------------------------------------------------

@query("set01_union_all", "select c_custkey as id, c_name as name, c_nationkey as nation from customer union all select s_suppkey, s_name, s_nationkey from supplier")
def _(d):
    c, s = d.customer, d.supplier
    return stack(
        c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")),
        s.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id")),
    )


@query("set02_union_distinct", "select cast(l_shipdate as date) as day from lineitem union select cast(o_orderdate as date) from orders")
def _(d):
    return stack_distinct(
        d.lineitem.select(F.col("l_shipdate").cast("date").alias("day")),
        d.orders.select(F.col("o_orderdate").cast("date").alias("day")),
    )


@query("set03_padded_union", """
select cast(region_id as int) as region_key, cast(null as varchar) as asset_key, date as date_key, indicator_id as realestate_indicator_key from fx_housing
union all select null, symbol, date_parsed, null from fx_bars""")
def _(d):
    contract = T.StructType([f for f in schemas.FACT.fields if f.name in (
        "region_key", "asset_key", "date_key", "realestate_indicator_key")])
    housing = d.fx_housing.select(
        F.col("region_id").alias("region_key"), F.col("date").alias("date_key"),
        F.col("indicator_id").alias("realestate_indicator_key"),
    )
    bars = d.fx_bars.select(F.col("symbol").alias("asset_key"), F.col("date_parsed").alias("date_key"))
    return conform(stack(housing, bars), contract)

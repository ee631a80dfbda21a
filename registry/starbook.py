"""Cleaning jobs, dimensions, facts, constraints and serving queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace import lookups, schemas
from millrace.operators import quality
from millrace.plans import clean, metrics, prices as P, star
from millrace.session import scratch_path
from millrace.sinks.files import SERVING, publish, write_table
from registry.basics import _FIGURES, _STATE, rounded
from registry.book import query
from registry.fixtures import HOUSING_CODES, SYMBOLS
from registry.lake import clean_tables, gold, silver, units

c = F.col


@query("cln01_indicators", "select * from sv_indicators")
def _(d):
    return clean_tables(d)["indicators"]


@query("cln02_housing", "select * from sv_housing")
def _(d):
    return clean_tables(d)["housing"]


@query("cln03_bars", "select * from sv_bars")
def _(d):
    return clean_tables(d)["bars"]


_STAMPED = "count(*) as rows, cast(1 as bigint) as times, true as after_start"


@query("cln04_processed_time", f"""
select 'bars' as name, {_STAMPED} from sv_bars union all select 'indicators', {_STAMPED} from sv_indicators""")
def _(d):
    """Clean tables stored with the time of their job: one time a table, not before the job's start."""
    start = d.spark.range(1).select(F.current_timestamp()).first()[0]
    tables, root, told = clean_tables(d), scratch_path(d.spark, "processed"), None
    for name in ("bars", "indicators"):
        write_table(clean.processed(tables[name]), f"{root}/{name}", partition_by=["year"])
        row = d.spark.read.parquet(f"{root}/{name}").agg(
            F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"), F.count_distinct("processed_timestamp").alias("times"),
            (F.min("processed_timestamp") >= F.lit(start)).alias("after_start"))
        told = row if told is None else told.unionByName(row.select(told.columns))
    return told


@query("dim01_time", "select * from o_dim_time")
def _(d):
    s = silver(d)
    return star.dim_time(s["indicators"], s["housing"], s["bars"])


@query("dim02_country", "select * from o_dim_country")
def _(d):
    return star.dim_country(silver(d)["indicators"])


@query("dim03_region", "select * from o_dim_region")
def _(d):
    return star.dim_region(silver(d)["housing"], lookups.states(d.spark))


@query("dim04_value", "select * from o_dim_value")
def _(d):
    s = silver(d)
    return star.dim_value(s["indicators"], s["housing"], units(d), lookups.housing_units(d.spark))


@query("dim05_socio_indicator", "select * from o_dim_socio")
def _(d):
    return star.dim_socioeconomical_indicator(silver(d)["meta"])


@query("dim06_housing_indicator", "select * from o_dim_house")
def _(d):
    return star.dim_realestate_indicator(silver(d)["housing"], lookups.housing_descriptions(d.spark))


@query("dim07_asset", "select * from o_dim_asset")
def _(d):
    return star.dim_asset(silver(d)["bars"])


@query("dim08_asset_value", "select * from o_dim_asset_value")
def _(d):
    return star.dim_asset_value(silver(d)["bars"])


@query("fct01_indicator", "select * from o_fact_indicator")
def _(d):
    g = gold(d)
    return star.fact_indicator(silver(d)["indicators"], units(d), g["dim_value"], g["dim_country"], g["dim_time"])


@query("fct02_housing", "select * from o_fact_housing")
def _(d):
    g = gold(d)
    return star.fact_housing(
        silver(d)["housing"], lookups.housing_units(d.spark), g["dim_value"], g["dim_realestate_indicator"],
        g["dim_time"], g["dim_region"],
    )


@query("fct03_asset", "select * from o_fact_asset")
def _(d):
    g = gold(d)
    return star.fact_distinct_bars(g["dim_cryptostock_value"], g["dim_asset"], g["dim_time"])


@query("fct04_fact_value", "select * from o_fact_value")
def _(d):
    """The whole build, clean tables to fact table, nothing read from the star layer."""
    s = silver(d)
    return star.build_star(s["indicators"], s["meta"], s["housing"], s["bars"], units(d))["fact_value"]


# -- serving copies -----------------------------------------------------------

_SERVED = {
    "dim_time": "o_dim_time", "dim_country": "o_dim_country", "dim_region": "o_dim_region", "dim_value": "o_dim_value",
    "dim_socioeconomical_indicator": "o_dim_socio", "dim_realestate_indicator": "o_dim_house", "dim_asset": "o_dim_asset",
    "fact_value": "o_fact_value",
}


def _published(table: str, oracle: str) -> None:
    columns = [*SERVING[table], *(["year"] if table == "fact_value" else [])]

    @query(f"snk04_publish_{table}", f"select {', '.join(columns)} from {oracle}")
    def _(d):
        return publish({table: gold(d)[table]}, scratch_path(d.spark, "serving"))[table]


for _name, _oracle in _SERVED.items():
    _published(_name, _oracle)


# -- constraints --------------------------------------------------------------

_KEYED = {
    "dim_time": ("o_dim_time", "date_key"), "dim_country": ("o_dim_country", "country_key"),
    "dim_region": ("o_dim_region", "region_key"), "dim_value": ("o_dim_value", "value_key"),
    "dim_socioeconomical_indicator": ("o_dim_socio", "socioeconomical_indicator_key"),
    "dim_realestate_indicator": ("o_dim_house", "realestate_indicator_key"),
    "dim_asset": ("o_dim_asset", "asset_key"), "dim_cryptostock_value": ("o_dim_asset_value", "cryptostock_value_key"),
}


@query("dq01_primary_keys", " union all ".join(f"""
select '{t}' as table_name, cast(sum(n) as bigint) as row_count, count(*) filter (where n > 1) as repeated_keys,
 cast(coalesce(sum(n) filter (where k is null), 0) as bigint) as null_keys from (select {k} as k, count(*) as n from {o} group by 1)""" for t, (o, k) in {
    **_KEYED, "orders_by_date": ("(select cast(o_orderdate as date) as day from orders)", "day")}.items()))
def _(d):
    g = gold(d)
    tables = {name: (g[name], [key]) for name, (_, key) in _KEYED.items()}
    tables["orders_by_date"] = (d.orders.select(c("o_orderdate").cast("date").alias("day")), ["day"])
    return quality.key_report(tables)


_EDGES = [
    ("value_key", "dim_value", "value_key"), ("asset_key", "dim_asset", "asset_key"),
    ("socioeconomical_indicator_key", "dim_socioeconomical_indicator", "socioeconomical_indicator_key"),
    ("realestate_indicator_key", "dim_realestate_indicator", "realestate_indicator_key"),
    ("cryptostock_value_key", "dim_cryptostock_value", "cryptostock_value_key"),
    ("country_key", "dim_country", "country_key"), ("region_key", "dim_region", "region_key"),
    ("date_key", "dim_time", "date_key"),
]


@query("dq02_foreign_keys", " union all ".join(f"""
select '{k}' as edge, count(*) as orphan_keys, cast(coalesce(sum(n), 0) as bigint) as orphan_rows from
(select {k} as k, count(*) as n from o_fact_value where {k} is not null group by 1) where k not in (select {dk} from {_KEYED[t][0]})""" for k, t, dk in _EDGES) + """
union all select 'part_in_crypto', count(*), cast(coalesce(sum(n), 0) as bigint) from (select symbol as k, count(*) as n from fx_bars group by 1) where k not in (select symbol from fx_bars where type = 'CRYPTO')""")
def _(d):
    from millrace.operators.rows import stack

    g = gold(d)

    def edge(name, fact, key, dim, dim_key):
        return quality.orphans(fact, dim, key, dim_key).agg(
            F.lit(name).alias("edge"), F.count(F.lit(1)).alias("orphan_keys"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
        )

    bars = d.fx_bars
    crypto = bars.filter("type = 'CRYPTO'").select(c("symbol").alias("known")).distinct()
    return stack(
        *[edge(k, g["fact_value"], k, g[t], dk) for k, t, dk in _EDGES],
        edge("part_in_crypto", bars, "symbol", crypto, "known"),
    )


@query("dq03_domains", """
select asset_key, type from o_dim_asset where type not in ('STOCK')""")
def _(d):
    return quality.bad_domain(gold(d)["dim_asset"], "type", ["STOCK"])


@query("dq04_key_families", """
select 'fact_value' as table_name, count(*) as violations from o_fact_value where
 (case when socioeconomical_indicator_key is not null then 1 else 0 end) + (case when realestate_indicator_key is not null then 1 else 0 end) + (case when asset_key is not null then 1 else 0 end) <> 1
union all select 'raw_bars', count(*) from fx_raw_bars where (case when type is not null then 1 else 0 end) + (case when last is not null then 1 else 0 end) <> 1""")
def _(d):
    from millrace.operators.profile import table_counts

    broken = {
        "fact_value": quality.key_family_violations(gold(d)["fact_value"], schemas.FACT_FAMILIES),
        "raw_bars": quality.key_family_violations(d.fx_raw_bars, {"type": ["type"], "last": ["last"]}),
    }
    return table_counts(broken).withColumnRenamed("row_count", "violations")


# -- serving ------------------------------------------------------------------

_CPI_SQL = """
select distinct year, value as cpi_value, unit from o_indicator_figures where series_id = 'ORDERS.CNT' and country_code = 'NATION_1' and year between 1996 and 1999"""


@query("api01_inflation_adjusted", """
select p.date, p.asset_key as ticker, p.type as asset_type, round(cast(p.close as double) * (100.5 / cast(i.value as double)), 6) as close_price,
 round(cast(p.high as double) * (100.5 / cast(i.value as double)), 6) as high_price, round(cast(p.low as double) * (100.5 / cast(i.value as double)), 6) as low_price, p.volume
from o_prices p join (select distinct year, value from o_indicator_figures where series_id = 'ORDERS.CNT' and country_code = 'NATION_1' and year between 1996 and 1999) i on i.year = p.year
where p.asset_key = 'SMALL/USD' and p.date between date '1996-03-01' and date '1999-10-31'""")
def _(d):
    adjusted = P.inflation_adjusted(
        gold(d), "SMALL/USD", "1996-03-01", "1999-10-31", 100.5, "ORDERS.CNT", "NATION_1"
    )
    return rounded(adjusted.withColumn("volume", c("volume").cast("long")))


@query("api02_cpi", _CPI_SQL)
def _(d):
    return P.cpi(gold(d), 1996, 1999, "ORDERS.CNT", "NATION_1")


@query("api03_housing_monthly", f"""
select {_STATE}, month_number, month_name, {_FIGURES}, unit from o_housing_figures where year = 1998 and state_code = 'TX'
group by {_STATE}, month_number, month_name, unit having count(*) >= 3""")
def _(d):
    return rounded(P.housing_monthly(gold(d), 1998, "TX")).withColumn("stddev_value", F.round("stddev_value", 3))


@query("api04_asset_daily", """
select date, asset_key as ticker, type as asset_type, close as close_price, high as high_price, low as low_price, volume
from o_prices where asset_key = 'LARGE' and date between date '1997-01-01' and date '1998-12-31'""")
def _(d):
    return P.asset_daily(gold(d), "LARGE", "1997-01-01", "1998-12-31").withColumn("volume", c("volume").cast("long"))


@query("api05_housing_series", f"""
select state_name as state, year, indicator_name, realestate_indicator_key as indicator_id, month_number, month_name, {_FIGURES}, unit
from o_housing_figures where year = 1998 and state_code = 'TX' group by {_STATE}, month_number, month_name, unit having count(*) >= 3""")
def _(d):
    series = P.housing_series(gold(d), 1998, "TX")
    flat = series.select("state", "year", "indicator_name", "indicator_id", F.inline("series"))
    return rounded(flat).withColumn("stddev_value", F.round("stddev_value", 3))


@query("src05_named_views", """
select da.type, cast(dt.year as int) as year, count(*) as days from o_fact_value fv join o_dim_time dt on fv.date_key = dt.date_key join o_dim_asset da on fv.asset_key = da.asset_key
group by da.type, dt.year""")
def _(d):
    for name in ("fact_value", "dim_time", "dim_asset"):
        gold(d)[name].createOrReplaceTempView(name)
    return d.spark.sql("""
        select a.type, t.year, count(*) as days from fact_value f
        join dim_time t on f.date_key = t.date_key join dim_asset a on f.asset_key = a.asset_key
        group by a.type, t.year""")


@query("yoy01_asset", f"""
with y as (select asset_key, year, cast(sum(close) as double) / count(*) as avg_price, min(low) as min_price, max(high) as max_price, cast(sum(volume) as double) / count(*) as avg_volume from o_prices group by 1, 2)
select c.asset_key, c.year, p.year as prev_year, round(c.avg_price, 6) as avg_price, round(p.avg_price, 6) as prev_avg_price, c.min_price, p.min_price as prev_min_price,
 c.max_price, p.max_price as prev_max_price, round(c.avg_volume, 6) as avg_volume, round(p.avg_volume, 6) as prev_avg_volume
from y c join y p on c.asset_key = p.asset_key and c.year = p.year + 1""")
def _(d):
    return rounded(metrics.asset_year_over_year(metrics.prices_of_bars(silver(d)["bars"])))

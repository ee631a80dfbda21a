"""Views over the given tables that have the shapes the operators expect.

The ``FX`` statements run unchanged on Spark SQL and on DuckDB.  ``ORACLE`` adds the
same tables as the operators build them, written independently as DuckDB SQL.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import DataFrame, SparkSession

from millrace import lookups
from millrace.operators.sized import if_small

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

_STATE2 = "case c.c_nationkey % 3 when 0 then 'OH' when 1 then 'TX' else 'CA' end"

FX = {
    "fx_bars": """
select case when p.p_type in ('ECONOMY','SMALL') then concat(p.p_type,'/USD') else p.p_type end as symbol,
       case when p.p_type in ('ECONOMY','SMALL') then 'CRYPTO' else 'STOCK' end as type,
       cast(l.l_shipdate as date) as date_parsed,
       max(cast(l.l_extendedprice as decimal(18,2))) as high,
       min(cast(l.l_extendedprice as decimal(18,2))) as low,
       max_by(cast(l.l_extendedprice as decimal(18,2)), (l.l_orderkey*10+l.l_linenumber)*100000000+cast(cast(l.l_extendedprice as decimal(18,2))*100 as bigint)) as last,
       cast(sum(l.l_quantity) as bigint) as volume
from lineitem l join part p on l.l_partkey=p.p_partkey
group by 1,2,3""",
    # Loads as they land: the second one repeats some bars, partly unusable.
    "fx_raw_bars": """
select symbol, type, cast(date_parsed as varchar(10)) as date, high, low, last, volume, 1 as load_id from fx_bars
union all
select symbol, cast(null as varchar(10)), cast(date_parsed as varchar(10)), high, low,
       case when volume % 5 = 0 then null else cast(last + 1 as decimal(18,2)) end,
       case when volume % 7 = 0 then 0 else volume end, 2
from fx_bars where volume % 3 = 0""",
    "fx_indicators": """
select 'TOTAL.CD' as series_id, n.n_name as country_code, concat('Republic of ',n.n_name) as country_name,
       cast(year(o.o_orderdate) as int) as year, cast(sum(cast(o.o_totalprice as decimal(18,2))) as decimal(30,10)) as value
from orders o join customer c on o.o_custkey=c.c_custkey join nation n on c.c_nationkey=n.n_nationkey group by 2,3,4
union all
select 'ORDERS.CNT', n.n_name, concat('Republic of ',n.n_name), cast(year(o.o_orderdate) as int), cast(count(*) as decimal(30,10))
from orders o join customer c on o.o_custkey=c.c_custkey join nation n on c.c_nationkey=n.n_nationkey group by 2,3,4""",
    # Two loads; the second repeats two thirds of the rows, some without a value.
    "fx_raw_indicators": """
select series_id, country_code, country_name, year, value, 1 as load_id from fx_indicators
union all
select series_id, country_code, country_name, year,
       case when year % 3 = 1 then null else cast(value + 1 as decimal(30,10)) end, 2
from fx_indicators where year % 3 <> 0""",
    "fx_meta": """
select distinct series_id, concat('Series ', series_id) as name, concat('All about ', series_id) as description
from fx_indicators""",
    "fx_regions": f"""
select cast(c.c_custkey as int) as region_id,
  case c.c_custkey % 6 when 0 then 'state' when 1 then 'metro' when 2 then 'county' when 3 then 'city' when 4 then 'zip' else 'neigh' end as region_type,
  case c.c_custkey % 6
   when 0 then case c.c_nationkey % 3 when 0 then 'Ohio' when 1 then 'Texas' else 'California' end
   when 1 then concat(n.n_name,', ',{_STATE2})
   when 2 then concat('C',cast(c.c_custkey as varchar(20)),';',{_STATE2},';',n.n_name,', OH')
   when 3 then concat(c.c_name,';',{_STATE2},';nan;County',cast(c.c_nationkey as varchar(20)))
   when 4 then concat(case when c.c_custkey % 12 = 4 then 'nan' else cast(10000+c.c_custkey as varchar(20)) end,';',{_STATE2},';',n.n_name,', OH;City',cast(c.c_nationkey as varchar(20)))
   else concat('N',cast(c.c_custkey as varchar(20)),';',{_STATE2},';',n.n_name,', TX;City',cast(c.c_nationkey as varchar(20)),';County',cast(c.c_nationkey as varchar(20)))
  end as region
from customer c join nation n on c.c_nationkey=n.n_nationkey""",
    "fx_housing": """
select case o.o_orderpriority when '1-URGENT' then 'LRAW' when '2-HIGH' then 'CRAW' when '3-MEDIUM' then 'IRAW' when '4-NOT SPECIFIED' then 'NRAW' else 'ZSFH' end as indicator_id,
       cast(o.o_custkey as int) as region_id, cast(o.o_orderdate as date) as date,
       cast(cast(o.o_totalprice as decimal(18,2)) as decimal(30,10)) as value
from orders o""",
    "fx_housing_indicators": """
select distinct indicator_id, concat('Housing ', indicator_id) as indicator, 'homes' as category from fx_housing""",
    # Every document is a chunk; one without a vector of its own number takes that of its number modulo 200.
    "fx_chunks": """
select d.doc_id as id, d.text, coalesce(e.embedding, f.embedding) as embedding,
       cast(2014 + d.doc_id % 10 as int) as year_key, cast(null as int) as region_key,
       case when d.doc_id % 3 = 0 then case when d.doc_id % 2 = 0 then 'FP.CPI.TOTL' else 'NY.GDP.MKTP.CD' end end as socio_indicator_key,
       case when d.doc_id % 3 = 1 then 'LRAW' end as realestate_indicator_key,
       case when d.doc_id % 3 = 2 then case when d.doc_id % 2 = 0 then 'BTC/USD' else 'AAPL' end end as asset_key
from documents d left join embeddings e on e.vec_id = d.doc_id left join embeddings f on f.vec_id = d.doc_id % 200""",
    # Every benchmark item is a question; its vector is the embedding of the same number.
    "fx_queries": """
select b.item_id as question_id, b.text, e.embedding as vector,
       cast(2014 + b.item_id % 5 as int) as first_year, cast(2017 + b.item_id % 7 as int) as last_year
from benchmark b join embeddings e on b.item_id = e.vec_id""",
    # One question per customer, over places, assets and years.
    "fx_questions": """
select c.c_custkey as question_id,
       concat(case c.c_custkey % 7 when 0 then 'What was the average list price of homes in '
                                   when 1 then 'How did inflation and unemployment move before the pandemic in '
                                   when 2 then 'Compare Bitcoin and Apple stock versus GDP in '
                                   when 3 then 'Show rents; home values of condos in West Virginia or '
                                   when 4 then 'Did exports of the United States and Ethereum rise during the pandemic in '
                                   when 5 then 'Say something about '
                                   else 'Yearly days on market and interest rate in ' end,
              case c.c_nationkey % 5 when 0 then 'Ohio' when 1 then 'Arkansas (AR)' when 2 then 'New York'
                                     when 3 then 'Kansas' else n.n_name end,
              case c.c_custkey % 4 when 0 then concat(' in ', cast(2014 + c.c_custkey % 9 as varchar(4)))
                                   when 1 then concat(' from ', cast(2012 + c.c_custkey % 5 as varchar(4)), ' to ', cast(2018 + c.c_custkey % 4 as varchar(4)))
                                   else '' end, '?') as text
from customer c join nation n on c.c_nationkey = n.n_nationkey""",
    # One question per supplier about what the documents of these tables tell.
    "fx_asked": """
select s.s_suppkey as question_id,
       concat(case s.s_suppkey % 3 when 0 then 'What was the average list price of homes in ' when 1 then 'Price reductions and inventory in '
                                   else 'Annual days on market and list price versus price reductions in ' end,
              case s.s_nationkey % 3 when 0 then 'Ohio' when 1 then 'Texas' else 'California' end,
              ' in ', cast(1996 + s.s_suppkey % 4 as varchar(4)), '?') as text
from supplier s""",
}

# Symbols and codes the fixtures use where the defaults name real ones.
SYMBOLS = ["ECONOMY/USD", "SMALL/USD", "LARGE", "MEDIUM", "PROMO"]
HOUSING_CODES = ["LRAW", "CRAW", "IRAW", "NRAW"]
HOUSING_SINCE = "1996-01-01"
EXTRA_UNITS = [("TOTAL.CD", "USD_CURRENT"), ("ORDERS.CNT", "COUNT")]


def _values(rows, names) -> str:
    quoted = ",".join(
        "(" + ",".join("'" + str(v).replace("'", "''") + "'" for v in row) + ")" for row in rows
    )
    return f"select * from (values {quoted}) as t({names})"


def _in(items) -> str:
    return ",".join(f"'{i}'" for i in items)


# The 32-bit Murmur3 of a short ASCII string with seed 42, as Spark computes it: whole
# words first, then each remaining byte on its own.
def _mix_k(k: str) -> str:
    m = f"((({k}) * 3432918353::ubigint) % 4294967296)"
    r = f"((({m} * 32768) % 4294967296) + ({m} // 131072))"
    return f"(({r} * 461845907::ubigint) % 4294967296)"


def murmur3(s: str) -> str:
    """DuckDB expression for Spark's hash() of the ASCII string expression ``s``."""
    byte = lambda i: f"ord(substr({s}, cast({i} as bigint), 1))::ubigint"
    word = f"({byte('4*i+1')} + 256*{byte('4*i+2')} + 65536*{byte('4*i+3')} + 16777216*{byte('4*i+4')})"
    ks = (
        f"list_concat([{_mix_k(word)} for i in range(length({s}) // 4)],"
        f" [{_mix_k(byte('i+1'))} for i in range((length({s}) // 4) * 4, length({s}))])"
    )
    x = "xor(h, k)"
    rot = f"((({x} * 8192) % 4294967296) + ({x} // 524288))"
    h1 = f"list_reduce({ks}, lambda h, k: (({rot} * 5 + 3864292196::ubigint) % 4294967296), 42::ubigint)"
    h2 = f"(select xor(h, h // 65536) from (select xor({h1}, length({s})::ubigint) as h))"
    h3 = f"(select xor(h, h // 8192) from (select ({h2} * 2246822507::ubigint) % 4294967296 as h))"
    h4 = f"(select xor(h, h // 65536) from (select ({h3} * 3266489909::ubigint) % 4294967296 as h))"
    return f"(select cast(case when h >= 2147483648 then h::bigint - 4294967296 else h::bigint end as int) from (select {h4} as h))"


ORACLE = {
    **FX,
    "lk_states": _values(lookups.pairs(lookups.STATES), "state_name, state_code"),
    "lk_units": _values(lookups.pairs(lookups.SERIES_UNITS, None) + EXTRA_UNITS, "series_id, unit"),
    "lk_house_units": _values(lookups.pairs(lookups.HOUSING_UNITS, None), "indicator_id, unit"),
    "lk_house_desc": _values(lookups.pairs(lookups.HOUSING_DESCRIPTIONS), "indicator_id, description"),
    "lk_aliases": _values(lookups.pairs(lookups.ENTITY_ALIASES), "alias, asset_key"),
    "lk_socio": _values([(k, " ".join(c)) for k, c in lookups.code_lists(lookups.SOCIO_KEYWORDS)], "keyword, codes"),
    "lk_housing": _values([(k, " ".join(c)) for k, c in lookups.code_lists(lookups.HOUSING_KEYWORDS)], "keyword, codes"),
    "lk_eras": _values([(p, *v.split()) for p, v in lookups.pairs(lookups.ERAS)], "phrase, era_start, era_end"),
    "sv_bars": f"""
select symbol, date, high, low, last, volume, load_id,
       coalesce(type, case when contains(symbol, '/') then 'CRYPTO' else 'STOCK' end) as type,
       cast(date as date) as date_parsed, cast(year(cast(date as date)) as int) as year
from (select *, row_number() over (partition by symbol, date order by load_id desc) as rn
      from fx_raw_bars where last is not null and volume > 0 and symbol in ({_in(SYMBOLS)}))
where rn = 1""",
    "sv_indicators": """
select i.series_id, i.country_code, i.country_name, i.year, i.value, m.name as indicator_name, m.description as indicator_description
from (select *, row_number() over (partition by series_id, country_code, year order by load_id desc) as rn
      from fx_raw_indicators where value is not null and year is not null and series_id is not null) i
left join fx_meta m on i.series_id = m.series_id where rn = 1""",
    "sv_housing": f"""
select h.indicator_id, h.region_id, h.date, h.value, n.indicator, r.region_type, r.region
from fx_housing h left join fx_housing_indicators n on h.indicator_id = n.indicator_id
left join fx_regions r on h.region_id = r.region_id
where h.indicator_id in ({_in(HOUSING_CODES)}) and h.date >= date '{HOUSING_SINCE}'""",
    "o_dim_time": """
select date_key, dayname(date_key) as day_name, cast(weekofyear(date_key) as int) as week_number,
       cast(month(date_key) as int) as month_number, monthname(date_key) as month_name, cast(year(date_key) as int) as year
from (select make_date(year, 1, 1) as date_key from sv_indicators union select date from sv_housing union select date_parsed from sv_bars)
where date_key is not null""",
    "o_dim_country": f"""
select {murmur3('country_code')} as country_key, min(country_name) as country_name, country_code
from (select country_code, country_name from sv_indicators union select 'USA', 'United States') group by country_code""",
    "o_region": f"""
select region_id, region_type, region,
  case when region_type = 'state' then s.state_code
       when region_type = 'metro' and contains(region, ',') then trim(regexp_extract(region, '([^,]*)$', 1))
       else string_split(region, ';')[2] end as state_code,
  case when region_type = 'metro' then trim(regexp_replace(region, ',[^,]*$', ''))
       when region_type <> 'state' then nullif(regexp_replace(string_split(region, ';')[3], ',[^,]*$', ''), 'nan') end as metro_name,
  case when region_type = 'county' then string_split(region, ';')[1] when region_type in ('city','zip') then string_split(region, ';')[4]
       when region_type = 'neigh' then string_split(region, ';')[5] end as county_name,
  case when region_type = 'city' then string_split(region, ';')[1] when region_type in ('zip','neigh') then string_split(region, ';')[4] end as city_name,
  case when region_type = 'zip' then case when string_split(region, ';')[1] = 'nan' then '00000' else string_split(region, ';')[1] end end as zip_key,
  case when region_type = 'neigh' then string_split(region, ';')[1] end as neighborhood_name
from fx_regions left join lk_states s on region = s.state_name""",
    "o_dim_region": f"""
select r.region_id as region_key, {murmur3("'USA'")} as country_key, r.region_type, r.zip_key, r.neighborhood_name,
       r.city_name, r.county_name, r.metro_name, s.state_name, r.state_code
from o_region r left join lk_states s on trim(r.state_code) = s.state_code
where r.region_id in (select region_id from sv_housing)""",
    "o_dim_value": """
select cast(row_number() over (order by md5(concat_ws('||', cast(value as varchar), unit))) as int) as value_key, value, unit
from (select i.value, coalesce(u.unit, 'UNKNOWN') as unit from sv_indicators i left join lk_units u on i.series_id = u.series_id
      union select h.value, coalesce(u.unit, 'USD_CURRENT') from sv_housing h left join lk_house_units u on h.indicator_id = u.indicator_id)""",
    "o_dim_socio": "select series_id as socioeconomical_indicator_key, name, description from fx_meta",
    "o_dim_house": """
select distinct h.indicator_id as realestate_indicator_key, h.indicator as indicator_name, coalesce(d.description, '') as indicator_description
from sv_housing h left join lk_house_desc d on h.indicator_id = d.indicator_id""",
    "o_dim_asset": "select distinct symbol as asset_key, type from sv_bars",
    "o_dim_asset_value": """
select cast(row_number() over (order by symbol, date_parsed, high, low, close, volume) as int) as cryptostock_value_key, *
from (select distinct symbol, date_parsed, high, low, cast(volume as decimal(30,10)) as volume, last as close from sv_bars)""",
    "o_fact_indicator": """
select distinct v.value_key, i.series_id as socioeconomical_indicator_key, c.country_key, make_date(i.year, 1, 1) as date_key
from sv_indicators i left join lk_units u on i.series_id = u.series_id
join o_dim_value v on v.value = i.value and v.unit = coalesce(u.unit, 'UNKNOWN')
join o_dim_country c on c.country_code = i.country_code""",
    "o_fact_housing": """
select distinct v.value_key, h.indicator_id as realestate_indicator_key, r.region_key, r.country_key, h.date as date_key
from sv_housing h left join lk_house_units u on h.indicator_id = u.indicator_id
join o_dim_value v on v.value = h.value and v.unit = coalesce(u.unit, 'USD_CURRENT')
join o_dim_region r on r.region_key = h.region_id""",
    "o_fact_asset": """
select distinct v.cryptostock_value_key, b.date_parsed as date_key, b.symbol as asset_key
from sv_bars b join o_dim_asset_value v on b.symbol = v.symbol and b.date_parsed = v.date_parsed and b.high = v.high
 and b.low = v.low and b.last = v.close and b.volume = v.volume""",
    "o_fact_value": """
select value_key, socioeconomical_indicator_key, cast(null as varchar) as realestate_indicator_key, cast(null as int) as region_key,
       cast(null as int) as cryptostock_value_key, country_key, date_key, cast(null as varchar) as asset_key, cast(year(date_key) as int) as year
from o_fact_indicator
union all select value_key, null, realestate_indicator_key, region_key, null, country_key, date_key, null, cast(year(date_key) as int) from o_fact_housing
union all select null, null, null, null, cryptostock_value_key, null, date_key, asset_key, cast(year(date_key) as int) from o_fact_asset""",
    "o_prices": """
select symbol as asset_key, type, date_parsed as date, year, cast(month(date_parsed) as int) as month_number,
       high, low, last as close, volume from sv_bars""",
    "o_indicator_figures": """
select i.series_id, i.indicator_name, i.indicator_description, i.country_code, i.country_name, i.year, i.value, coalesce(u.unit, 'UNKNOWN') as unit
from sv_indicators i left join lk_units u on i.series_id = u.series_id""",
    "o_housing_figures": """
select distinct h.indicator_id as realestate_indicator_key, d.indicator_name, d.indicator_description, r.*, t.*, h.value,
       coalesce(u.unit, 'USD_CURRENT') as unit, 'USA' as country_code, 'United States' as country_name, v.value_key
from sv_housing h join o_dim_house d on h.indicator_id = d.realestate_indicator_key
join o_dim_region r on r.region_key = h.region_id join o_dim_time t on t.date_key = h.date
left join lk_house_units u on h.indicator_id = u.indicator_id
join o_dim_value v on v.value = h.value and v.unit = coalesce(u.unit, 'USD_CURRENT')""",
    "o_sim": """
select q.question_id, c.id, c.year_key, c.text, c.socio_indicator_key, c.realestate_indicator_key, c.asset_key, q.first_year, q.last_year,
       round(list_cosine_similarity(cast(q.vector as double[]), cast(c.embedding as double[])), 9) as similarity
from fx_queries q cross join fx_chunks c""",
}


@functools.lru_cache(maxsize=None)
def _needs(text: str) -> tuple[str, ...]:
    """Names of the views a statement uses, each after those it depends on itself."""
    order: list[str] = []

    def visit(sql: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b(?:fx|lk|sv|o)_[a-z0-9_]+", sql)):
            if name in ORACLE and name not in order:
                visit(ORACLE[name])
                if name not in order:
                    order.append(name)

    visit(text)
    return tuple(order)


def oracle(text: str) -> str:
    """A statement that runs on the given tables alone: its views as CTEs in front."""
    ctes = ", ".join(f"{name} as ({ORACLE[name]})" for name in _needs(text))
    body = text.strip()
    if not ctes:
        return body
    if body.lower().startswith("with "):
        return f"with {ctes}, {body[5:]}"
    return f"with {ctes} {body}"


class Data:
    """The given tables of one folder and the fixture views, as DataFrames.

    Only plans are kept between uses, never data.
    """

    _plans: dict[tuple[str, str, str], DataFrame] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES and name not in FX:
            raise AttributeError(name)
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in self._plans:
            self._plans[key] = self.view(name) if name in FX else self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._plans[key]

    def view(self, name: str, **given: DataFrame) -> DataFrame:
        """A fixture over the tables and fixtures its text names, or those ``given`` in their place."""
        used = [n for n in [*TABLES, *FX] if n != name and re.search(rf"\b(from|join) {n}\b", FX[name])]
        text, tables = FX[name], {n: given[n] if n in given else getattr(self, n) for n in used}
        if name == "fx_chunks":
            # A remainder of 200 meets 399 numbers at most, so the texts need not move for it.
            text = text.replace("join embeddings f", "join {few} f")
            tables["few"] = if_small(self.embeddings.filter("vec_id between -199 and 199"))
        for n in used:
            text = re.sub(rf"\b(from|join) {n}\b", rf"\1 {{{n}}}", text)
        return self.spark.sql(text, **tables)

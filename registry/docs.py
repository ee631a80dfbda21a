"""Documents: text parity with wording computed by DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.plans import documents as D, metrics, prices as P
from registry.basics import rounded
from registry.book import STATEMENTS, query
from registry.lake import gold
from registry.scalars import f, mag, pct, unit_text

c = F.col


def _prices(d):
    return P.asset_prices(gold(d))


def _text(df, *keys):
    return df.select(*keys, "text")


_KIND = "case when contains(asset_key, '/') then 'cryptocurrency' else 'stock' end"
_LABEL = "replace(asset_key, '/', ' to ')"
_WORDS = "case unit when 'USD_CURRENT' then 'current US dollars' when 'COUNT' then 'count' else 'units' end"


@query("doc01_asset_day", f"""
select asset_key, year as year_key, concat({_LABEL}, ', a ', {_KIND}, ' listed as ', asset_key, ', on ', monthname(date), ' ', day(date), ', ', year, ' (', date, '): closed at ',
 {f('close')}, ' USD, highest ', {f('high')}, ' USD, lowest ', {f('low')}, ' USD. The range of the day was ', {f('high - low')}, ' USD or ',
 {f('case when close > 0 then cast(high - low as double) / cast(close as double) * 100 else 0 end')}, '% of the close, on a volume of ', {f('volume', 0, True)}, ' units.') as text
from o_prices""")
def _(d):
    return _text(D.doc_asset_day(_prices(d)), "asset_key", "year_key")


@query("doc02_indicator_year", f"""
select series_id as socio_indicator_key, year as year_key, concat(country_name, ' (', country_code, '), ', year, ': ', indicator_name, ' was ', {mag('value')}, ' ', {_WORDS}, '. Series ', series_id, ': ', indicator_description, '.') as text
from o_indicator_figures""")
def _(d):
    return _text(D.doc_indicator_year(P.indicator_figures(gold(d))), "socio_indicator_key", "year_key")


_PLACE = """concat_ws(', ', case when coalesce(neighborhood_name, '') <> '' then concat('neighborhood ', neighborhood_name) end,
 case when coalesce(city_name, '') <> '' then concat('city of ', city_name) end, case when coalesce(county_name, '') <> '' then concat(county_name, ' County') end,
 case when coalesce(metro_name, '') <> '' then concat(metro_name, ' metro area') end, case when coalesce(state_name, '') <> '' then concat('state of ', state_name) end,
 case when coalesce(state_code, '') <> '' then concat('state code ', state_code) end, case when coalesce(zip_key, '') <> '' then concat('ZIP ', zip_key) end, concat(country_name, ' (', country_code, ')'))"""
_SOME_CODES = "realestate_indicator_key in ('LRAW', 'CRAW') and date_key between date '1996-01-01' and date '1999-12-31'"
_HOUSE_WORDS = "case unit when 'USD_CURRENT' then 'US dollars' when 'PERCENTAGE' then 'percent' when 'DAYS' then 'days' else 'units' end"


@query("doc03_housing", f"""
select region_key, realestate_indicator_key, year as year_key, concat('Housing in ', {_PLACE}, ', ', month_name, ' ', year, ' (week ', week_number, '): ', realestate_indicator_key, '-', indicator_name, ', ', indicator_description,
 ', stood at ', {unit_text('value', 'unit')}, ' (', {_HOUSE_WORDS}, '). Level: ', region_type, '.') as text
from o_housing_figures where {_SOME_CODES}""")
def _(d):
    kept = D.recent_housing(P.housing_figures(gold(d)), ["LRAW", "CRAW"], "1996-01-01", "1999-12-31")
    return _text(D.doc_housing(kept), "region_key", "realestate_indicator_key", "year_key")


_WENT = "case when {0} > 0 then '{1}' else '{2}' end"


@query("doc04_indicator_trend", f"""
with t as (select country_code, country_name, series_id, indicator_name, unit, min(year) as y0, max(year) as y1, cast(min_by(value, year) as double) as v0, cast(max_by(value, year) as double) as v1, count(*) as n,
  min_by(indicator_description, year) as about, string_agg(concat(year, ': ', {mag('value')}), ', ' order by year) as lines
  from o_indicator_figures group by country_code, country_name, series_id, indicator_name, unit having count(*) >= 3)
select series_id as socio_indicator_key, y1 as year_key, concat(indicator_name, ' of ', country_name, ' (', country_code, ') from ', y0, ' to ', y1, ', ', n, ' years: ', {_WENT.format('v1 - v0', 'increased', 'decreased')}, ' from ',
 {mag('v0')}, ' to ', {mag('v1')}, ', a ', {_WENT.format('v1 - v0', 'growth', 'decline')}, ' of ', {f(f"abs({pct('v1', 'v0')})")}, '%. By year: ', lines, '. In ', {_WORDS}, '. Series ', series_id, ': ', about, '.') as text from t""")
def _(d):
    return _text(D.doc_indicator_trend(D.indicator_trends(P.indicator_figures(gold(d)))), "socio_indicator_key", "year_key")


@query("doc05_indicator_year_over_year", f"""
with p as (select c.*, p.year as py, cast(p.value as double) as pv, cast(c.value as double) as cv from o_indicator_figures c join o_indicator_figures p on c.country_code = p.country_code and c.series_id = p.series_id and c.year = p.year + 1)
select series_id as socio_indicator_key, year as year_key, concat(indicator_name, ' of ', country_name, ' (', country_code, ') ', {_WENT.format('cv - pv', 'increased', 'decreased')}, ' from ', {mag('pv')}, ' in ', py, ' to ', {mag('cv')}, ' in ', year, ': ',
 {f(f"abs({pct('cv', 'pv')})")}, '% or ', case when cv - pv > 0 then '+' else '' end, {mag('abs(cv - pv)')}, ' in ', {_WORDS}, ', a ', {_WENT.format('cv - pv', 'growth', 'decline')}, '. Series ', series_id, ': ', indicator_description, '.') as text from p""")
def _(d):
    pairs = D.indicator_year_over_year(P.indicator_figures(gold(d)))
    return _text(D.doc_indicator_year_over_year(pairs), "socio_indicator_key", "year_key")


_AVG = "cast(sum({0}) as double) / count({0})"


@query("doc06_asset_month", f"""
with m as (select asset_key, year, month_number, {_AVG.format('close')} as a, min(low) as lo, max(high) as hi, {_AVG.format('volume')} as v, count(*) as n from o_prices group by 1, 2, 3)
select asset_key, year as year_key, concat(asset_key, ' in month ', month_number, ' of ', year, ': mean close ', {f('a')}, ' USD over ', n, ' trading days, between ', {f('lo')}, ' and ', {f('hi')}, ' USD, with ', {f('v', 0, True)}, ' units a day.') as text from m""")
def _(d):
    return _text(D.doc_asset_month(metrics.asset_month(_prices(d))), "asset_key", "year_key")


@query("doc07_asset_year", f"""
with y as (select asset_key, year, min(close) as c0, max(close) as c1, min(low) as lo, max(high) as hi, {_AVG.format('close')} as a, coalesce(stddev(cast(close as double)), 0) as sd,
  sum(volume) as tv, {_AVG.format('volume')} as v, count(*) as n, min(date) as d0, max(date) as d1 from o_prices group by 1, 2 having count(*) >= 2)
select asset_key, year as year_key, concat('Year ', year, ' of ', {_LABEL}, ' (', asset_key, '), a ', {_KIND}, ': ', n, ' trading days between ', d0, ' and ', d1, '. Closing prices ran from ', {f('c0')}, ' to ', {f('c1')}, ' USD, a ',
 {_WENT.format('cast(c1 as double) - cast(c0 as double)', 'gain', 'loss')}, ' of ', {f(f"abs({pct('c1', 'c0', '>')})")}, '% (', case when cast(c1 as double) - cast(c0 as double) > 0 then '+' else '-' end, {f('abs(cast(c1 as double) - cast(c0 as double))')},
 ' USD). Highest ', {f('hi')}, ', lowest ', {f('lo')}, ', range ', {f('hi - lo')}, ' USD. Mean close ', {f('a')}, ' USD with a deviation of ', {f('sd')}, ' USD: ',
 case when sd / a > 0.3 then 'high' when sd / a > 0.1 then 'moderate' else 'low' end, ' volatility. Volume ', {f('tv', 0, True)}, ' units in all and ', {f('v', 0, True)}, ' a day.') as text from y""")
def _(d):
    return _text(D.doc_asset_year(metrics.asset_year(_prices(d))), "asset_key", "year_key")


@query("doc08_asset_year_over_year", f"""
with y as (select asset_key, year, {_AVG.format('close')} as a, min(low) as lo, max(high) as hi, {_AVG.format('volume')} as v from o_prices group by 1, 2),
p as (select c.*, p.year as py, p.a as pa, p.lo as plo, p.hi as phi, p.v as pv from y c join y p on c.asset_key = p.asset_key and c.year = p.year + 1),
x as (select *, {pct('a', 'pa', '>')} as da, {pct('lo', 'plo', '>')} as dlo, {pct('hi', 'phi', '>')} as dhi, {pct('v', 'pv', '>')} as dv from p)
select asset_key, year as year_key, concat({_LABEL}, ' (', asset_key, '), ', year, ' against ', py, ': mean close ', {_WENT.format('da', 'increased', 'decreased')}, ' from ', {f('pa')}, ' to ', {f('a')}, ' USD (', {f('abs(da)')}, '%). High of the year ',
 {f('phi')}, ' to ', {f('hi')}, ' USD (', case when dhi > 0 then '+' else '' end, {f('dhi')}, '%), low of the year ', {f('plo')}, ' to ', {f('lo')}, ' USD (', case when dlo > 0 then '+' else '' end, {f('dlo')}, '%). Daily volume ',
 {_WENT.format('dv', 'increased', 'decreased')}, ' by ', {f('abs(dv)')}, '%, from ', {f('pv', 0, True)}, ' to ', {f('v', 0, True)}, ' units: a year of ', {_WENT.format('da', 'growth', 'decline')}, '.') as text from x""")
def _(d):
    return _text(D.doc_asset_year_over_year(metrics.asset_year_over_year(_prices(d))), "asset_key", "year_key")


@query("doc09_asset_trend", f"""
with y as (select asset_key, year, {_AVG.format('close')} as a from o_prices group by 1, 2),
l as (select asset_key, string_agg(concat(year, ': $', {f('a')}), ', ' order by year) as lines, min_by(a, year) as a0, max_by(a, year) as a1 from y group by 1),
t as (select asset_key, min(year) as y0, max(year) as y1, count(distinct year) as n, min(close) as atl, max(high) as ath, {_AVG.format('close')} as a, sum(volume) as tv from o_prices group by 1 having count(distinct year) >= 3),
x as (select t.*, lines, a0, a1, {pct('a1', 'a0', '>')} as dp from t join l on t.asset_key = l.asset_key)
select asset_key, y1 as year_key, concat({_LABEL}, ' (', asset_key, '), a ', {_KIND}, ', over ', n, ' years from ', y0, ' to ', y1, ': ', {_WENT.format('dp', 'growth', 'decline')}, ' of ', {f('abs(dp)')}, '%, from a mean of ', {f('a0')}, ' USD to ', {f('a1')},
 ' USD. All-time high ', {f('ath')}, ' USD, all-time low ', {f('atl')}, ' USD, mean of all days ', {f('a')}, ' USD, total volume ', {f('tv', 0, True)}, ' units. Yearly means: ', lines, '.') as text from x""")
def _(d):
    return _text(D.doc_asset_trend(D.asset_trends(_prices(d))), "asset_key", "year_key")


@query("doc10_housing_state_year", f"""
with s as (select realestate_indicator_key, indicator_name, indicator_description, state_name, state_code, year, unit, {_AVG.format('value')} as a, min(value) as lo, max(value) as hi, stddev(cast(value as double)) as sd, count(*) as n
  from o_housing_figures where date_key between date '1996-01-01' and date '1999-12-31' and state_code is not null group by 1, 2, 3, 4, 5, 6, 7 having count(*) >= 3)
select realestate_indicator_key, year as year_key, concat('Annual real estate summary, ', coalesce(state_name, 'unknown state'), ' (', state_code, '), ', year, ': ', realestate_indicator_key, '-', indicator_name, ', ', indicator_description,
 '. Mean ', {unit_text('a', 'unit')}, ', minimum ', {unit_text('lo', 'unit')}, ', maximum ', {unit_text('hi', 'unit')}, ', standard deviation ', {unit_text('sd', 'unit')}, ', from ', n, ' figures.') as text from s""")
def _(d):
    stats = metrics.state_year(P.housing_figures(gold(d)), "1996-01-01", "1999-12-31")
    return _text(D.doc_housing_state_year(stats), "realestate_indicator_key", "year_key")


def corpus(d, prices=None):
    """All years and codes."""
    g = gold(d)
    return D.corpus(P.asset_prices(g) if prices is None else prices, P.indicator_figures(g), P.housing_figures(g))


_KIND_QUERIES = {
    "housing": "doc03_housing", "housing_state_year": "doc10_housing_state_year", "asset_day": "doc01_asset_day", "indicator_year": "doc02_indicator_year",
    "indicator_trend": "doc04_indicator_trend", "indicator_year_over_year": "doc05_indicator_year_over_year", "asset_month": "doc06_asset_month",
    "asset_year": "doc07_asset_year", "asset_year_over_year": "doc08_asset_year_over_year", "asset_trend": "doc09_asset_trend",
}


def kind_sql(kind: str, prices: str = "o_prices") -> str:
    """Oracle of all documents of a kind, over all codes and years."""
    sql = STATEMENTS[_KIND_QUERIES[kind]].replace(_SOME_CODES, "true").replace("date_key between date '1996-01-01' and date '1999-12-31' and ", "")
    return sql.replace("from o_prices", f"from {prices}")


CORPUS = " union all ".join(f"select '{kind}' as doc_kind, text from ({kind_sql(kind)})" for kind in _KIND_QUERIES)


@query("doc11_corpus", f"select doc_kind, md5(text) as digest, count(*) as documents from ({CORPUS}) group by 1, 2")
def _(d):
    """Every document of every kind by the digest of its text."""
    return corpus(d).groupBy("doc_kind", F.md5("text").alias("digest")).agg(F.count(F.lit(1)).alias("documents"))


_EARLY = "(select * from o_prices where year < 1998)"
_ASSET_KINDS = [k for k in _KIND_QUERIES if k.startswith("asset")]
_ONE, _TWO = (" union all ".join(f"select '{kind}' as doc_kind, text from ({kind_sql(kind, prices)})" for kind in _ASSET_KINDS) for prices in (_EARLY, "o_prices"))


@query("doc11_changes", f"""
with one as (select distinct doc_kind, md5(text) as digest from ({_ONE})), two as (select distinct doc_kind, md5(text) as digest from ({_TWO}))
select *, 'added' as change from (from two except from one) union all select *, 'removed' from (from one except from two)""")
def _(d):
    """What the corpus gains and loses when the bars from 1998 on arrive."""
    prices = P.asset_prices(gold(d))
    changed = D.corpus_changes(corpus(d, prices.filter("year < 1998")), corpus(d, prices))
    return changed.select("doc_kind", F.md5("text").alias("digest"), "change")

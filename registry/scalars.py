"""Scalar functions and region paths over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace import lookups
from millrace.functions import dates, hashing, paths, text as X, vectors
from millrace.operators.lookup import with_lookup
from millrace.plans import star
from millrace.plans.retrieve import add_state_code
from registry.basics import house_figures, prices, rounded
from registry.book import query
from registry.fixtures import murmur3

c = F.col


# DuckDB wording of numbers, written independently of the library.
def f(x, places=2, comma=False):
    return f"format('{{:{',' if comma else ''}.{places}f}}', cast({x} as double))"


def mag(x):
    return (
        f"case when {x} >= 1e12 then concat({f(f'cast({x} as double) / 1e12')}, ' trillion') when {x} >= 1e9 then concat({f(f'cast({x} as double) / 1e9')}, ' billion')"
        f" when {x} >= 1e6 then concat({f(f'cast({x} as double) / 1e6')}, ' million') else {f(x, 2, True)} end"
    )


def unit_text(x, unit):
    return (
        f"case when {x} is null then 'N/A' when {unit} = 'USD_CURRENT' then concat('$', {f(x, 2, True)})"
        f" when {unit} = 'PERCENTAGE' then concat({f(x)}, '%') when {unit} = 'DAYS' then concat({f(x, 0)}, ' days') else {f(x, 2, True)} end"
    )


def pct(cur, prev, test="<>"):
    a, b = f"cast({cur} as double)", f"cast({prev} as double)"
    return f"case when {b} {test} 0 then ({a} - {b}) / {b} * 100 else 0 end"


@query("scl01_parse_date", """
select event_id, cast(case when event_id % 3 = 0 then cast(cast(ts as date) as varchar) end as date) as day from events""")
def _(d):
    raw = F.when(c("event_id") % 3 == 0, c("ts").cast("date").cast("string")).when(c("event_id") % 3 == 1, "2024-13-45").otherwise("soon")
    return d.events.select("event_id", dates.parse_day(raw).alias("day"))


@query("scl02_year_month_week", "select o_orderkey, cast(year(o_orderdate) as int) as y, cast(month(o_orderdate) as int) as m, cast(weekofyear(o_orderdate) as int) as w from orders")
def _(d):
    cal = dates.calendar(c("o_orderdate"))
    return d.orders.select("o_orderkey", cal["year"].alias("y"), cal["month_number"].alias("m"), cal["week_number"].alias("w"))


@query("scl03_names", "select o_orderkey, dayname(o_orderdate) as day_name, monthname(o_orderdate) as month_name from orders")
def _(d):
    cal = dates.calendar(c("o_orderdate"))
    return d.orders.select("o_orderkey", cal["day_name"].alias("day_name"), cal["month_name"].alias("month_name"))


@query("scl04_date_words", "select o_orderkey, concat(monthname(o_orderdate), ' ', day(o_orderdate), ', ', year(o_orderdate)) as words from orders")
def _(d):
    at = c("o_orderdate")
    words = F.concat(F.date_format(at, "MMMM"), F.lit(" "), F.dayofmonth(at).cast("string"), F.lit(", "), F.year(at).cast("string"))
    return d.orders.select("o_orderkey", words.alias("words"))


@query("scl05_first_ten", "select event_id, substr(strftime(ts, '%Y-%m-%dT%H:%M:%S'), 1, 10) as day from events")
def _(d):
    return d.events.select("event_id", F.substring(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), 1, 10).alias("day"))


@query("scl06_join_strings", "select region_id, concat_ws('-', region_type, case when region_id % 4 = 0 then null else region end, cast(region_id as varchar)) as joined from fx_regions")
def _(d):
    return d.fx_regions.select("region_id", F.concat_ws(
        "-", "region_type", F.when(c("region_id") % 4 != 0, c("region")), c("region_id").cast("string")).alias("joined"))


@query("scl07_md5", "select indicator_id, value, md5(concat_ws('||', cast(value as varchar), indicator_id)) as h from fx_housing")
def _(d):
    return d.fx_housing.select("indicator_id", "value", hashing.content_md5(c("value"), c("indicator_id")).alias("h"))


@query("scl08_hash_key", f"select c_name, {murmur3('c_name')} as key from customer")
def _(d):
    return d.customer.select("c_name", hashing.hash_key(c("c_name")).alias("key"))


@query("scl09_split_get", "select region_id, string_split(region, ';')[1] as p0, string_split(region, ';')[3] as p2, string_split(region, ';')[5] as p4 from fx_regions")
def _(d):
    r = c("region")
    return d.fx_regions.select("region_id", paths.part(r, 0).alias("p0"), paths.part(r, 2).alias("p2"), paths.part(r, 4).alias("p4"))


@query("scl10_last_comma", r"""
select region_id, regexp_replace(region, ',[^,]*$', '') as head, trim(regexp_extract(region, '([^,]*)$', 1)) as tail from fx_regions""")
def _(d):
    return d.fx_regions.select(
        "region_id", paths.before_last_comma(c("region")).alias("head"), paths.after_last_comma(c("region")).alias("tail")
    )


@query("scl11_text_basics", "select doc_id, md5(lower(trim(text))) as lowered, length(replace(text, ' ', '')) as letters, contains(text, 'the') as has_the from documents")
def _(d):
    t = c("text")
    return d.documents.select(
        "doc_id", F.md5(F.lower(F.trim(t))).alias("lowered"),
        F.length(F.replace(t, F.lit(" "), F.lit(""))).cast("long").alias("letters"), t.contains("the").alias("has_the"),
    )


@query("scl12_first_non_null", "select symbol, date, load_id, coalesce(type, 'UNKNOWN') as type, coalesce(last, high, 0) as last_or_high from fx_raw_bars")
def _(d):
    return d.fx_raw_bars.select(
        "symbol", "date", "load_id", F.coalesce("type", F.lit("UNKNOWN")).alias("type"),
        F.coalesce("last", "high", F.lit(0).cast("decimal(18,2)")).alias("last_or_high"),
    )


@query("scl13_format_number", f"select l_orderkey, {f('l_extendedprice * l_discount')} as two, {f('l_extendedprice * l_tax', 0, True)} as whole, {f('l_extendedprice * -1.005', 2, True)} as neg from lineitem")
def _(d):
    p = c("l_extendedprice")
    return d.lineitem.select(
        "l_orderkey", X.fmt(p * c("l_discount")).alias("two"), X.fmt(p * c("l_tax"), 0, True).alias("whole"),
        X.fmt(p * -1.005, 2, True).alias("neg"),
    )


@query("scl14_magnitude", f"select o_orderkey, {mag('o_totalprice')} as m1, {mag('(o_totalprice * 100)')} as m2, {mag('(o_totalprice * 100000)')} as m3, {mag('(o_totalprice * 100000000)')} as m4, {mag('(o_totalprice * -1000)')} as m5 from orders")
def _(d):
    return d.orders.select("o_orderkey", *[
        X.magnitude(c("o_totalprice") * k).alias(f"m{i}") for i, k in enumerate((1, 100, 100000, 100000000, -1000), 1)
    ])


@query("scl15_by_unit", f"""
select h.region_id, h.date, coalesce(u.unit, 'USD_CURRENT') as unit, {unit_text('h.value', "coalesce(u.unit, 'USD_CURRENT')")} as text, {unit_text('(case when h.region_id % 5 > 0 then h.value end)', "coalesce(u.unit, 'USD_CURRENT')")} as some
from fx_housing h left join lk_house_units u on h.indicator_id = u.indicator_id""")
def _(d):
    priced = star.housing_values(d.fx_housing, lookups.housing_units(d.spark))
    some = F.when(c("region_id") % 5 > 0, c("value"))
    return priced.select(
        "region_id", "date", "unit", X.by_unit(c("value"), c("unit")).alias("text"), X.by_unit(some, c("unit")).alias("some")
    )


@query("scl16_pct_change", f"""
select l_orderkey, l_linenumber, l_partkey, round({pct('l_extendedprice', '(l_discount - 0.05)')}, 6) as change, round({pct('l_extendedprice', '(l_discount - 0.05)', '>')}, 6) as change_pos from lineitem""")
def _(d):
    prev = c("l_discount") - 0.05
    return rounded(d.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", X.pct_change(c("l_extendedprice"), prev).alias("change"),
        X.pct_change(c("l_extendedprice"), prev, True).alias("change_pos"),
    ))


@query("scl17_range_pct", "select symbol, date_parsed, cast(high - low as double) as spread, round(case when last > 0 then cast(high - low as double) / cast(last as double) * 100 else 0 end, 6) as pct from fx_bars")
def _(d):
    return rounded(d.fx_bars.select(
        "symbol", "date_parsed", (c("high") - c("low")).cast("double").alias("spread"),
        X.range_pct(c("high"), c("low"), c("last")).alias("pct"),
    ))


@query("scl18_volatility_class", """
select symbol, date_parsed, case when last > 0 and cast(high - low as double) / cast(last as double) > 0.3 then 'high' when last > 0 and cast(high - low as double) / cast(last as double) > 0.1 then 'moderate' else 'low' end as class from fx_bars""")
def _(d):
    spread, last = (c("high") - c("low")).cast("double"), c("last").cast("double")
    return d.fx_bars.select("symbol", "date_parsed", X.volatility_class(spread, last).alias("class"))


@query("scl19_asset_kind", "select distinct symbol, case when contains(symbol, '/') then 'cryptocurrency' else 'stock' end as kind, replace(symbol, '/', ' to ') as label from fx_bars")
def _(d):
    return d.fx_bars.select("symbol", X.asset_kind(c("symbol")).alias("kind"), X.asset_label(c("symbol")).alias("label")).distinct()


@query("scl20_direction", f"""
select c_custkey, case when c_acctbal > 5000 then 'up' else 'down' end as word, concat(case when c_acctbal > 0 then '+' else '-' end, {f('abs(c_acctbal)')}) as signed from customer""")
def _(d):
    b = c("c_acctbal")
    return d.customer.select(
        "c_custkey", X.rose(b - 5000, "up", "down").alias("word"), X.signed(b, X.fmt(F.abs(b)), "-").alias("signed")
    )


@query("scl22_cosine", """
select q.question_id, c.id, round(list_cosine_similarity(cast(q.vector as double[]), cast(c.embedding as double[])), 6) as similarity
from fx_chunks c join fx_queries q on q.question_id = c.id % (select count(*) from fx_queries)""")
def _(d):
    """One pair a chunk, every query used."""
    pairs = d.fx_chunks.join(d.fx_queries, c("question_id") == c("id") % d.fx_queries.count())
    return rounded(pairs.select("question_id", "id", vectors.cosine(c("vector"), c("embedding")).alias("similarity")))


@query("scl23_arrays", """
select vec_id, cast(embedding[1] as double) as first, cast(embedding[3] as double) as third, len(embedding) as size from embeddings""")
def _(d):
    head = F.slice("embedding", 1, 3)
    return d.embeddings.select(
        "vec_id", F.get(head, F.lit(0)).cast("double").alias("first"), F.get(head, F.lit(2)).cast("double").alias("third"),
        F.size("embedding").cast("long").alias("size"),
    )


# States by longest name first at the earliest place; the code must be a word of its own.
_PAD = "concat(' ', regexp_replace(lower(text), '[^a-z]', ' ', 'g'), ' ')"


@query("scl24_state_code", f"""
with named as (select q.question_id, q.text, s.state_code, length(s.state_name) as len, strpos({_PAD}, concat(' ', lower(s.state_name), ' ')) as pos
 from fx_questions q, lk_states s where contains({_PAD}, concat(' ', lower(s.state_name), ' '))),
first as (select * from (select *, row_number() over (partition by question_id order by pos, len desc) as rn from named) where rn = 1)
select q.question_id, case when f.pos is not null and not contains(concat(' ', regexp_replace(lower(q.text), '[^a-z]', ' ', 'g'), ' '), concat(' ', lower(f.state_code), ' '))
 then concat(substr(q.text, 1, f.pos - 1 + f.len), ' (', f.state_code, ')', substr(q.text, f.pos + f.len)) else q.text end as text
from fx_questions q left join first f on q.question_id = f.question_id""")
def _(d):
    return d.fx_questions.select("question_id", add_state_code(c("text")).alias("text"))


# -- region paths -------------------------------------------------------------

def _geo(name, column, extra="region_id, region_type"):
    @query(name, f"select {extra}, {column} from o_region")
    def _(d):
        decoded = star.decode_region(d.fx_regions, lookups.states(d.spark))
        return decoded.select("region_id", "region_type", column)


for _name, _column in [
    ("geo01_state_code", "state_code"), ("geo03_metro_name", "metro_name"), ("geo04_county_name", "county_name"),
    ("geo05_city_name", "city_name"), ("geo06_zip_key", "zip_key"), ("geo07_neighborhood_name", "neighborhood_name"),
]:
    _geo(_name, _column)


@query("geo02_state_name", "select r.region_id, s.state_name from o_region r left join lk_states s on trim(r.state_code) = s.state_code")
def _(d):
    return star.decode_region(d.fx_regions, lookups.states(d.spark)).select("region_id", "state_name")


@query("geo08_housing_unit", "select h.indicator_id, h.value, coalesce(u.unit, 'USD_CURRENT') as unit from fx_housing h left join lk_house_units u on h.indicator_id = u.indicator_id")
def _(d):
    return star.housing_values(d.fx_housing, lookups.housing_units(d.spark)).select("indicator_id", "value", "unit")


@query("geo09_housing_description", "select i.indicator_id, coalesce(x.description, '') as description from fx_housing_indicators i left join lk_house_desc x on i.indicator_id = x.indicator_id")
def _(d):
    return with_lookup(
        d.fx_housing_indicators, c("indicator_id"), lookups.housing_descriptions(d.spark), "indicator_id", "description",
        "description", "",
    ).select("indicator_id", "description")

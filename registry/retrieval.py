"""Embedding, search and retrieval over whole tables of chunks and questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace import lookups
from millrace.operators import embed as E, ivf
from millrace.operators.search import search
from millrace.plans import documents as D, prices as P, retrieve as R
from millrace.session import scratch_path, stable
from millrace.sinks.files import write_table
from registry.book import query
from registry.docs import CORPUS, corpus
from registry.lake import gold

c = F.col


@query("emb01_embed", """
with words as (select doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) as word from documents),
places as (select doc_id, cast(cast(concat('0x', substr(md5(word), 1, 8)) as ubigint) % 64 as int) as place, count(*) as n from words group by 1, 2)
select doc_id, place, round(cast(cast(n / sqrt(sum(n * n) over (partition by doc_id)) as float) as double), 6) as weight from places""")
def _(d):
    spread = d.spark.sparkContext.defaultParallelism
    vectors = E.embed(d.documents.select("doc_id", "text"), partitions=spread).select("doc_id", F.posexplode("embedding").alias("place", "w"))
    return vectors.filter(c("w") != 0).select("doc_id", "place", F.round(c("w").cast("double"), 6).alias("weight"))


@query("src07_chunk_scan", "select id, year_key, socio_indicator_key, asset_key, len(embedding) as dim from fx_chunks where year_key >= 2018")
def _(d):
    path = scratch_path(d.spark, "chunk_table")
    write_table(d.fx_chunks, path)
    chunks = d.spark.read.parquet(path).filter(c("year_key") >= 2018)
    return chunks.select("id", "year_key", "socio_indicator_key", "asset_key", F.size("embedding").cast("long").alias("dim"))


_FAMILY = "case question_id % 3 when 0 then 'socioeconomic' when 1 then 'asset' else 'realestate' end"
_KEY = "case question_id % 3 when 0 then socio_indicator_key when 1 then asset_key else realestate_indicator_key end"


def _requests(d, k=10):
    family = F.when(c("question_id") % 3 == 0, "socioeconomic").when(c("question_id") % 3 == 1, "asset").otherwise("realestate")
    return d.fx_queries.select(
        c("question_id").alias("request_id"), "vector", F.lit(k).alias("k"), family.alias("family"), "first_year", "last_year"
    )


def _ranked(where, k=10):
    return f"""
select question_id as request_id, id, similarity, cast(rn as int) as rank from (
 select *, row_number() over (partition by question_id order by similarity desc, id) as rn from o_sim where {where}) where rn <= {k}"""


@query("vec01_top_k", _ranked(f"{_KEY} is not null"))
def _(d):
    return search(_requests(d), d.fx_chunks)


@query("vec02_top_k_years", _ranked(f"{_KEY} is not null and year_key between first_year and last_year"))
def _(d):
    requests = _requests(d).withColumnsRenamed({"first_year": "start_year", "last_year": "end_year"})
    return search(requests, d.fx_chunks)


@query("vec03_top_k_entities", _ranked("asset_key in ('BTC/USD', case when question_id % 2 = 0 then 'AAPL' else 'NONE' end) and (question_id % 3 > 0 or year_key between first_year and last_year)"))
def _(d):
    codes = F.array(F.lit("BTC/USD"), F.when(c("request_id") % 2 == 0, "AAPL").otherwise("NONE"))
    limited = c("request_id") % 3 == 0
    return search(_requests(d).withColumns({
        "family": F.lit("asset"), "codes": codes,
        "start_year": F.when(limited, c("first_year")), "end_year": F.when(limited, c("last_year")),
    }), d.fx_chunks)


@query("vec04_top_k_indicators", _ranked("""socio_indicator_key in ('FP.CPI.TOTL') and (contains(lower(text), 'ing the') or contains(lower(text), 'der und')
 or (question_id % 2 = 0 and contains(lower(text), 'eau'))) and year_key between first_year and last_year"""))
def _(d):
    places = F.when(c("request_id") % 2 == 0, F.array(F.lit("ING THE"), F.lit("der und"), F.lit("Eau"))).otherwise(
        F.array(F.lit("ing the"), F.lit("DER und")))
    return search(_requests(d).withColumns({
        "family": F.lit("socioeconomic"), "codes": F.array(F.lit("FP.CPI.TOTL")), "countries": places,
        "start_year": c("first_year"), "end_year": c("last_year"),
    }), d.fx_chunks)


@query("vec05_nearest_asset", """
select question_id as name_id, asset_key, similarity from (select *, row_number() over (partition by question_id order by similarity desc, id) as rn
 from o_sim where asset_key is not null) where rn = 1 and similarity > 0.7""")
def _(d):
    return R.nearest_asset(d.fx_queries.select(c("question_id").alias("name_id"), "vector"), d.fx_chunks)


@query("vec06_list_index", """
with centers as (select id as list_id, cast(embedding as double[]) as center from fx_chunks where id < 24),
near as (select c.id, list_id, row_number() over (partition by c.id order by round(list_cosine_similarity(cast(c.embedding as double[]), center), 9) desc, list_id) as rn from fx_chunks c, centers),
probe as (select question_id, list_id, row_number() over (partition by question_id order by round(list_cosine_similarity(cast(q.vector as double[]), center), 9) desc, list_id) as rn from fx_queries q, centers),
met as (select s.question_id, s.id, s.similarity from o_sim s join near n on n.id = s.id and n.rn = 1 join probe p on p.question_id = s.question_id and p.list_id = n.list_id and p.rn <= 6)
select question_id as request_id, id, similarity, cast(rn as int) as rank from (
 select *, row_number() over (partition by question_id order by similarity desc, id) as rn from met) where rn <= 10""")
def _(d):
    """Top 10 from the 6 nearest of 24 lists around given centroids."""
    path = scratch_path(d.spark, "ivf")
    centers = d.fx_chunks.filter("id < 24").select(c("id").alias("list_id"), c("embedding").alias("centroid"))
    ivf.build_ivf(d.fx_chunks, path, centroids=centers)
    requests = d.fx_queries.select(c("question_id").alias("request_id"), "vector", F.lit(10).alias("k"))
    return ivf.ivf_search(d.spark, requests, path, probes=6)


@query("vec06_list_index_all", """
select question_id as request_id, id, similarity, cast(rn as int) as rank from (
 select *, row_number() over (partition by question_id order by similarity desc, id) as rn from o_sim) where rn <= 10""")
def _(d):
    """Probing every list must give what the exact search gives."""
    path = scratch_path(d.spark, "ivf")
    ivf.build_ivf(d.fx_chunks, path, lists=8, iterations=3)
    requests = d.fx_queries.select(c("question_id").alias("request_id"), "vector", F.lit(10).alias("k"))
    return ivf.ivf_search(d.spark, requests, path, probes=8)


def _embedded(table, key):
    """DuckDB: (key, place, w) of the texts' vectors, as emb01 has them."""
    return f"""select {key} as id, place, cast(cast(n / sqrt(sum(n * n) over (partition by {key})) as float) as double) as w from (
 select {key}, cast(cast(concat('0x', substr(md5(word), 1, 8)) as ubigint) % 64 as int) as place, count(*) as n
 from (select {key}, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) as word from {table}) group by 1, 2)"""


_CHUNKS = f"select doc_kind, md5(text) as digest, text from ({CORPUS})"


@query("snk05_store_chunks", f"""
with c as (select digest, any_value(doc_kind) as doc_kind, any_value(text) as text, count(*) as n from ({_CHUNKS}) group by digest),
v as ({_embedded('c', 'digest')}), s as (select id, sum((place + 1) * cast(round(w * 1000000) as bigint)) as vector_sum from v group by id)
select doc_kind, digest, cast(s.vector_sum as bigint) as vector_sum, 0 as embedded_again from c join s on s.id = c.digest""")
def _(d):
    """The corpus in two runs, the second with new documents only, and a third that finds nothing to embed."""
    path = scratch_path(d.spark, "chunks")
    prices = P.asset_prices(gold(d))
    E.store_chunks(corpus(d, prices.filter("year < 1998")).filter("doc_kind <> 'asset_trend'"), path)
    E.store_chunks(corpus(d, prices), path)
    again = E.store_chunks(corpus(d, prices), path)
    stored = d.spark.read.parquet(path).filter("created_at is not null")
    weights = F.zip_with(F.sequence(F.lit(1), F.size("embedding")), "embedding", lambda place, w: place * F.round(w.cast("double") * 1_000_000).cast("bigint"))
    total = F.aggregate(weights, F.lit(0).cast("bigint"), lambda x, y: x + y)
    return stored.select("doc_kind", F.md5("text").alias("digest"), total.alias("vector_sum"), F.lit(again).alias("embedded_again")).distinct()


_NEAR = f"""
with e as ({_embedded('documents', 'doc_id')}), el as (select id, sqrt(sum(w * w)) as l from e group by id),
q as ({_embedded('benchmark', 'item_id')}), ql as (select id, sqrt(sum(w * w)) as l from q group by id),
near as (select q.id as request_id, e.id, round(sum(q.w * e.w) / any_value(ql.l * el.l), 9) as similarity
 from q join ql on q.id = ql.id join e on e.place = q.place join el on e.id = el.id group by 1, 2),
top as (select *, row_number() over (partition by request_id order by similarity desc, id) as rn from near qualify rn <= 10)"""


@query("vec06_fitted_recall", _NEAR + """
select request_id, count(*) as wanted, round(max(similarity), 6) as best, true as enough from top where request_id % 2 = 1 group by 1""")
def _(d):
    """A fitted index over every document, probes chosen by the even questions, recall at 10 measured on the odd ones."""
    path = scratch_path(d.spark, "ivf")
    chunks = stable(E.embed(d.fx_chunks.drop("embedding")).drop("text"))
    train = chunks.orderBy(F.xxhash64("id"), "id").limit(20_000)
    ivf.build_ivf(chunks, path, train=train)
    asked = stable(E.embed(d.benchmark.select(c("item_id").alias("request_id"), "text"), out="vector").drop("text"))
    ivf.calibrate(d.spark, path, 10, requests=asked.filter("request_id % 2 = 0"))
    asked = asked.filter("request_id % 2 = 1").withColumn("k", F.lit(10))
    near = ivf.ivf_search(d.spark, asked, path).select("request_id", "id", F.lit(1).alias("found"))
    both = search(asked, chunks).join(near, ["request_id", "id"], "left").groupBy("request_id").agg(
        F.count(F.lit(1)).alias("wanted"), F.round(F.max("similarity"), 6).alias("best"), F.count("found").alias("found"))
    both = stable(both)
    enough = both.agg(F.sum("found") / F.sum("wanted") >= ivf.RECALL).first()[0]
    return both.select("request_id", "wanted", "best", F.lit(enough).alias("enough"))


@query("jn12_queries_times_chunks", """
select a.id as request_id, b.id, round(list_cosine_similarity(cast(a.embedding as double[]), cast(b.embedding as double[])), 9) as similarity,
 cast(row_number() over (partition by a.id order by round(list_cosine_similarity(cast(a.embedding as double[]), cast(b.embedding as double[])), 9) desc, b.id) as int) as rank
from fx_chunks a, fx_chunks b where a.id % 50 = 0 qualify rank <= 5""")
def _(d):
    """Every fiftieth chunk asks all chunks, in more blocks than one."""
    asked = d.fx_chunks.filter("id % 50 = 0").select(c("id").alias("request_id"), c("embedding").alias("vector"), F.lit(5).alias("k"))
    return search(asked, d.fx_chunks, request_limit=max(1, asked.count() // 3))


# -- balanced retrieval -------------------------------------------------------

def _questions(d):
    q = c("question_id")
    names = lambda *n: F.array(*[F.lit(x) for x in n]) if n else F.array().cast("array<string>")
    subs = d.embeddings.select("vec_id", c("embedding"))
    one = subs.select((c("vec_id") - 50).alias("question_id"), c("embedding").alias("s0"))
    two = subs.select((c("vec_id") - 100).alias("question_id"), c("embedding").alias("s1"))
    return d.fx_queries.join(one, "question_id").join(two, "question_id").select(
        "question_id", "vector",
        F.when(q % 7 == 0, F.array("s0")).otherwise(F.array("s0", "s1")).alias("sub_vectors"),
        F.when(q % 4 == 0, names("socioeconomic", "asset", "realestate")).when(q % 4 == 1, names("socioeconomic", "asset"))
        .when(q % 4 == 2, names("asset")).otherwise(names("socioeconomic", "realestate")).alias("data_types"),
        F.when(q % 3 > 0, c("first_year")).alias("start_year"), F.when(q % 3 > 0, c("last_year")).alias("end_year"),
        F.when(q % 2 == 0, names("FP.CPI.TOTL")).otherwise(names()).alias("indicator_codes"),
        F.when(q % 4 == 0, names("Eau", "ing the")).otherwise(names()).alias("countries"),
        F.when(q % 5 == 0, names("NOPE")).when(q % 5 == 1, names()).when(q % 5 == 2, names("BTC/USD"))
        .otherwise(names("AAPL", "NOPE")).alias("assets"),
        F.when(q % 2 == 1, names("LRAW", "ZZZ")).otherwise(names()).alias("housing_codes"),
    )


BALANCED = """
with q0 as (select q.question_id as qid, q.vector as m, a.embedding as s0, b.embedding as s1, case when q.question_id % 7 = 0 then 1 else 2 end as n_sub,
  case q.question_id % 4 when 0 then 3 when 1 then 2 when 2 then 1 else 2 end as n_types, q.question_id % 4 in (0, 1, 3) as socio, q.question_id % 4 in (0, 1, 2) as asset, q.question_id % 4 in (0, 3) as house,
  case when q.question_id % 3 > 0 then q.first_year end as y0, case when q.question_id % 3 > 0 then q.last_year end as y1,
  case q.question_id % 5 when 0 then ['NOPE'] when 1 then [] when 2 then ['BTC/USD'] else ['AAPL', 'NOPE'] end as assets
 from fx_queries q join embeddings a on a.vec_id = q.question_id + 50 join embeddings b on b.vec_id = q.question_id + 100),
qq as (select *, greatest(10, 30 // n_types) as quota from q0),
req as (
 select qid, quota, n_sub, y0, y1, 'socioeconomic' as category, 1 as stage, 0 as item, m as v, quota // 2 as k, 'FP.CPI.TOTL' as code, qid % 4 = 0 as places from qq where socio and qid % 2 = 0
 union all select qid, quota, n_sub, y0, y1, 'socioeconomic', 2, 0, m, quota // 2, null, false from qq where socio
 union all select qid, quota, n_sub, y0, y1, 'socioeconomic', 3, 0, s0, quota // 4, null, false from qq where socio
 union all select qid, quota, n_sub, y0, y1, 'asset', 1, i, m, quota // len(assets), assets[i + 1], false from (select *, unnest(range(len(assets))) as i from qq where asset)
 union all select qid, quota, n_sub, y0, y1, 'asset', 2, 0, s0, 30, null, false from qq where asset
 union all select qid, quota, n_sub, y0, y1, 'asset', 2, 1, s1, 30, null, false from qq where asset and n_sub = 2
 union all select qid, quota, n_sub, y0, y1, 'realestate', 1, 0, m, greatest(1, greatest(1, quota // 2) // 2), 'LRAW', false from qq where house and qid % 2 = 1
 union all select qid, quota, n_sub, y0, y1, 'realestate', 2, 0, m, case when qid % 2 = 1 then greatest(1, (quota - greatest(1, quota // 2)) // 2) else quota // 2 end, null, false from qq where house
 union all select qid, quota, n_sub, y0, y1, 'realestate', 3, 0, s0, case when qid % 2 = 1 then greatest(1, (quota - greatest(1, quota // 2)) // 2) else quota // 2 end, null, false from qq where house),
scored as (select r.*, ch.id, round(list_cosine_similarity(cast(r.v as double[]), cast(ch.embedding as double[])), 9) as similarity from req r join fx_chunks ch
 on case r.category when 'socioeconomic' then ch.socio_indicator_key when 'asset' then ch.asset_key else ch.realestate_indicator_key end is not null
 and (r.code is null or case r.category when 'socioeconomic' then ch.socio_indicator_key when 'asset' then ch.asset_key else ch.realestate_indicator_key end = r.code)
 and (not r.places or contains(lower(ch.text), 'eau') or contains(lower(ch.text), 'ing the')) and (r.y0 is null or ch.year_key between r.y0 and r.y1)),
ranked as (select *, row_number() over (partition by qid, category, stage, item order by similarity desc, id) as rn from scored),
named as (select distinct qid from ranked where category = 'asset' and stage = 1 and rn <= k),
kept as (select r.* from ranked r left join named n on r.qid = n.qid where case when category = 'asset' and stage = 2 then rn <= case when n.qid is not null then 5 else quota // n_sub end else rn <= k end),
once as (select * from (select *, row_number() over (partition by qid, category, id order by stage, item, rn) as o from kept) where o = 1),
final as (select *, row_number() over (partition by qid, category order by stage, item, rn) as position from once)
select qid as question_id, category, cast(position as int) as position, id, similarity from final where position <= quota"""


@query("vec07_balanced", BALANCED)
def _(d):
    return R.balanced(_questions(d), d.fx_chunks, total_k=30)


def _hits(d):
    """Ten chunks of each category per question, every other text a yearly summary."""
    kinds = F.explode(F.array(*[F.lit(k) for k in R.CATEGORIES]))
    asked = d.fx_queries.select("question_id", "vector", kinds.alias("family"))
    requests = asked.select(
        F.concat_ws("/", c("question_id").cast("string"), "family").alias("request_id"), "vector", F.lit(10).alias("k"), "family"
    )
    found = search(requests, d.fx_chunks)
    parts = F.split("request_id", "/")
    hits = found.select(
        F.get(parts, F.lit(0)).cast("long").alias("question_id"), F.get(parts, F.lit(1)).alias("category"),
        c("rank").alias("position"), "id", "similarity",
    )
    text = F.when(c("id") % 2 == 0, F.concat(F.lit("ANNUAL real estate Summary "), "text")).otherwise(c("text"))
    return R.with_chunks(hits, d.fx_chunks.withColumn("text", text))


def _asked(d):
    return d.fx_queries.select("question_id", F.when(c("question_id") % 2 == 0, "Prices per Year?").otherwise("Prices?").alias("text"))


_RERANKED = """with h as (select *, case when socio_indicator_key is not null then 1 when asset_key is not null then 2 else 3 end as cat,
  case when id % 2 = 0 then concat('ANNUAL real estate Summary ', text) else text end as shown,
  row_number() over (partition by question_id, socio_indicator_key is not null, asset_key is not null order by similarity desc, id) as position from o_sim),
r as (select *, row_number() over (partition by question_id order by round(similarity + case when question_id % 2 = 0 and cat = 3 and id % 2 = 0 then 0.05 else 0 end, 9) desc, cat, position) as rank from h where position <= 10)
"""


@query("vec08_rerank", _RERANKED + """select question_id, cast(rank as int) as rank, id, similarity, cast(position as int) as position from r where rank <= 20""")
def _(d):
    return R.rerank(_asked(d), _hits(d), 20).select("question_id", "rank", "id", "similarity", "position")


_LABEL = "case cat when 1 then 'socioeconomic' when 2 then concat('asset ', asset_key) else 'realestate' end"


@query("vec09_context", _RERANKED + f"""select question_id, count(*) as docs,
 string_agg(concat('#', rank, ' ', {_LABEL}, ', year ', year_key, ', similarity ', format('{{:.3f}}', similarity), chr(10), shown), concat(chr(10), chr(10)) order by rank) as context
 from r where rank <= 5 group by question_id""")
def _(d):
    return R.context(R.rerank(_asked(d), _hits(d), 5))


@query("vec13_contexts", """
select question_id, replace(replace(replace(text, 'Ohio', 'Ohio (OH)'), 'Texas', 'Texas (TX)'), 'California', 'California (CA)') as text,
 20 as docs, true as in_year, true as numbered from fx_asked""")
def _(d):
    """Text in, context out, over documents built from the star schema."""
    g = gold(d)
    year = F.regexp_extract("text", r"(\\d{4})\\?", 1)
    figures = P.housing_figures(g)
    documents = D.stack(
        D.doc_housing(D.recent_housing(figures, ["LRAW", "CRAW", "NRAW", "IRAW"], "1996-01-01", "1999-12-31")),
        D.doc_housing_state_year(D.metrics.state_year(figures, "1996-01-01", "1999-12-31")),
    )
    path = scratch_path(d.spark, "corpus")
    keyed = documents.withColumn("id", F.xxhash64("text", "region_key", "realestate_indicator_key", "year_key"))
    write_table(E.embed(keyed), path)
    answers = R.answer_contexts(d.fx_asked, d.spark.read.parquet(path), total_k=40, final_k=20)
    return answers.select(
        "question_id", "text", c("docs").cast("int").alias("docs"),
        (F.size(F.regexp_extract_all("context", F.concat(F.lit("#[0-9]+ realestate, year "), year), 0)) == 20).alias("in_year"),
        c("context").startswith("#1 realestate").alias("numbered"),
    )


@query("vec10_asset_keys", "select distinct asset_key from fx_chunks where asset_key is not null order by 1")
def _(d):
    return R.asset_keys(d.fx_chunks)


_ENTITY = "case question_id % 4 when 0 then 'Bitcoin ' when 1 then 'APPLE' else concat('name ', question_id) end"


@query("vec11_entities", f"""
with near as (select question_id, asset_key from (select *, row_number() over (partition by question_id order by similarity desc, id) as rn
 from o_sim where asset_key is not null) where rn = 1 and similarity > 0.7)
select q.question_id as name_id, {_ENTITY.replace('question_id', 'q.question_id')} as entity, coalesce(a.asset_key, n.asset_key, {_ENTITY.replace('question_id', 'q.question_id')}) as asset_key
from fx_queries q left join near n on q.question_id = n.question_id left join lk_aliases a on a.alias = lower(trim({_ENTITY.replace('question_id', 'q.question_id')}))""")
def _(d):
    q = c("question_id")
    names = d.fx_queries.select(
        q.alias("name_id"),
        F.when(q % 4 == 0, "Bitcoin ").when(q % 4 == 1, "APPLE").otherwise(F.concat(F.lit("name "), q.cast("string"))).alias("entity"),
        "vector",
    )
    return R.normalise_entities(names, lookups.entity_aliases(d.spark), d.fx_chunks)


_PAD = "concat(' ', trim(regexp_replace(lower(text), '[^a-z0-9&/-]+', ' ', 'g')), ' ')"


def _found(name, table, term, value, test="true"):
    return f"""{name} as (select question_id, string_agg(v, ' ' order by pos, term) as joined from (
 select question_id, strpos(p, concat(' ', {term}, ' ')) as pos, {term} as term, {value} as v from asked, {table} where contains(p, concat(' ', {term}, ' ')) and {test}) group by 1)"""


def _unique(x):
    """Space-separated words, each at its first place only."""
    return (
        f"coalesce(array_to_string(list_filter(string_split({x}, ' '), lambda w, i: list_position(string_split({x}, ' '), w) = i), ' '), '')"
    )


@query("vec12_question_analysis", f"""
with asked as (select question_id, text, {_PAD} as p from fx_questions),
{_found('so', 'lk_socio', 'keyword', 'codes')}, {_found('ho', 'lk_housing', 'keyword', 'codes')},
{_found('ac', 'lk_aliases', 'alias', 'asset_key', "asset_key <> 'USA'")}, {_found('pl', 'lk_aliases', 'alias', 'asset_key', "asset_key = 'USA'")},
er as (select question_id, max_by(era_start, (length(phrase), phrase)) as e0, max_by(era_end, (length(phrase), phrase)) as e1 from asked, lk_eras where contains(p, concat(' ', phrase, ' ')) group by 1),
ys as (select question_id, list_transform(list_filter(string_split(replace(replace(p, '-', ' '), '/', ' '), ' '), lambda w: regexp_full_match(w, '(19|20)[0-9][0-9]')), lambda w: cast(w as int)) as y from asked)
select a.question_id, case when so.joined is null and ac.joined is null and ho.joined is null then 'socioeconomic asset realestate' else
 concat_ws(' ', case when so.joined is not null then 'socioeconomic' end, case when ac.joined is not null then 'asset' end, case when ho.joined is not null then 'realestate' end) end as data_types,
 cast(coalesce(list_min(y), cast(e0 as int)) as int) as start_year, cast(coalesce(list_max(y), cast(e1 as int)) as int) as end_year,
 {_unique('so.joined')} as indicator_codes, {_unique('ho.joined')} as housing_codes, {_unique('ac.joined')} as assets, {_unique('pl.joined')} as countries,
 array_to_string(list_filter(list_transform(regexp_split_to_array(text, '(?i) and | versus | vs |[;?]'), lambda s: trim(s)), lambda s: s <> ''), '|') as sub_queries
from asked a left join so on a.question_id = so.question_id left join ho on a.question_id = ho.question_id left join ac on a.question_id = ac.question_id
left join pl on a.question_id = pl.question_id left join er on a.question_id = er.question_id left join ys on a.question_id = ys.question_id""")
def _(d):
    tagged = R.analyse_questions(d.fx_questions)
    words = ("data_types", "indicator_codes", "housing_codes", "assets", "countries")
    return tagged.select(
        "question_id", "start_year", "end_year", F.array_join("sub_queries", "|").alias("sub_queries"),
        *[F.array_join(w, " ").alias(w) for w in words],
    )


_NATION = "replace(concat(upper(substr(n_name, 1, 1)), lower(substr(n_name, 2))), '_', '')"


@query("vec12_names", f"""
with c as (select n_nationkey as id, concat('stock price of ', {_NATION}, ' Holdings in 2020') as text, concat('N', n_nationkey) as asset_key from nation where n_nationkey % 2 = 0),
n as (select n_nationkey as nid, concat({_NATION}, ' Holdings') as name, concat({_NATION}, ' Holdings stock price') as text from nation),
e as ({_embedded('c', 'id')}), el as (select id, sqrt(sum(w * w)) as l from e group by id),
q as ({_embedded('n', 'nid')}), ql as (select id, sqrt(sum(w * w)) as l from q group by id),
sim as (select q.id as nid, e.id, round(sum(q.w * e.w) / any_value(ql.l * el.l), 9) as similarity from q join ql on q.id = ql.id join e on e.place = q.place join el on el.id = e.id group by 1, 2),
best as (select * from sim qualify row_number() over (partition by nid order by similarity desc, id) = 1),
key as (select n.nid, case when similarity > 0.7 then asset_key else name end as asset from n left join best on best.nid = n.nid left join c on c.id = best.id)
select s_suppkey as question_id, case when s_suppkey % 3 = 0 then concat('BTC/USD|', asset) when s_suppkey % 3 = 1 then asset else '' end as assets,
 case when s_suppkey % 3 = 2 then 'socioeconomic' when s_suppkey % 3 = 1 then 'asset' else 'socioeconomic asset' end as data_types
from supplier join key on nid = s_nationkey""")
def _(d):
    """Names that are neither alias nor key: the nearest asset above the floor, else as written."""
    name = F.expr(_NATION)
    told = d.nation.filter("n_nationkey % 2 = 0").select(
        c("n_nationkey").alias("id"), F.concat(F.lit("stock price of "), name, F.lit(" Holdings in 2020")).alias("text"), F.lit(2020).alias("year_key"),
        F.lit(None).cast("int").alias("region_key"), F.lit(None).cast("string").alias("socio_indicator_key"),
        F.lit(None).cast("string").alias("realestate_indicator_key"), F.concat(F.lit("N"), c("n_nationkey").cast("string")).alias("asset_key"))
    chunks = stable(E.embed(told))
    text = F.when(c("s_suppkey") % 3 == 0, F.concat(F.lit("Did Bitcoin and the shares of "), name, F.lit(" Holdings follow GDP?"))).when(
        c("s_suppkey") % 3 == 1, F.concat(F.lit("How did the stock of "), name, F.lit(" Holdings do in July 2020?"))).otherwise(
        F.concat(F.lit("How did inflation move in "), name, F.lit(" Holdings?")))
    asked = d.supplier.join(d.nation, c("s_nationkey") == c("n_nationkey")).select(c("s_suppkey").alias("question_id"), text.alias("text"))
    found = R.resolve_names(R.tag_stored_assets(R.analyse_questions(asked), chunks), chunks)
    return found.select("question_id", F.array_join("assets", "|").alias("assets"), F.array_join("data_types", " ").alias("data_types"))

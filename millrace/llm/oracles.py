"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from millrace.llm import gnat, licenses, mixing, quality_rules, spelling

WORD = r"[^\x20\x09-\x0D]+"


def _rules_sql() -> str:
    cells = []
    for rule, (over, of, cutoffs) in quality_rules.RULES.items():
        cells += [f"('{rule}', '{over}', '{of}', {c})" for c in cutoffs]
    value = lambda c: "case " + " ".join(f"when {c} = '{n}' then m.{n}" for n in quality_rules.COUNTS) + " end"
    rate = quality_rules.ALPHA / len(quality_rules.RULES)
    return rf"""
with d as (select row_number() over () as rid, doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '{WORD}') as words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from d),
g as (select rid, i, array_to_string(words[i:i + 7], chr(10)) as run from (select rid, words, unnest(range(1, len(words) - 6)) as i from w where len(words) >= 8)),
twice as (select rid, run from g group by rid, run having count(*) > 1),
repeated as (select rid, count(distinct i + k) as n from g join twice using (rid, run), (select unnest(range(0, 8)) as k) group by rid),
m as (select w.rid, doc_id, stratum, len(words)::bigint as n_words, coalesce(length(array_to_string(words, '')), 0)::bigint as word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
        coalesce(r.n, 0)::bigint as n_repeat_words, len(lines)::bigint as n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g'))::bigint as n_upper
      from w left join repeated r using (rid)),
b as (select *, n_words < {quality_rules.MIN_WORDS} or 100 * n_repeat_words > {quality_rules.MAX_REPEAT} * n_words as base_failed from m),
rules(rule, over_, of_, cutoff) as (values {', '.join(cells)}),
good as (select doc_id, max(quality) as good from labels where doc_id is not null and quality is not null group by doc_id),
hit as (select m.stratum, g.good, r.rule, r.cutoff, 1000 * ({value('r.over_')}) > r.cutoff * ({value('r.of_')}) as rejected
        from b m join good g using (doc_id), rules r where not m.base_failed),
cell as (select stratum, rule, cutoff, count(*) filter (good = 1) as n1, count(*) filter (good = 0) as n0,
           count(*) filter (good = 1 and rejected) as k, count(*) filter (good = 0 and rejected) as bad from hit group by all),
tail as (select *, case when k >= n1 * {rate} then 1.0 else list_sum(list_transform(range(0, k + 1), lambda i:
           exp(lgamma(n1 + 1) - lgamma(i + 1) - lgamma(n1 - i + 1) + i * ln({rate}) + (n1 - i) * ln(1 - {rate})))) end as p from cell),
tested as (select *, max(p) over (partition by stratum, rule order by cutoff desc) as worst,
             bad / greatest(n0, 1) - {quality_rules.PENALTY} * k / greatest(n1, 1) as gain from tail),
chosen as (select stratum, rule, cutoff from tested where worst <= {quality_rules.DELTA} / ({len(quality_rules.RULES)} * (select count(distinct stratum) from cell)) and gain > 0
           qualify row_number() over (partition by stratum, rule order by gain desc, cutoff desc) = 1),
out as (select distinct m.rid from b m join chosen c using (stratum) join rules r using (rule, cutoff) where 1000 * ({value('r.over_')}) > r.cutoff * ({value('r.of_')}))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, base_failed,
  not base_failed and out.rid is null as kept from b left join out using (rid)
"""


def _mix_sql() -> str:
    digest = lambda *p: "md5(concat_ws(':', " + ", ".join(f"coalesce(({x})::varchar, '')" for x in p) + "))"
    return rf"""
with recursive d as (select row_number() over () as rid, doc_id, source, coalesce(source, '') as src, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::bigint as n from documents),
s as (select src, sum(n)::bigint as tokens, count(*) as texts from d group by src having sum(n) > 0),
total as (select sum(tokens)::double as t, count(*) as c, list(tokens / (select sum(tokens)::double from s) order by src) as ps from s),
steps as (
  select 0 as i, -1.0::double as low, 1.0::double as high, 0.0::double as mid from total
  union all
  select i + 1, case when good then low else mid end, case when good then mid else high end,
    case when i = 0 then 0.5 else ((case when good then low else mid end) + (case when good then mid else high end)) / 2 end
  from (select i, low, high, mid,
      ln(list_sum(list_transform(ps, lambda p: pow(p, mid)))) - mid * list_sum(list_transform(ps, lambda p: pow(p, mid) * ln(p))) / list_sum(list_transform(ps, lambda p: pow(p, mid)))
        <= {mixing.ENTROPY_SHARE} * ln(c)
      and list_max(list_transform(ps, lambda p: pow(p, mid - 1))) / list_sum(list_transform(ps, lambda p: pow(p, mid))) / {mixing.MAX_REPEAT} <= 1.0 + 1e-12 as good
    from steps, total) where i <= {mixing.HALVINGS}),
a as (select case when (select c from total) < 2 then 1.0 when (select high from steps where i = 1) = 0.0 then 0.0
        else (select high from steps where i = {mixing.HALVINGS + 1}) end as a),
q as (select src, tokens, texts, floor(pow(tokens / t, a.a) / list_sum(list_transform(ps, lambda p: pow(p, a.a))) * t + 1e-6)::bigint as quota from s, total, a),
plan as (select src, ceil(texts / {mixing.BLOCK})::bigint as blocks, quota // tokens as full_, quota % tokens as rest from q),
dealt as (select d.*, plan.*exclude (src), ('0x' || substr({digest('0', "'block'", 'doc_id')}, 1, 8))::bigint % blocks as block from d join plan using (src)),
sums as (select src, block, full_, sum(n) as n from dealt group by all),
before as (select src, block, coalesce(sum(n) over (partition by src order by {digest('0', 'full_', 'src', 'block')}, block rows between unbounded preceding and 1 preceding), 0) as before_ from sums),
ranked as (select dealt.*, before_ + sum(n) over (partition by src, block order by {digest('0', 'full_', 'doc_id')}, doc_id, n rows between unbounded preceding and current row) as upto
           from dealt join before using (src, block))
select doc_id, source, n as n_tokens, unnest(range(0, full_ + case when upto <= rest then 1 else 0 end))::integer as pass, block from ranked
"""


def _license_sql() -> str:
    letters = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    lower = lambda x: f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    phrases = ", ".join(f"({quoted(p)}, {quoted(label)})" for p, label in licenses.PHRASES.items())
    templates = ", ".join(f"({i}, {quoted(label)}, {quoted(text)})" for i, (label, text) in enumerate(licenses.TEMPLATES))
    return rf"""
with d as (select row_number() over () as rid, doc_id, {lower("coalesce(text, '')")} as text from documents),
w as (select rid, doc_id, text, regexp_extract_all(text, '{letters}') as words from d),
phrases(phrase, label) as (values {phrases}),
p as (select string_split(phrase, ' ') as ws, label from phrases),
places as (select rid, label, unnest(list_filter(range(1, len(words) + 1), lambda i: words[i:i + len(ws) - 1] = ws)) - 1 as at_ from w, p where list_contains(words, ws[1])),
base as (select rid, count(*) as n_base, min(at_) as first_word, max(at_) as last_word, list(distinct label) as ls from places group by rid),
templates(id, label, sentence) as (values {templates}),
t as (select id, label, list_distinct(all_) as ws, floor(len(all_) / {licenses.THRESHOLD} + 1e-9)::bigint as n
      from (select *, regexp_extract_all({lower('sentence')}, '{letters}') as all_ from templates)),
blocks as (select rid, list_distinct(regexp_extract_all(line, '{letters}')) as ws from (select rid, unnest(string_split(text, chr(10))) as line from w)),
found as (select rid, label, len(list_intersect(b.ws, t.ws)) / len(t.ws)::double as share from blocks b, t
          where len(list_intersect(b.ws, t.ws)) >= ceil({licenses.THRESHOLD} * len(t.ws) - 1e-9)),
near_ as (select rid, words, t.label, t.ws, t.n from w, t where len(list_intersect(list_distinct(words), ws)) >= ceil({licenses.THRESHOLD} * len(ws) - 1e-9)),
runs as (select rid, label, len(list_intersect(list_distinct(words[i:i + n - 1]), ws)) / len(ws)::double as share, ws
         from (select *, unnest(range(1, len(words) + 1)) as i from near_)),
both_ as (select rid, label, share from found union all
          select rid, label, share from runs where share * len(ws) + 1e-9 >= ceil({licenses.THRESHOLD} * len(ws) - 1e-9)),
more as (select rid, max(share) as share, list(distinct label) as ls from both_ group by rid)
select doc_id, len(words)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
  coalesce(array_to_string(list_sort(base.ls), ','), '') as base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.ls, []), coalesce(more.ls, [])))), ','), '') as labels,
  case when n_base > 0 then 1.0 else coalesce(share, 0.0) end::double as score
from w left join base using (rid) left join more using (rid)
"""


def _join_sql() -> str:
    return rf"""
with recursive d as (select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') as w from documents),
g as (select distinct rid, run from (
  select rid, array_to_string(w[i:i + 4], chr(10)) as run from (select rid, w, unnest(range(1, len(w) - 3)) as i from d where len(w) >= 5)
  union all select rid, array_to_string(w, chr(10)) from d where len(w) between 1 and 4)),
size_ as (select rid, count(*) as n from g group by rid),
pair as (select a.rid as a, b.rid as b, count(*) as c from g a join g b on a.run = b.run and a.rid < b.rid group by all),
link as (select a, b from pair join size_ x on x.rid = a join size_ y on y.rid = b where c >= 0.8 * (x.n + y.n - c) - 1e-9),
both_ as (select a, b from link union all select b, a from link),
reach as (select rid as a, rid as b from d union select reach.a, both_.b from reach join both_ on reach.b = both_.a)
select d.doc_id, min(e.doc_id) as class_id, (select count(*) from both_ where both_.a = d.rid)::bigint as n_links
from d join reach on reach.a = d.rid join d e on e.rid = reach.b group by d.rid, d.doc_id
"""


_WARC_SQL = """
with p as (select page_id, encode(coalesce(html, '')) as body from pages),
q as (select page_id, octet_length(body)::bigint as payload_bytes, sha256(body) as payload_digest from p),
f as (select payload_digest, min(page_id) as first_ from q where payload_bytes >= 100 group by 1)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and first_ is not null and page_id is distinct from first_ then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id is distinct from first_ then first_ end as refers_to
from q left join f using (payload_digest)
"""

def _codes_sql() -> str:
    nearest = lambda book: f"""
  select rid, part, v, arg_min(e, (d, e)) as e, min(d) as d from (
    select rid, p.part, v, e, list_sum(list_transform(range(1, len(v) + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::bigint as d
    from p join {book} b on b.part = p.part) group by rid, part, v"""  # noqa: E731
    steps = []
    for k in range(gnat.ROUNDS):
        steps.append(f"a{k} as materialized ({nearest(f'b{k}')})")
        steps.append(f"""b{k + 1} as materialized (select part, e, coalesce(m, c) as c from b{k} left join (
  select part, e, list((s - ((s % n) + n) % n) // n order by i) as m from (
    select part, e, i, sum(v[i])::bigint as s, count(*) as n from a{k}, (select unnest(range(1, 1 + (select max(len(v)) from p))) as i) group by all) group by all) using (part, e))""")
    return f"""
with k as (select row_number() over (order by vec_id nulls last, embedding) as rid, vec_id, label, list_transform(embedding, lambda x: floor({gnat.SCALE} * x::double)::bigint) as v
  from embeddings where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as materialized (select rid, part, v[part * (len(v) // {gnat.PARTS}) + 1:(part + 1) * (len(v) // {gnat.PARTS})] as v from k, (select unnest(range({gnat.PARTS})) as part)),
b0 as (select part, rid - 1 as e, v as c from p where rid <= {gnat.ENTRIES}),
{", ".join(steps)},
last as materialized ({nearest(f'b{gnat.ROUNDS}')}),
coded as (select rid, string_agg(lpad(format('{{:x}}', e), 2, '0'), '' order by part) as code, sum(d)::bigint as error from last group by rid),
whole as (select sha256(string_agg(array_to_string(c, ','), ',' order by part, e)) as h from b{gnat.ROUNDS})
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, h as codebooks_sha256 from k join coded using (rid), whole
"""


_COPIES_SQL = rf"""
with recursive d as (select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as w from documents),
s as (select rid, doc_id, list_sort(list_distinct(case when len(w) < 2 then w else list_transform(range(1, len(w)), lambda i: w[i] || chr(10) || w[i + 1]) end)) as runs from d),
c as (select runs, min(rid) as cid, len(runs) as n from s where len(runs) > 0 group by runs),
g as materialized (select cid, n, unnest(runs) as run from c),
f as (select run, count(*) as df from g group by run),
p as materialized (select cid, n, run from g join f using (run) qualify row_number() over (partition by cid order by df, run) <= n - ceil(0.8 * n - 1e-9) + 1),
cand as materialized (select distinct a.cid as a, b.cid as b from p a join p b on a.run = b.run and a.cid < b.cid and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
link as materialized (select a, b from cand join c x on x.cid = a join c y on y.cid = b where 100 * len(list_intersect(x.runs, y.runs)) >= 80 * (x.n + y.n - len(list_intersect(x.runs, y.runs)))),
both_ as (select a, b from link union all select b, a from link),
reach as (select cid as a, cid as b from c union select reach.a, both_.b from reach join both_ on reach.b = both_.a),
least_ as (select runs, min(doc_id) as low from s group by runs),
root as (select a, min(low) as component from reach join c on c.cid = b join least_ using (runs) group by a)
select s.doc_id, len(s.runs)::bigint as n_shingles, case when c.cid is null then s.doc_id else component end as component_id,
  case when c.cid is null then s.doc_id else component end is not distinct from s.doc_id as kept
from s left join c using (runs) left join root on root.a = c.cid
"""

_SPELLING_SQL = rf"""
with recursive crc as materialized (select list(list_reduce(range(8), lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, i) order by i) as t from range(256) r(i)),
runs as (select coalesce(doc_id::varchar, '') as k, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) as w from documents where text is not null),
per as (select k, w, count(*) as n, hex(encode(k || ':' || w)) as h from runs group by k, w),
summed as (select w, n, xor(4294967295, list_reduce(range(len(h) // 2), lambda x, i: xor(t[(xor(x & 255, ('0x' || substr(h, 2 * i + 1, 2))::bigint)) + 1], x >> 8), 4294967295::bigint)) as h from per, crc),
made as (select case when h % {spelling.DAMAGE} = 0 then substr(w, 1, (h % length(w))::integer) || substr(w, (h % length(w))::integer + 2) else w end as word, n from summed),
v as materialized (select word, sum(n)::bigint as n from made where length(word) >= {spelling.LENGTH} group by word having sum(n) >= {spelling.COUNT}),
cut as materialized (select word, n, i, substr(word, 1, i) || substr(word, i + 2) as rest from v, lateral (select unnest(range(length(word))) as i)),
pair as (
  select a.word, b.word as other, b.n as m from cut a join cut b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select a.word, b.word, b.n from cut a join v b on a.rest = b.word
  union select b.word, a.word, a.n from cut a join v b on a.rest = b.word),
best as (select word, count(*) as n_near, first(other order by m desc, other) as best, max(m) as best_n from pair group by word),
f as materialized (select v.word, v.n, coalesce(n_near, 0)::bigint as n_near, case when best_n >= {spelling.RATIO} * v.n then best end as form, case when best_n >= {spelling.RATIO} * v.n then best_n end::bigint as form_n
  from v left join best using (word)),
walk as (select word, word as at_ from f union all select walk.word, f.form from walk join f on f.word = walk.at_ where f.form is not null)
select f.*, walk.at_ as root from f join walk using (word) join f e on e.word = walk.at_ where e.form is null
"""

ORACLES = {
    "op1_quality_rules": _rules_sql(),
    "op4_mixing": _mix_sql(),
    "op5_licenses": _license_sql(),
    "op7_ngram_join": _join_sql(),
    "op8_warc": _WARC_SQL,
    "op11_vector_codes": _codes_sql(),
    "op12_near_copies": _COPIES_SQL,
    "op13_spelling": _SPELLING_SQL,
}

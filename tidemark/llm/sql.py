"""DuckDB SQL for the queries whose results SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_WORDS = r"list_filter(regexp_split_to_array(coalesce({text}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_REACH = """
reach as (
  select a as x, a as y from links union select r.x, l.b from reach r join links l on r.y = l.a),
least_reached as (select x, min(y) as component_id from reach group by x)
"""

SUBSTRING = f"""
with words as (select doc_id, {_WORDS.format(text="text")} as ws from documents),
wins as (
  select doc_id, i, array_to_string(ws[i + 1 : i + 20], ' ') as k
  from (select doc_id, ws, unnest(range(greatest(len(ws) - 19, 0))) as i from words)),
later as (
  select doc_id, i from (
    select doc_id, i, row_number() over (partition by k order by doc_id, i) as n from wins) where n > 1),
gone as (select distinct doc_id, p from (select doc_id, unnest(range(i, i + 20)) as p from later)),
each as (
  select w.doc_id, w.p, w.word, g.p is not null as is_gone
  from (select doc_id, unnest(range(len(ws))) as p, unnest(ws) as word from words) w
  left join gone g on g.doc_id = w.doc_id and g.p = w.p),
kept as (
  select doc_id, count(*) as n_words, count(*) filter (is_gone) as n_removed,
         coalesce(string_agg(word, ' ' order by p) filter (not is_gone), '') as text
  from each group by doc_id)
select d.doc_id, cast(coalesce(k.n_words, 0) as bigint) as n_words, cast(coalesce(k.n_removed, 0) as bigint) as n_removed,
       sha256(coalesce(k.text, '')) as kept_sha256
from documents d left join kept k on k.doc_id = d.doc_id
"""

NEAR = f"""
with recursive words as (
  select doc_id, {_WORDS.format(text=f"translate(text, '{_UPPER}', '{_LOWER}')")} as ws from documents),
shingles as (
  select distinct doc_id, array_to_string(ws[i + 1 : i + 5], ' ') as s
  from (select doc_id, ws, unnest(range(case when len(ws) = 0 then 0 else greatest(len(ws) - 4, 1) end)) as i from words)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id),
links as (
  select s.a, s.b from shared s join sizes x on x.doc_id = s.a join sizes y on y.doc_id = s.b
  where 100 * s.n >= 85 * (x.n + y.n - s.n)),
{_REACH}
select d.doc_id, cast(coalesce(z.n, 0) as bigint) as n_shingles,
       coalesce(m.component_id, d.doc_id) as component_id,
       d.doc_id = coalesce(m.component_id, d.doc_id) as kept
from documents d left join sizes z on z.doc_id = d.doc_id left join least_reached m on m.x = d.doc_id
"""

SUFFIXES = """
with bytes as (select doc_id, lower(hex(encode(coalesce(text, '')))) as h from documents),
wins as (
  select doc_id, i, md5(substr(h, 2 * i + 1, 800)) as k
  from (select doc_id, h, unnest(range(greatest(length(h) // 2 - 399, 0))) as i from bytes)),
again as (select k from wins group by k having count(*) > 1),
hits as (
  select w.doc_id, w.i, lag(w.i) over (partition by w.doc_id order by w.i) as before
  from wins w join again using (k)),
runs as (
  select doc_id, i, sum(case when before is null or i > before + 400 then 1 else 0 end)
    over (partition by doc_id order by i rows unbounded preceding) as run
  from hits),
spans as (select doc_id, run, min(i) as s, max(i) + 400 as e from runs group by doc_id, run),
sums as (select doc_id, count(*) as n_spans, sum(e - s) as n_removed from spans group by doc_id),
gaps as (
  select doc_id, coalesce(lag(e) over (partition by doc_id order by s), 0) as s, s as e from spans
  union all
  select b.doc_id, max(p.e) as s, length(any_value(b.h)) // 2 as e
  from bytes b join spans p on p.doc_id = b.doc_id group by b.doc_id),
kept as (
  select g.doc_id, string_agg(substr(b.h, 2 * g.s + 1, 2 * (g.e - g.s)), '' order by g.s) as h
  from gaps g join bytes b on b.doc_id = g.doc_id group by g.doc_id)
select b.doc_id, cast(length(b.h) // 2 as bigint) as n_bytes, cast(coalesce(s.n_removed, 0) as bigint) as n_removed,
       cast(coalesce(s.n_spans, 0) as bigint) as n_spans, sha256(unhex(coalesce(k.h, b.h))) as kept_sha256
from bytes b left join sums s on s.doc_id = b.doc_id left join kept k on k.doc_id = b.doc_id
"""

EMBEDDINGS = f"""
with recursive unit as (
  select vec_id, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) as v
  from (select vec_id, cast(embedding as double[]) as e from embeddings)
  where len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
links as (
  select p.vec_id as a, q.vec_id as b from unit p join unit q
  on p.vec_id <> q.vec_id and len(p.v) = len(q.v) and list_inner_product(p.v, q.v) >= 0.95),
degrees as (select a, count(*) as n from links group by a),
{_REACH}
select e.vec_id, cast(coalesce(g.n, 0) as bigint) as n_links, coalesce(m.component_id, e.vec_id) as component_id,
       e.vec_id = coalesce(m.component_id, e.vec_id) as kept
from embeddings e left join degrees g on g.a = e.vec_id left join least_reached m on m.x = e.vec_id
"""


def urls(order: int, min_count: int, prior: float, alphabet: int, bins: int, span: float, rules) -> str:
    """The character models, level by level, the threshold and the verdicts."""
    longest = sorted(rules, key=lambda r: -len(r[0] + r[1]))

    def choose(value) -> str:
        cases = " ".join(
            f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{value(h, p, v)}'" for h, p, v in longest
        )
        return f"case {cases} end"

    def grams(source: str, columns: str) -> str:
        return f"""select {columns}, substr(s, i - n + 1, n) as gram, n from (
          select {columns}, s, i, unnest(range(1, least({order}, i) + 1)) as n from (
            select {columns}, s, unnest(range(2, length(s) + 1)) as i from (
              select {columns}, chr(2) || text || chr(3) as s from {source})))"""

    step = 2 * span / bins
    levels, deltas = [], ["select gram, ratio as delta from level1"]
    for n in range(2, order + 1):
        levels.append(f"""
seen{n} as (select substr(gram, 1, {n - 1}) as ctx, sum(a) as ta, sum(b) as tb from counts where n = {n} group by 1),
level{n} as (
  select *, ln(pa / pb) as ratio from (
    select c.gram, l.ratio as lower_ratio, (c.a + {prior} * l.pa) / (s.ta + {prior}) as pa,
           (c.b + {prior} * l.pb) / (s.tb + {prior}) as pb
    from counts c join seen{n} s on s.ctx = substr(c.gram, 1, {n - 1})
    join level{n - 1} l on l.gram = substr(c.gram, 2, {n - 1}) where c.n = {n}))""")
        deltas.append(f"select gram, ratio - lower_ratio as delta from level{n}")
    return f"""
with rest as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as r from pages),
parts as (
  select page_id, translate(regexp_extract(r, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') as host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as path from rest),
ruled as (
  select *, host || path as text, {choose(lambda h, p, v: h + p)} as rule, {choose(lambda h, p, v: v)} as ruling from parts),
texts as (select text, min(ruling) = 'allow' as accepted from ruled group by text),
known as (select *, cast('0x' || substr(md5(text), 1, 6) as bigint) % 5 = 0 as held
          from texts where accepted is not null and text <> ''),
training as (select text, accepted from known where not held),
counts as (
  select gram, n, count(*) filter (accepted) as a, count(*) filter (not accepted) as b
  from ({grams("training", "accepted")}) group by gram, n having count(*) >= {min_count}),
total as (select sum(a) as a, sum(b) as b from counts where n = 1),
level1 as (
  select *, ln(pa / pb) as ratio from (
    select c.gram, (c.a + {prior / alphabet}) / (t.a + {prior}) as pa, (c.b + {prior / alphabet}) / (t.b + {prior}) as pb
    from counts c, total t where c.n = 1)),{",".join(levels)},
model as ({" union all ".join(deltas)}),
sums as (
  select g.text, sum(m.delta) as total from ({grams("texts", "text")}) g join model m on m.gram = g.gram group by g.text),
scores as (
  select text, round(case when text = '' then 0.0 else total / greatest(length(text), 1) end, 9) as z from sums),
binned as (
  select cast(greatest(0, least({bins}, floor((s.z + {span}) / {step}))) as int) as bin,
         count(*) filter (accepted) as a, count(*) filter (not accepted) as b
  from known k join scores s on s.text = k.text where held group by 1),
edges as (
  select e.k, coalesce(sum(b.a) filter (b.bin < e.k), 0) as lost, coalesce(sum(b.b) filter (b.bin >= e.k), 0) as kept
  from (select unnest(range({bins + 1})) as k) e left join binned b on true group by e.k),
threshold as (
  select k * {step} - {span} as t from edges, (select sum(a) as up, sum(b) as down from binned)
  order by lost / up + kept / down, abs(k - {bins // 2}), k limit 1)
select r.page_id, r.host, r.path, r.rule,
       coalesce(r.ruling, case when coalesce(s.z, 0) - t.t >= 0 then 'allow' else 'block' end) as verdict
from ruled r left join scores s on s.text = r.text cross join threshold t
"""

NEGATIVES = """
with v as (
  select row_number() over () as place, vec_id, embedding,
         case when vec_id % 7 = 0 then (cast(label as bigint) + 1) % 10 else cast(label as bigint) end as label,
         list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
a as (select * from v where vec_id % 100 = 0),
scored as (
  select a.place as a, a.vec_id as anchor_id, v.vec_id, v.place, a.label = v.label as same,
         cast(list_dot_product(a.q, v.q) as bigint) as score
  from a join v on a.place <> v.place and len(a.q) = len(v.q)),
positives as (
  select a, anchor_id, vec_id as positive_id, score as positive_score,
         row_number() over (partition by a order by score desc, vec_id nulls first, place) as nth
  from scored where same qualify nth <= 5)
select p.anchor_id, p.positive_id, s.vec_id as negative_id, p.positive_score, s.score as negative_score,
       cast(row_number() over (partition by p.a, p.nth order by s.score desc, s.vec_id nulls first, s.place) as integer) as rank
from positives p join scored s on s.a = p.a and not s.same
 and 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score
qualify rank <= 10
"""

AUDIT = f"""
with texts as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, {_WORDS.format(text="text")} as ws from documents),
failures as (
  select doc_id, part,
         (len(ws) < 200)::int as a, (100 * len(list_distinct(ws)) < 50 * len(ws))::int as b,
         (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t))::int as c,
         regexp_matches(t, '[#$%&*|]')::int as d,
         coalesce(doc_id > min(doc_id) over (partition by t), false)::int as e
  from texts),
said as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
counts as (
  select part, a + 2 * b + 4 * c + 8 * d + 16 * e as mask, count(*) as n,
         count(*) filter (s.good) as good, count(*) filter (s.toxic) as toxic
  from failures f left join said s on s.doc_id = f.doc_id group by all),
letters as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) as x(letter, bit)),
orders as (
  select p.letter || q.letter || r.letter || s.letter || t.letter as filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] as bits
  from letters p join letters q on q.bit <> p.bit join letters r on r.bit not in (p.bit, q.bit)
  join letters s on s.bit not in (p.bit, q.bit, r.bit) join letters t on t.bit not in (p.bit, q.bit, r.bit, s.bit)),
steps as (
  select filter_order, unnest(range(1, 6)) as step, bits from orders),
placed as (
  select filter_order, step, bits[step] as bit, coalesce(list_sum(bits[1 : step - 1]), 0) as before from steps),
found as (
  select part, filter_order, step, bit,
         coalesce(sum(n) filter (mask & (before | bit) = 0), 0) as kept,
         coalesce(sum(n) filter (mask & before = 0 and mask & bit > 0), 0) as removed,
         coalesce(sum(n) filter (mask & before > 0 and mask & bit > 0), 0) as redundant,
         coalesce(sum(n) filter (mask = bit), 0) as unique_fails,
         coalesce(sum(good) filter (mask & before = 0 and mask & bit > 0), 0) as good_lost,
         coalesce(sum(toxic) filter (mask & before = 0 and mask & bit > 0), 0) as toxic_lost
  from (select part, mask, n, good, toxic, filter_order, step, cast(bit as bigint) as bit, cast(before as bigint) as before
        from counts, placed)
  group by part, filter_order, step, bit)
select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
       cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
       cast(toxic_lost as bigint) as toxic_lost, cast(sum(removed) over (partition by part, bit) as bigint) as shapley
from found
"""

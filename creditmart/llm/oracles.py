"""DuckDB SQL for the queries of this package that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op10_line_dedup"] = """
with lines as (
  select doc_id, text, source, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) as pos
  from documents where text is not null),
spread as (
  select line, min((doc_id, pos)) as first_place from lines where trim(line) <> ''
  group by line
  having count(distinct source) >= 10
    or len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) > 50 and count(distinct doc_id) >= 2),
marked as (
  select l.doc_id, l.pos, l.line, s.line is not null and (l.doc_id, l.pos) <> s.first_place as gone
  from lines l left join spread s on l.line = s.line)
select doc_id, count(*)::int as n_lines, sum(gone::int)::int as n_removed,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as text_sha256
from marked group by doc_id
union all
select doc_id, 0, 0, null from documents where text is null
"""

ORACLES["op8_embedding_dedup"] = """
with recursive good as (
  select row_number() over () as r, vec_id, label, [x::double for x in embedding] as v
  from embeddings
  where embedding is not null and label is not null
    and list_bool_and([x is not null and isfinite(x) for x in embedding])
    and list_bool_or([x <> 0 for x in embedding])),
links as (
  select a.vec_id as a, b.vec_id as b from good a join good b on a.label = b.label and a.r <> b.r and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.93),
reached(vec_id, other) as (
  select distinct vec_id, vec_id from embeddings
  union
  select r.vec_id, l.b from reached r join links l on r.other = l.a),
least as (select vec_id, min(other) as component_id from reached group by vec_id),
counts as (select a, count(*) as n from links group by a)
select e.vec_id, coalesce(c.n, 0)::bigint as n_links, l.component_id, e.vec_id = l.component_id as kept
from embeddings e join least l using (vec_id) left join counts c on c.a = e.vec_id
"""

ORACLES["op3_url_filter"] = r"""
with parsed as (
  select page_id, url,
    regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.+$', '') as host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) as path,
    date '2023-01-01' + (('0x' || substr(md5(concat_ws('#', url, page_id::varchar)), 1, 6))::int % 730) as fetched_on
  from pages),
patterns as (
  select host as pattern from parsed where host <> ''
  union select array_to_string(string_split(host, '.')[-2:], '.') from parsed where host <> ''
  union select host || '/' || string_split(path, '/')[2] from parsed where host <> '' and path <> ''),
coded as (
  select pattern, ('0x' || substr(md5(pattern || ':' || turn::varchar), 1, 6))::int as code
  from patterns, generate_series(0, 5) as t(turn)),
entries as (
  select ['adult', 'malware', 'spam'][code // 4 % 3 + 1] as list, pattern,
    max((code // 16 % 2 = 0)::int) as is_on, date '2023-01-01' + (code // 32 % 730) as day
  from coded where code % 4 = 0 group by all),
captures as (select distinct url, host, path, fetched_on from parsed),
active as (
  select c.url, c.fetched_on, e.list, e.pattern, arg_max(e.is_on, e.day) as is_on
  from captures c join entries e
    on e.day <= c.fetched_on and c.host <> '' and (
      e.pattern = c.host or ends_with(c.host, '.' || e.pattern)
      or starts_with(c.host || c.path || '/', e.pattern || '/') and contains(e.pattern, '/'))
  group by all),
verdict as (
  select url, fetched_on, array_to_string(list_sort(list_distinct(list(list))), ',') as lists,
    max((length(pattern), pattern)) as best
  from active where is_on = 1 group by url, fetched_on)
select p.page_id, p.fetched_on::date as fetched_on, v.url is not null as blocked, coalesce(v.lists, '') as lists, v.best[2] as rule
from parsed p left join verdict v on p.url = v.url and p.fetched_on = v.fetched_on
"""

ORACLES["op11_hard_negatives"] = """
with good as (
  select distinct vec_id::bigint as vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label,
    [floor(256 * x::double)::bigint for x in embedding] as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and list_bool_and([x is not null and isfinite(x) for x in embedding])),
scores as (
  select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
  from good a join good b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
near as (
  select anchor_id, other as positive_id, score as positive_score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, other) <= 5)
select n.anchor_id, positive_id,
  row_number() over (partition by n.anchor_id, positive_id order by score desc, other)::int as rank, other as negative_id,
  positive_score, score as negative_score
from near n join scores s
  on s.anchor_id = n.anchor_id and not same and 80 * positive_score <= 100 * score and score <= positive_score
qualify rank <= 5
"""

ORACLES["op13_filter_audit"] = r"""
with texts as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents),
words as (select *, [x for x in string_split_regex(t, '[\x20\x09-\x0D]+') if x <> ''] as w from texts),
least as (select t, min(doc_id) as first from texts group by t),
marks as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
failed as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
    (len(w) < 50)::int + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::int
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::int
    + 8 * regexp_matches(t, '[#$%&*|]')::int + 16 * coalesce(doc_id > first, false)::int as mask
  from words join least using (t) left join marks using (doc_id)),
counts as (select part, mask, count(*) as n, count_if(good) as good, count_if(toxic) as toxic from failed group by all),
letters as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) as l(letter, bit)),
orders as (
  select [a.letter, b.letter, c.letter, d.letter, e.letter] as o, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5),
steps as (
  select array_to_string(o, '') as filter_order, s.step::int as step, bits[s.step] as bit,
    coalesce(list_sum(bits[1:s.step - 1]), 0)::int as before
  from orders, generate_series(1, 5) as s(step)),
figures as (
  select part, filter_order, step, bit,
    sum(case when mask & (bit | before) = 0 then n else 0 end)::bigint as kept,
    sum(case when mask & bit <> 0 and mask & before = 0 then n else 0 end)::bigint as removed,
    sum(case when mask & bit <> 0 and mask & before <> 0 then n else 0 end)::bigint as redundant,
    sum(case when mask = bit then n else 0 end)::bigint as unique_fails,
    sum(case when mask & bit <> 0 and mask & before = 0 then good else 0 end)::bigint as good_lost,
    sum(case when mask & bit <> 0 and mask & before = 0 then toxic else 0 end)::bigint as toxic_lost
  from counts, steps group by all)
select * exclude (bit), sum(removed) over (partition by part, bit)::bigint as shapley from figures
"""

"""DuckDB SQL for the corpus queries that SQL can express."""

_UP = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP4 = r"""
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, strlen(html) as n, sha1(html) as h, unhex(sha1(html))::bit::varchar as bits from p),
e as (select page_id, n, h, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + 16 * substr(bits, 5 * i + 1, 1)::int + 8 * substr(bits, 5 * i + 2, 1)::int + 4 * substr(bits, 5 * i + 3, 1)::int
  + 2 * substr(bits, 5 * i + 4, 1)::int + substr(bits, 5 * i + 5, 1)::int, 1)), '') as digest,
  min(page_id) over (partition by h) as first from d)
select page_id, n::bigint as payload_bytes, digest as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id = first then null else first end as refers_to
from e
"""

OP8 = rf"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UP}), '[^\x20\x09-\x0D]+') as ws from documents),
s as (select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
  else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as g from w),
n as (select w.doc_id, count(g) as n from w left join s using (doc_id) group by 1),
c as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)),
e as (select a, b from l union all select b, a from l),
r(doc_id, node) as (select doc_id, doc_id from n union select r.doc_id, e.b from r join e on e.a = r.node)
select n.doc_id, n.n as n_shingles, m.component_id, coalesce(o.n_links, 0) as n_links from n join (select doc_id, min(node) as component_id from r group by 1) m using (doc_id)
  left join (select a as doc_id, count(*) as n_links from e group by 1) o using (doc_id)
"""

OP10 = rf"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UP}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), {_UP}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark where item_id is not null),
v as (select distinct item_id, unnest(case when len(ws) = 0 then [] when len(ws) < 13 then [array_to_string(ws, ' ')]
  else list_transform(range(1, len(ws) - 11), lambda i: array_to_string(ws[i:i + 12], ' ')) end) as g,
  least(len(ws), 13) as size from b),
sizes as (select distinct size from v),
g as (select doc_id, size, unnest(range(1, len(ws) - size + 2)) as i, ws from d, sizes where len(ws) >= size),
f as (select doc_id, item_id, g.size, i from g join v on v.size = g.size and v.g = array_to_string(ws[i:i + g.size - 1], ' ')),
h as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + size)) as p from f) group by 1),
m as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items from f group by 1)
select d.doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from d left join h using (doc_id) left join m using (doc_id)
"""

OP7 = rf"""
with w as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UP}), '[^\x20\x09-\x0D]+') as ws from documents),
g as (select r, i, ws[i] as a, case when i > 1 then ws[i - 1] end as b, case when i > 2 then ws[i - 2] end as c from (select r, ws, unnest(range(1, len(ws) + 1)) as i from w)),
one as (select a, count(*) as n from g group by 1),
two as (select b, a, count(*) as n from g where b is not null group by 1, 2),
three as (select c, b, a, count(*) as n from g where c is not null group by 1, 2, 3),
s as (select r, case when k.n >= 2 then k.n / q.n else case when g.c is null then 1 else 0.4 end * (case when t.n >= 2 then t.n / p.n else case when g.b is null then 1 else 0.4 end * (o.n / (select count(*) from g)) end) end as s
  from g join one o on o.a = g.a left join one p on p.a = g.b left join two t on t.b = g.b and t.a = g.a left join two q on q.b = g.c and q.a = g.b
  left join three k on k.c = g.c and k.b = g.b and k.a = g.a),
x as (select r, sum(log10(s)) as total from s group by 1)
select doc_id, len(ws)::bigint as n_words, round(coalesce(total, 0), 6) as log10_score, round(total / len(ws), 6) as log10_mean from w left join x using (r)
"""

URL_LISTED = r"""
with u as (select page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages),
r(rule, domain, prefix, verdict) as (values ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'), ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
j as (select u.*, rule, verdict, row_number() over (partition by page_id order by length(rule) desc nulls last) as k
  from u left join r on (host = domain or ends_with(host, '.' || domain)) and starts_with(path, prefix))
select page_id, host, path, rule, verdict as listed_verdict from j where k = 1
"""

QUALITY_BASE = r"""
with w as (select row_number() over () as r, doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
g as (select r, i, array_to_string(ws[i:i + 2], ' ') as g from (select r, ws, unnest(range(1, len(ws) - 1)) as i from w)),
again as (select r, g from g group by 1, 2 having count(*) > 1),
hit as (select r, count(distinct p) as n from (select g.r, unnest(range(i, i + 3)) as p from g join again a on a.r = g.r and a.g = g.g) group by 1),
lines as (select r, count(*) - count(distinct line) as n from (select r, unnest(string_split(t, chr(10))) as line from w) where regexp_matches(line, '[^\x20\x09-\x0D]') group by 1)
select doc_id, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
  coalesce(lines.n, 0)::bigint as n_dup_lines, coalesce(hit.n, 0)::bigint as n_repeat_words, len(ws) < 50 or 100 * coalesce(hit.n, 0) > 50 * len(ws) as base_failed
from w left join hit using (r) left join lines using (r)
"""

SQL = {"op4_warc": OP4, "op7_backoff": OP7, "op8_jaccard": OP8, "op10_decontamination": OP10, "url_listed_rules": URL_LISTED, "quality_base": QUALITY_BASE}

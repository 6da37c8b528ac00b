"""DuckDB SQL for the queries that SQL can express on small tables. It works on whole texts by words as strings."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED, _LETTERS = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP2 = f"""with recursive d as (select doc_id, regexp_extract_all({_LOWER}, '{_SPACED}') as w from documents),
s as (select distinct doc_id, array_to_string(w[k + 1:k + m], ' ') as g from (select doc_id, w, m, unnest(range(0, len(w) - m + 1)) as k from (select *, least(5, len(w)) as m from d where len(w) > 0))),
n as (select doc_id, count(*) as n from s group by 1),
c as (select a.doc_id as x, b.doc_id as y, count(*) as k from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
l as (select x, y from c join n p on p.doc_id = x join n q on q.doc_id = y where 100 * k >= 75 * (p.n + q.n - k)),
r(x, y) as (select doc_id, doc_id from documents union select r.x, l.y from r join l on r.y = l.x)
select doc_id, coalesce(n, 0)::bigint as n_shingles, (select min(y) from r where r.x = documents.doc_id) as component_id from documents left join n using (doc_id)"""

OP5 = f"""with d as (select doc_id, regexp_extract_all({_LOWER}, '{_LETTERS}') as w from documents),
b as (select item_id, regexp_extract_all({_LOWER}, '{_LETTERS}') as w from benchmark),
i as (select distinct item_id, m, array_to_string(w[k + 1:k + m], ' ') as s from (select *, unnest(range(0, len(w) - m + 1)) as k from (select *, least(10, len(w)) as m from b where len(w) > 0))),
x as (select doc_id, m, k, array_to_string(w[k + 1:k + m], ' ') as s from (select d.*, m, unnest(range(0, len(w) - m + 1)) as k from d, (select distinct m from i))),
h as (select doc_id, x.m, k, item_id from x join i on x.m = i.m and x.s = i.s),
p as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(k, k + m)) as p from h) group by 1),
t as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items from (select distinct doc_id, item_id::varchar as item_id from h) group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join p using (doc_id) left join t using (doc_id)"""

OP10 = f"""with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') as w from documents),
x as (select doc_id, k, array_to_string(w[k + 1:k + 20], ' ') as s from (select *, unnest(range(0, len(w) - 19)) as k from d)),
r as (select doc_id, k from (select *, row_number() over (partition by s order by doc_id, k) as o from x) where o > 1),
g as (select distinct doc_id, p from (select doc_id, unnest(range(k, k + 20)) as p from r)),
u as (select doc_id, unnest(w) as word, unnest(range(0, len(w))) as p from d),
z as (select u.doc_id, string_agg(word, ' ' order by u.p) as kept from u anti join g on u.doc_id = g.doc_id and u.p = g.p group by 1),
c as (select doc_id, count(*) as n from g group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join c using (doc_id) left join z using (doc_id)"""

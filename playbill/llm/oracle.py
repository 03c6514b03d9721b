"""DuckDB SQL of the queries that SQL can express, with the same columns."""

from __future__ import annotations

OP10 = r"""
with given as (
  select doc_id, coalesce(text, '') as text,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as content
  from documents),
ranked as (
  select doc_id, sha256(content) as text_sha256,
         first_value(doc_id) over staying as keep_id,
         count(*) over (partition by content) as group_size,
         row_number() over staying = 1 as kept
  from given
  window staying as (
    partition by content order by length(text) desc, doc_id nulls last))
select doc_id, keep_id, group_size, kept, text_sha256 from ranked
"""

# bytes as two hexadecimal digits each, so that substr counts in bytes
OP5 = """
with doc as (
  select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
windows as (
  select r, i, md5(substr(h, 2 * i + 1, 800)) as key
  from (select r, h, unnest(range(0, len(h) // 2 - 399)) as i from doc where len(h) >= 800)),
again as (
  select r, i from (select r, i, count(*) over (partition by key) as n from windows) where n > 1),
runs as (
  select r, min(i) as first, max(i) + 400 as past
  from (select r, i, sum(new) over (partition by r order by i) as run
        from (select r, i, (i - lag(i, 1, -1000) over (partition by r order by i) > 400)::int as new
              from again))
  group by r, run),
cut as (
  select r, sum(past - first) as n_removed, count(*) as n_spans, list(first order by first) as a,
         list(past order by first) as b
  from runs group by r),
kept as (
  select r, string_agg(part, '' order by k) as h
  from (select r, k, substr(h, 2 * (case when k = 1 then 0 else b[k - 1] end) + 1,
                            2 * ((case when k > len(a) then len(h) // 2 else a[k] end)
                                 - (case when k = 1 then 0 else b[k - 1] end))) as part
        from (select r, h, a, b, unnest(range(1, len(a) + 2)) as k from doc join cut using (r)))
  group by r)
select doc_id, cast(len(doc.h) // 2 as bigint) as n_bytes,
       cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(kept.h, doc.h))) as kept_sha256
from doc left join cut using (r) left join kept using (r)
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
with recursive doc as (
  select row_number() over () as r, doc_id, regexp_extract_all(
    {_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') as w
  from documents),
shingles as (
  select distinct r, array_to_string(w[i : i + least(4, len(w)) - 1], ' ') as s
  from (select r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as i
        from doc where len(w) > 0)),
sizes as (select r, count(*) as n from shingles group by r),
classes as (
  select r, n, min(r) over (partition by n, content) as c
  from (select r, count(*) as n, string_agg(s, '|' order by s) as content
        from shingles group by r)),
common as (
  select a.r as x, b.r as y, count(*) as n
  from shingles a join shingles b on a.s = b.s and a.r < b.r
  where a.r in (select c from classes) and b.r in (select c from classes)
  group by all),
links as (
  select x, y from common join sizes p on p.r = x join sizes q on q.r = y
  where 100 * common.n >= 85 * (p.n + q.n - common.n)),
reach as (
  select distinct c as x, c as y from classes
  union
  select reach.x, l.y from reach
  join (select x, y from links union all select y, x from links) l on l.x = reach.y),
named as (
  select classes.r, min(doc.doc_id) as component_id
  from classes join reach on reach.x = classes.c
  join classes other on other.c = reach.y join doc on doc.r = other.r
  group by classes.r)
select doc_id, coalesce(n, 0) as n_shingles, coalesce(component_id, doc_id) as component_id
from doc left join sizes using (r) left join named using (r)
"""

OP6 = rf"""
with doc as (
  select row_number() over () as r, doc_id, regexp_extract_all(
    {_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
item as (
  select cast(item_id as varchar) as item_id, regexp_extract_all(
    {_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
windows as (
  select distinct item_id, size, array_to_string(w[i : i + size - 1], ' ') as spelled
  from (select item_id, w, least(13, len(w)) as size,
               unnest(range(1, len(w) - least(13, len(w)) + 2)) as i
        from item where len(w) > 0)),
places as (
  select r, i, size, array_to_string(w[i : i + size - 1], ' ') as spelled
  from (select r, w, size, unnest(range(1, len(w) - size + 2)) as i
        from doc, (select distinct size from windows) where len(w) >= size)),
met as (select r, i, size, item_id from places join windows using (size, spelled)),
hits as (
  select r, count(distinct p) as n_hit
  from (select r, unnest(range(i, i + size)) as p from met) group by r),
items as (
  select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as names
  from (select distinct r, item_id from met) group by r)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(names, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc left join hits using (r) left join items using (r)
"""

OP11 = """
with vectors as (
  select row_number() over () as r, vec_id,
         list_transform(embedding, lambda c: floor(1024 * cast(c as double))) as x
  from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
usual as (
  select len(x) as length from vectors group by all order by count(*) desc, length desc limit 1),
taking_part as (select vectors.* from vectors, usual where len(x) = length),
scored as (
  select q.r, q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.x, c.x) as bigint) as score,
         row_number() over (
           partition by q.r order by list_dot_product(q.x, c.x) desc, c.vec_id) as rank
  from taking_part q join taking_part c on q.r <> c.r where q.vec_id % 100 = 0)
select query_id, cast(rank as int) as rank, vec_id, score from scored where rank <= 10
"""

# the checksum of the digits of a number, eight bits a step; words are numbered from 0
OP13 = r"""
with entry as (
  select list_transform(range(256), lambda i: list_reduce(
    list_prepend(i, range(8)),
    lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)) as t),
doc as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as given,
         xor(list_reduce(
           list_prepend(4294967295, list_transform(
             string_split(cast(doc_id as varchar), ''), lambda d: cast(ascii(d) as bigint))),
           lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) as h
  from documents, entry),
places as (
  select *, len(given) as n, h // 10 as g,
         case when h % 10 = 0 and len(given) > 0 then (h // 10) % len(given) end as a
  from doc),
w as (
  select r, i, given[1 + case when i >= a then a + (i - a) % (1 + (n - a) // (3 + g % 8)) else i end]
           as word
  from (select *, unnest(range(n)) as i from places)),
grams as (
  select r, i, hash(word, lead(word, 1) over p, lead(word, 2) over p, lead(word, 3) over p,
                    lead(word, 4) over p, lead(word, 5) over p) as key
  from w window p as (partition by r order by i)),
met as (
  select distinct x.r, x.i - y.i as q
  from grams x join grams y on x.r = y.r and x.key = y.key and x.i > y.i),
-- whole diagonals of the lags that six words in a row agree on
matches as (
  select met.r, q, x.i, x.i - row_number() over (partition by met.r, q order by x.i) as stretch
  from met join w x on x.r = met.r join w y on y.r = met.r and y.i = x.i - q
  where x.word = y.word),
stretches as (
  select r, q, min(i) - q as start, count(*) + q as length
  from matches group by r, q, stretch),
runs as (
  select r, start, length, min(q) as period from stretches
  where length >= greatest(12, 2 * q) group by r, start, length),
found as (
  select r, count(*) as n_runs, arg_min({'start': start, 'length': length, 'period': period},
                                        {'l': -length, 's': start, 'p': period}) as longest,
         string_agg(concat(start, ',', length, ',', period, chr(10)), '' order by start, period) as said
  from runs group by r),
dropped as (select distinct r, unnest(range(start + period, start + length)) as i from runs),
kept as (
  select r, string_agg(word, ' ' order by i) as text from w anti join dropped using (r, i) group by r)
select doc_id, coalesce(n_runs, 0) as n_runs, longest.start as start, longest.length as length,
       longest.period as period, 1000 * longest.length // longest.period as exponent_milli,
       sha256(coalesce(said, '')) as runs_sha256, sha256(coalesce(kept.text, '')) as collapsed_sha256
from doc left join found using (r) left join kept using (r)
"""

ORACLE: dict[str, str] = {
    "op1_ngram_jaccard": OP1,
    "op5_suffix_repeats": OP5,
    "op6_decontamination": OP6,
    "op10_exact_dedup": OP10,
    "op11_exact_top_k": OP11,
    "op13_periodic_runs": OP13,
}

"""Oracle SQL of the corpus queries that SQL can express on small tables."""

from __future__ import annotations

_GAP = "[\\x20\\x09-\\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SUFFIX_DEDUP = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
w as (select doc_id, s, substr(h, 2 * s + 1, 100) as q from (select doc_id, h, unnest(range(0, cast(len(h) // 2 - 49 as bigint))) as s from d where len(h) >= 100) x),
f as (select q, min(doc_id) as m from w group by q),
g as (select doc_id, s, case when s > lag(s) over (partition by doc_id order by s) + 50 then 1 else 0 end as cut from w join f using (q) where doc_id > m),
i as (select doc_id, s, sum(cut) over (partition by doc_id order by s) as isle from g),
p as (select doc_id, isle, min(s) as a, max(s) + 50 as b from i group by doc_id, isle),
n as (select *, lag(b, 1, 0) over (partition by doc_id order by a) as e from p),
k as (select n.doc_id, count(*) as n_spans, sum(b - a) as n_removed, max(b) as tail, string_agg(substr(h, cast(2 * e + 1 as bigint), cast(2 * (a - e) as bigint)), '' order by a) as kept from n join d using (doc_id) group by n.doc_id)
select d.doc_id, cast(len(h) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, cast(coalesce(n_spans, 0) as bigint) as n_spans,
  sha256(unhex(case when kept is null then h else kept || substr(h, cast(2 * tail + 1 as bigint)) end)) as kept_sha256
from d left join k on d.doc_id = k.doc_id"""

SUBSTRING_DEDUP = f"""
with d as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_GAP}'), lambda x: x <> '') as w from documents),
win as (select doc_id, s, array_to_string(list_slice(w, s, s + 19), ' ') as q from (select doc_id, w, unnest(range(1, cast(len(w) - 18 as bigint))) as s from d where len(w) >= 20) x),
f as (select q, min(struct_pack(d := doc_id, s := s)) as m from win group by q),
gone as (select distinct doc_id, s + o as p from win join f using (q), (select unnest(range(0, 20)) as o) t where win.doc_id <> m.d or s <> m.s),
words as (select doc_id, unnest(w) as word, unnest(range(1, cast(len(w) + 1 as bigint))) as p from d),
kept as (select words.doc_id, string_agg(word, ' ' order by words.p) as text from words left join gone on words.doc_id = gone.doc_id and words.p = gone.p where gone.p is null group by words.doc_id),
n as (select doc_id, count(*) as n from gone group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n.n, 0) as bigint) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from d left join n on d.doc_id = n.doc_id left join kept on d.doc_id = kept.doc_id"""

NGRAM_JOIN = f"""
with recursive d as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_GAP}'), lambda x: x <> '') as w from documents),
s as (select distinct doc_id, g from (select doc_id, array_to_string(list_slice(w, i, i + 2), ' ') as g from (select doc_id, w, unnest(range(1, cast(len(w) - 1 as bigint))) as i from d where len(w) >= 3) x
  union all select doc_id, array_to_string(w, ' ') from d where len(w) between 1 and 2) y),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id),
l as (select a, b from c join n x on a = x.doc_id join n y on b = y.doc_id where 100 * c >= 90 * (x.n + y.n - c)),
r(a, b) as (select doc_id, doc_id from d union select r.a, l.b from r join l on r.b = l.a)
select d.doc_id, cast(coalesce(any_value(n.n), 0) as bigint) as n_shingles, min(r.b) as component_id from d join r on d.doc_id = r.a left join n on d.doc_id = n.doc_id group by d.doc_id"""

# Dynamic programming over the histogram of lengths: round k holds for each length j the least padding of k buckets
# that end at j, and where the last of them begins; the bounds are walked back from the longest.
PACKING = f"""
with recursive d as (select doc_id, cast(len(list_filter(regexp_split_to_array(coalesce(text, ''), '{_GAP}'), lambda x: x <> '')) + 1 as bigint) as n from documents),
h as (select n, count(*) as c from d group by n),
s as (select cast(row_number() over (order by n) as bigint) as j, n, cast(sum(c) over (order by n) as bigint) as r, cast(sum(n * c) over (order by n) as bigint) as t from h
  union all select 0, 0, 0, 0),
rounds as (select least(16, max(j)) as k, max(j) as j from s),
dp(k, j, cost, came) as (
  select cast(1 as bigint), j, n * r - t, cast(0 as bigint) from s
  union all
  select k, j, cost, came from (
    select p.k + 1 as k, s.j, p.cost + s.n * (s.r - z.r) - (s.t - z.t) as cost, z.j as came,
      row_number() over (partition by s.j order by p.cost + s.n * (s.r - z.r) - (s.t - z.t), z.j desc) as nth
    from dp p join s z on z.j = p.j join s on s.j > z.j or s.j = 0 and z.j = 0 where p.k < (select k from rounds)) x where nth = 1),
walk(k, j) as (select k, j from rounds union all select walk.k - 1, dp.came from walk join dp on dp.k = walk.k and dp.j = walk.j where walk.k > 1 and dp.came > 0),
b as (select n as upper, cast(row_number() over (order by n) - 1 as int) as bucket from walk join s on walk.j = s.j),
p as (select doc_id, n, bucket, upper from d asof join b on d.n <= b.upper),
q as (select *, row_number() over (partition by bucket order by md5(concat_ws(':', coalesce(cast(doc_id as string), 'null'), n)), doc_id, n) - 1 as rank from p)
select doc_id, n as n_tokens, bucket, upper as bucket_tokens, cast(rank // greatest(65536 // upper, 1) as bigint) as batch, upper - n as padding from q"""

QUALITY_BASE = f"""
with d as (select doc_id, coalesce(text, '') as text, list_filter(regexp_split_to_array(coalesce(text, ''), '{_GAP}'), lambda x: x <> '') as w from documents),
win as (select doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') as q from (select doc_id, w, unnest(range(1, cast(len(w) - 6 as bigint))) as i from d where len(w) >= 8) x),
twice as (select doc_id, i from win qualify count(*) over (partition by doc_id, q) > 1),
covered as (select doc_id, count(distinct i + o) as n from twice, (select unnest(range(0, 8)) as o) t group by doc_id),
rows_of as (select doc_id, unnest(string_split(text, chr(10))) as line from d),
dup as (select doc_id, count(*) - count(distinct line) as n from rows_of where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
c as (select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
  cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols from d)
select c.*, cast(coalesce(dup.n, 0) as bigint) as n_dup_lines, cast(coalesce(covered.n, 0) as bigint) as n_repeat_words,
  n_words < 20 or 100 * coalesce(covered.n, 0) > 30 * n_words as base_failed
from c left join dup on c.doc_id = dup.doc_id left join covered on c.doc_id = covered.doc_id"""

ORACLES = {
    "op10_packing": PACKING,
    "quality_base_counts": QUALITY_BASE,
    "op2_suffix_array_dedup": SUFFIX_DEDUP,
    "op4_ngram_jaccard_join": NGRAM_JOIN,
    "op7_substring_dedup": SUBSTRING_DEDUP,
}

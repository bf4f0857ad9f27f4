"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_ORACLES: dict[str, str] = {}

_ORACLES["op1_url_filter"] = r"""
with parts as (
  select page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') as path
  from pages),
rules(verdict, rhost, rpath) as (values ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
  ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fitting as (
  select page_id, max_by(rhost || rpath, length(rhost || rpath)) as rule,
    max_by(r.verdict, length(rhost || rpath)) as verdict
  from parts p join rules r
    on (p.host = rhost or p.host like '%.' || rhost) and starts_with(p.path, rpath)
  group by page_id)
select p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') as verdict
from parts p left join fitting f using (page_id)
"""

_ORACLES["op2_warc_revisits"] = """
with payloads as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
    sha1(coalesce(html, '')) as payload_digest
  from pages),
originals as (
  select payload_digest, max(page_id) as original from payloads
  where payload_bytes >= 1000 group by payload_digest)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
  case when original <> page_id then 'revisit' else 'response' end as record_type,
  case when original <> page_id then original end as refers_to
from payloads left join originals using (payload_digest)
"""

_ORACLES["op10_decontamination"] = r"""
with texts as (select 0 as kind, doc_id as id, text from documents
  union all select 1, item_id, text from benchmark),
split as (select kind, id, string_split_regex(lower(text), '[\x20\x09-\x0D]+') as w from texts),
unnested as (select kind, id, unnest(w) as word, generate_subscripts(w, 1) as place from split),
placed as (
  select kind, id, word, count(*) over (partition by kind, id) as n,
    row_number() over (partition by kind, id order by place) as i
  from unnested where word <> ''),
runs as (
  select kind, id, n, i, case when n >= 5 then concat_ws(' ', word, lead(word, 1) over p,
      lead(word, 2) over p, lead(word, 3) over p, lead(word, 4) over p)
    else 'short ' || string_agg(word, ' ') over (p rows between unbounded preceding and unbounded following)
    end as shingle
  from placed window p as (partition by kind, id order by i)),
short as (select distinct n as m from placed where kind = 1 and n < 5),
inside as (
  select id, 'short ' || array_to_string(list_slice(w, i::bigint, i::bigint + m - 1), ' ') as shingle
  from (select id, list(word order by i) as w, count(*) as n from placed where kind = 0 group by id) d
    join short on m <= n, unnest(range(1, n - m + 2)) as r(i)),
shingled as (
  select distinct kind, id, shingle from runs where i <= greatest(n - 4, 1) and (kind = 1 or n >= 5)
  union select 0, id, shingle from inside),
items as (select id, shingle, count(*) over (partition by id) as n from shingled where kind = 1)
select d.id as doc_id, i.id as item_id, cast(any_value(n) as int) as n_shingles,
  cast(count(*) as int) as n_found
from items i join shingled d on d.kind = 0 and d.shingle = i.shingle
group by d.id, i.id having 100 * count(*) >= 80 * any_value(n)
"""

_ORACLES["op7_substring_dedup"] = r"""
with split as (
  select doc_id, string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') as w from documents),
unnested as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as place from split),
placed as (
  select doc_id, word, count(*) over (partition by doc_id) as n,
    row_number() over (partition by doc_id order by place) as i
  from unnested where word <> ''),
windows as (
  select doc_id, word, i, case when i <= n - 34 then string_agg(word, ' ') over (
    partition by doc_id order by i rows between current row and 34 following) end as run
  from placed),
starts as (
  select doc_id, word, i, run is not null and count(*) over (partition by run) > 1 as repeated from windows),
covered as (
  select doc_id, word, i, max(repeated::int) over (
    partition by doc_id order by i rows between 34 preceding and current row) as gone
  from starts),
kept as (
  select doc_id, count(*) as n_words, sum(gone) as n_removed,
    string_agg(word, ' ' order by i) filter (where gone = 0) as left_over
  from covered group by doc_id)
select doc_id, cast(coalesce(n_words, 0) as bigint) as n_words,
  cast(coalesce(n_removed, 0) as bigint) as n_removed, sha256(coalesce(left_over, '')) as kept_sha256
from documents left join kept using (doc_id)
"""

_ORACLES["op6_hyperminhash"] = r"""
with recursive split as (
  select doc_id, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') as w from documents),
unnested as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as place from split),
placed as (
  select doc_id, word, count(*) over (partition by doc_id) as n,
    row_number() over (partition by doc_id order by place) as i
  from unnested where word <> ''),
runs as (
  select doc_id, n, i, string_agg(word, ' ') over (
    partition by doc_id order by i rows between current row and 4 following) as shingle
  from placed),
shingles as (select distinct doc_id, shingle from runs where i <= greatest(n - 4, 1)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (
  select a.doc_id as x, b.doc_id as y, count(*) as k
  from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
links as (
  select x, y from pairs join sizes p on p.doc_id = x join sizes q on q.doc_id = y
  where 100 * k >= 85 * (p.n + q.n - k)),
both_ways as (select x, y from links union all select y, x from links),
reach as (
  select x as doc_id, y as other from both_ways
  union select r.doc_id, b.y from reach r join both_ways b on b.x = r.other),
heads as (select doc_id, min(other) as least from reach group by doc_id)
select d.doc_id, cast(coalesce(n, 0) as bigint) as n_shingles,
  least(d.doc_id, coalesce(least, d.doc_id)) as component_id,
  d.doc_id <= coalesce(least, d.doc_id) as kept
from documents d left join sizes using (doc_id) left join heads using (doc_id)
"""


_ORACLES["op11_source_divergence"] = r"""
with docs as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents),
words as (select row, lang, source, unnest(w) as term from docs),
kept as (select lang, term, count(*) as n from words group by all having count(distinct row) >= 10),
sizes as (select lang, count(*) as v, sum(n)::hugeint as total from kept group by lang),
groups as (select distinct lang, source from docs),
counts as (select lang, source, term, count(*) as n from words semi join kept using (lang, term) group by all),
totals as (select lang, source, sum(n)::hugeint as total from counts group by all),
shares as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * s.v) as p,
    1 + (1000000000::hugeint * (k.n + 2)) // (s.total + 2 * s.v) as q
  from groups g join kept k using (lang) join sizes s using (lang)
  left join totals t using (lang, source) left join counts c using (lang, source, term)),
sums as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) as value
  from shares a join shares b using (lang, term) where a.source <> b.source group by all),
pairs as (
  select lang, g.source, h.source as item, coalesce(value, 0)::bigint as value
  from groups g join groups h using (lang) left join sums s
    on s.lang = g.lang and s.source = g.source and s.item = h.source
  where g.source <> h.source),
terms as (
  select lang, source, term as item, (((p - q) * (p - q)) // (p + q))::bigint as value
  from shares where n > 0 and p > q),
ranked as (
  select lang, source, 'pair' as part, item, value,
    row_number() over (partition by lang, source order by value desc, encode(item)) as rank from pairs
  union all
  select lang, source, 'term', item, value,
    row_number() over (partition by lang, source order by value desc, encode(item)) from terms)
select lang, source, part, item, value, rank::int as rank from ranked where part = 'pair' or rank <= 10
"""

_ORACLES["op12_importance_resampling"] = r"""
with texts as (
  select 0 as kind, doc_id as id, text from documents union all select 1, item_id, text from benchmark),
listed as (
  select kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from texts),
runs as (
  select kind, id, unnest(list_concat(w, list_concat(
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))) as run
  from listed),
counted as (select kind, id, run, count(*) as n from runs group by all),
steps as (
  select list(list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1
    then xor(3988292384, c >> 1) else c >> 1 end) order by i) as t from range(256) r(i)),
hashed as (
  select run, xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
    list_transform(range(octet_length(encode(run))), lambda i:
      (instr('123456789ABCDEF', substr(hex(encode(run)), 2 * i + 1, 1)) * 16
        + instr('123456789ABCDEF', substr(hex(encode(run)), 2 * i + 2, 1)))::bigint)),
    lambda c, b: xor(t[1 + (xor(c, b) & 255)], c >> 8))) % 10000 as bucket
  from (select distinct run from counted), steps),
features as (select kind, id, bucket, sum(n) as n from counted join hashed using (run) group by all),
totals as (
  select coalesce(sum(n) filter (where kind = 0), 0) as s, coalesce(sum(n) filter (where kind = 1), 0) as t
  from features),
gains as (
  select bucket, floor(1000 * ln((coalesce(sum(n) filter (where kind = 1), 0) + 1)::double
    * (any_value(totals.s) + 10000)::double / ((coalesce(sum(n) filter (where kind = 0), 0) + 1)::double
    * (any_value(totals.t) + 10000)::double)))::bigint as gain
  from features, totals group by bucket),
weights as (
  select id, sum(n) as n, sum(n * gain) as weight from features join gains using (bucket) where kind = 0 group by id),
scored as (
  select l.id as doc_id, len(w) >= 20 as able, coalesce(n, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
    coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || l.id), 1, 8))::bigint + 0.5::double)
      / 4294967296)))::bigint as score
  from listed l left join weights on weights.id = l.id where kind = 0),
ranked as (select *, row_number() over (partition by able order by score desc, doc_id) as place from scored)
select doc_id, n_features, weight, score,
  case when able and place <= 5 * (select count(*) from scored where able) // 100 then place end as rank
from ranked
"""


def llm_oracles() -> dict[str, str]:
    return dict(_ORACLES)

"""DuckDB SQL of the queries that SQL can express.

Fingerprints (XXH64), tokenizers, the quantised language model and the k-d tree
cannot be written in it; those are tested against brute force.
"""

from __future__ import annotations

from .langid import DOCUMENT, FOLDS, HELD_OUT, PROFILE, UNKNOWN
from .prefixtrie import GROUP, MAX_SHARED
from .quality import MAX_DOCS, MIN_LEFT, MIN_LEFT_SHARE, MIN_WORDS, SYMBOLS
from .resample import BUCKETS, PERCENT, SEED
from .resample import MIN_WORDS as MIN_DRAWN_WORDS
from .rpforest import COSINE
from .urlfilter import MIN_SOFT, RULES, SOFT_TERMS, STRICT_TERMS

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

OP1 = f"""
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as n, sha1(coalesce(html, '')) as x from pages),
b as (select *, cast(unhex(x) as bit)::varchar as bits, max(page_id) over (partition by x, n) as keeper from p)
select page_id, cast(n as bigint) as payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('{_BASE32}', cast(1
    + 16 * cast(substr(bits, 5 * i + 1, 1) as int) + 8 * cast(substr(bits, 5 * i + 2, 1) as int)
    + 4 * cast(substr(bits, 5 * i + 3, 1) as int) + 2 * cast(substr(bits, 5 * i + 4, 1) as int)
    + cast(substr(bits, 5 * i + 5, 1) as int) as int), 1)), 'string_agg', '') as payload_digest,
  case when page_id is not distinct from keeper then 'response' else 'revisit' end as record_type,
  case when page_id is distinct from keeper then keeper end as refers_to
from b
"""

_SPACE = r"[\x20\x09-\x0D]+"

OP2 = rf"""
with d as (
  select doc_id, coalesce(source, chr(0)) as host, coalesce(text, '') as text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}'), lambda x: x <> '') as words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as raw
  from documents),
w as (
  select doc_id, i, list_aggregate(words[i : i + 4], 'string_agg', chr(10)) as g
  from (select doc_id, words, unnest(range(1, len(words) - 3)) as i from d where len(words) >= 5)),
rep as (select doc_id, i from (select *, count(*) over (partition by doc_id, g) as k from w) where k > 1),
cov as (select doc_id, count(distinct i + o) as n_repeat_words
        from rep, (select unnest(range(5)) as o) group by doc_id),
norm as (
  select doc_id, host, raw, words, list_transform(raw, lambda l: lower(trim(regexp_replace(l, '{_SPACE}', ' ', 'g')))) as ls
  from d),
ln as (select doc_id, host, len(words) as n_words, unnest(ls) as l,
              md5(list_aggregate(ls, 'string_agg', chr(10))) as sig from norm),
per as (select host, l, doc_id, sig, n_words, count(*) as k, len(string_split(l, ' ')) as lw
        from ln group by all),
bad as (select host, l from per group by host, l
        having count(distinct sig) > {MAX_DOCS}),
lost as (select doc_id, n_words - sum(k * lw) as kept_words, n_words
         from per join bad using (host, l) group by doc_id, n_words),
base as (
  select doc_id, cast(len(words) as bigint) as n_words,
    cast(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) as bigint) as word_chars,
    cast(length(text) - length(translate(text, '{SYMBOLS}', '')) as bigint) as n_symbols,
    cast(len(raw) - len(list_distinct(raw)) as bigint) as n_dup_lines,
    cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words
  from d left join cov using (doc_id)),
judged as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > 20 * n_words as base_failed from base)
select j.doc_id, j.n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not coalesce(kept_words < {MIN_LEFT} or kept_words < {MIN_LEFT_SHARE} * j.n_words, false) as kept
from judged j left join lost using (doc_id)
"""


def _hits(terms) -> str:
    edge = r"[^\p{L}\p{N}]"
    return " + ".join(f"cast(coalesce(regexp_matches(lower(url), '(^|{edge}){t}($|{edge})'), false) as int)"
                      for t in terms)


def _rules() -> str:
    fits = [f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{v} {h}{p}'"
            for v, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))]
    return "case " + " ".join(fits) + " end"


OP6 = rf"""
with u as (
  select page_id, url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
r as (select *, {_rules()} as fit, cast({_hits(STRICT_TERMS)} as int) as strict_hits,
             cast({_hits(SOFT_TERMS)} as int) as soft_hits from u)
select page_id, host, path, split_part(fit, ' ', 2) as rule,
  coalesce(split_part(fit, ' ', 1),
           case when strict_hits >= 1 or soft_hits >= {MIN_SOFT} then 'block' else 'allow' end) as verdict,
  strict_hits, soft_hits
from r
"""

# CRC-32, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::bigint],
  list_transform(string_split({0}, ''), lambda x: ascii(x)::bigint)),
  lambda c, x: list_reduce(list_concat([xor(c, x)], range(8)), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))))"""

OP8 = rf"""
with d as (
  select doc_id, lang, {_CRC32.format("cast(doc_id as varchar)")} % {FOLDS} = {HELD_OUT} as held_out,
    ' ' || trim(regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{Nl}}\p{{No}}]+', ' ', 'g')) || ' ' as s
  from documents),
i as (select doc_id, lang, held_out, unnest(list_zip(c, c[2:], c[3:])) as t
      from (select *, string_split(s, '') as c from d where regexp_matches(s, '\p{{L}}'))),
t as (select doc_id, lang, held_out, t[1] as x, t[2] as y, t[3] as z from i),
g as (
  select doc_id, lang, held_out, x as g from t where x <> ' '
  union all select doc_id, lang, held_out, x || y from t where not (x = ' ' and y = ' ')
  union all select doc_id, lang, held_out, x || y || z from t where y <> ' ' and z is not null),
own as (
  select doc_id, g, r from (
    select doc_id, g, row_number() over (partition by doc_id order by count(*) desc, length(g), g) - 1 as r
    from g group by doc_id, g) where r < {DOCUMENT}),
prof as (
  select lang, g, r from (
    select lang, g, row_number() over (partition by lang order by count(*) desc, length(g), g) - 1 as r
    from g where not held_out and lang is not null group by lang, g) where r < {PROFILE}),
far as (
  select o.doc_id, l.lang, count(*) as n, sum(coalesce(abs(o.r - p.r), {PROFILE})) as apart
  from own o cross join (select distinct lang from prof) l left join prof p on p.lang = l.lang and p.g = o.g
  group by o.doc_id, l.lang),
best as (select *, row_number() over (partition by doc_id order by apart, lang) as k from far)
select d.doc_id, d.held_out, coalesce(b.lang, '{UNKNOWN}') as lang_pred,
  coalesce(1::double - cast(apart as double) / cast(n * {PROFILE} as double), 0::double) as score
from d left join best b on b.doc_id = d.doc_id and b.k = 1
"""

OP9 = r"""
with w as (
  select doc_id, case when doc_id is null then text end as own,
    list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as ws
  from documents),
b as (
  select item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as ws
  from benchmark),
items as (
  select distinct item_id, n, list_aggregate(ws[i : i + n - 1], 'string_agg', ' ') as g
  from (select item_id, ws, least(len(ws), 5) as n, unnest(range(1, len(ws) - least(len(ws), 5) + 2)) as i
        from b where len(ws) > 0)),
sizes as (select item_id, count(*) as size from items group by item_id),
runs as (
  select distinct doc_id, own, list_aggregate(ws[i : i + n - 1], 'string_agg', ' ') as g
  from (select doc_id, own, ws, n, unnest(range(1, len(ws) - n + 2)) as i
        from w, (select distinct n from items) where len(ws) >= n)),
f as (select doc_id, own, item_id, count(*) as found from runs join items using (g) group by all)
select doc_id, item_id, cast(size as bigint) as item_shingles, cast(found as bigint) as found_shingles,
  cast(found as double) / size as containment
from f join sizes using (item_id) where found >= 0.8 * size - 1e-9
"""

# The bytes of a text, in hexadecimal digits, as numbers.
_BYTES = """list_transform(range(octet_length(encode({0}))),
  lambda i: cast('0x' || substr(hex(encode({0})), cast(2 * i + 1 as int), 2) as bigint))"""
_CRC32_BYTES = f"""xor(4294967295, list_reduce(list_concat([4294967295::bigint], {_BYTES}),
  lambda c, x: list_reduce(list_concat([xor(c, x)], range(8)), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))))"""

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RUNS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP11 = rf"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all({_FOLDED}, '{_RUNS}') as ws from documents),
dw as (select r, unnest(ws) as w from d),
bw as (select unnest(regexp_extract_all({_FOLDED}, '{_RUNS}')) as w from benchmark),
vocab as (select w, {_CRC32_BYTES.format("w")} % {BUCKETS} as bucket
          from (select distinct w from (select w from dw union all select w from bw))),
s as (select bucket, count(*) as s from dw join vocab using (w) group by bucket),
t as (select bucket, count(*) as t from bw join vocab using (w) group by bucket),
gain as (
  select s.bucket, cast(floor(1000 * ln((cast(coalesce(t, 0) as double) + 1) * ((select count(*) from dw) + {BUCKETS})
    / ((cast(s as double) + 1) * ((select count(*) from bw) + {BUCKETS})))) as bigint) as gain
  from s left join t on s.bucket = t.bucket),
weight as (select r, sum(gain) as weight from dw join vocab using (w) join gain using (bucket) group by r),
scored as (
  select d.r, doc_id, cast(len(ws) as bigint) as n_features, cast(coalesce(weight, 0) as bigint) as weight,
    cast(coalesce(weight, 0) + floor(-1000 * ln(-ln((cast('0x' || substr(sha256('{SEED}:' || coalesce(cast(doc_id as varchar), '')), 1, 8)
      as bigint) + 0.5::double) / 4294967296::double))) as bigint) as score
  from d left join weight on d.r = weight.r),
ranked as (
  select *, row_number() over (partition by n_features >= {MIN_DRAWN_WORDS} order by score desc, doc_id nulls last, r) as k,
    count(*) over (partition by n_features >= {MIN_DRAWN_WORDS}) as n
  from scored)
select doc_id, n_features, weight, score,
  case when n_features >= {MIN_DRAWN_WORDS} and k <= {PERCENT} * n // 100 then k end as rank
from ranked
"""

OP12 = rf"""
with turns as (
  select conv_id as c, conv_id - conv_id % {GROUP} as lead, coalesce(text, '') as text,
    sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as h, turn
  from conversations where conv_id is not null),
own as (select *, row_number() over (partition by c order by turn nulls first, substr(h, 1, 32)) - 1 as i from turns),
convs as (select distinct c, lead,
  case when c = lead then 0 else {_CRC32.format("cast(c as varchar)")} % {MAX_SHARED} end as shared from turns),
rebuilt as (
  select convs.c, own.i, own.h, length(own.text) as chars from convs join own on own.c = convs.lead where own.i < shared
  union all
  select own.c, own.i + {MAX_SHARED}, own.h, length(own.text) from convs join own on own.c = convs.c where own.i >= shared),
placed as (select c, h, chars, row_number() over (partition by c order by i) as d from rebuilt),
seqs as (select c, list(h order by d) as hs, list(chars order by d) as ns from placed group by c),
paths as (select convs.c, coalesce(hs, []) as hs, coalesce(ns, []) as ns from convs left join seqs on convs.c = seqs.c),
steps as (
  select c, d, len(hs) as n, list_aggregate(list_concat(['root'], hs[1 : d]), 'string_agg', '/') as k,
    case when d > 0 then list_aggregate(list_concat(['root'], hs[1 : d - 1]), 'string_agg', '/') end as up,
    case when d > 0 then ns[d] else 0 end as chars
  from (select *, unnest(range(len(hs) + 1)) as d from paths)),
nodes as (
  select k, any_value(up) as up, any_value(d) as depth, min(c) as conv, count(*) as n, any_value(chars) as chars,
    sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (d = steps.n), '')) as ends
  from steps group by k),
kids as (select up, count(*) as n_children from nodes where up is not null group by up),
facts as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join kids on kids.up = nodes.k),
above as (
  select distinct k, list_aggregate(list_concat(['root'], hs[1 : e]), 'string_agg', '/') as top
  from (select steps.k, paths.hs, unnest(range(steps.d + 1)) as e from steps join paths on paths.c = steps.c)),
sums as (
  select top, sum((n_children = 0)::int) as n_leaves, sum((n - 1) * chars) as saved
  from above join facts using (k) group by top)
select f.conv as conv_id, cast(f.depth as bigint) as depth, p.conv as parent_conv_id, f.n as n_convs,
  cast(f.n_children as bigint) as n_children, cast(n_leaves as bigint) as n_leaves, cast(saved as bigint) as saved_tokens,
  f.ends as ends_sha256
from facts f join sums on sums.top = f.k left join nodes p on p.k = f.up
"""

OP13 = f"""
with recursive v as (
  select vec_id, cast(embedding as double[]) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= {COSINE}),
reach as (select a as x, b as y from links union select x, b from reach join links on a = y)
select e.vec_id, (select count(*) from links where a = e.vec_id) as n_links,
  least(e.vec_id, coalesce((select min(y) from reach where x = e.vec_id), e.vec_id)) as component_id,
  e.vec_id <= coalesce((select min(y) from reach where x = e.vec_id), e.vec_id) as kept
from embeddings e
"""

ORACLE_SQL: dict[str, str] = {
    "op1_warc": OP1,
    "op2_quality_rules": OP2,
    "op6_url_filters": OP6,
    "op8_language_id": OP8,
    "op9_decontamination": OP9,
    "op11_importance_resampling": OP11,
    "op12_prefix_trie": OP12,
    "op13_embedding_dedup": OP13,
}

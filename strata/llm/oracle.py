"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from strata.llm import host_rules as H
from strata.llm import url_redirects as U

_SPACE = r"[\x20\x09-\x0D]"

HOST_RULES = rf"""
with d as (select row_number() over () as r, doc_id, source, coalesce(text, '') as t from documents),
w as (select *, list_filter(regexp_split_to_array(t, '{_SPACE}+'), lambda x: x <> '') as ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
tri as (select r, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] as g
        from (select r, ws, unnest(generate_series(1, len(ws) - 2)) as i from w)),
rep as (select r, i from (select r, i, count(*) over (partition by r, g) as k from tri) where k > 1),
cov as (select r, count(distinct j) as n from (select r, unnest([i, i + 1, i + 2]) as j from rep) group by r),
m as (select w.r, doc_id, source, cast(len(ws) as bigint) as n_words,
             cast(length(regexp_replace(t, '{_SPACE}+', '', 'g')) as bigint) as word_chars,
             cast(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as bigint) as n_symbols,
             cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
             cast(coalesce(cov.n, 0) as bigint) as n_repeat_words
      from w left join cov on w.r = cov.r),
j as (select *, n_words < {H.MIN_WORDS} or 100 * n_repeat_words > {H.MAX_REPEAT_PERCENT} * n_words as base_failed,
             100 * n_symbols > {H.MAX_SYMBOL_PERCENT} * word_chars as symbols_failed from m),
h as (select source, count(*)::double as n, count(*) filter (where base_failed)::double as fb,
             count(*) filter (where symbols_failed)::double as fs from j group by source),
s as (select count(*)::double as k, sum(n) as n, sum(n * n) as nn, sum(fb) / sum(n) as mb, sum(fb * fb / n) as sb,
             sum(fs) / sum(n) as ms, sum(fs * fs / n) as ss from h),
t as (select *, sb / n - mb * mb - mb * (1 - mb) * (k - 1) / n as vb, ss / n - ms * ms - ms * (1 - ms) * (k - 1) / n as vs,
             1 - nn / n / n as c from s),
p as (select *, case when vb > 0 and c > 0 and mb > 0 and mb < 1 and k > 1 then greatest(mb * (1 - mb) * c / vb - 1, 1) end as kb,
             case when vs > 0 and c > 0 and ms > 0 and ms < 1 and k > 1 then greatest(ms * (1 - ms) * c / vs - 1, 1) end as ks from t),
v as (select h.source, greatest(case when kb is null then mb else (fb + mb * kb) / (h.n + kb) end,
                                case when ks is null then ms else (fs + ms * ks) / (h.n + ks) end) > {H.MAX_HOST_RATE} as bad
      from h, p)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not v.bad as kept
from j join v on j.source is not distinct from v.source
"""

_PIECES = r"[\p{L}]+|[\p{N}]+|[^\x20\x09-\x0D\p{L}\p{N}]"

TOKEN_ROLLUP = rf"""
with d as (select doc_id, source, lang, coalesce(text, '') as t from documents),
kept as (select distinct doc_id, source, lang, t, row_number() over (partition by t order by doc_id) as k from d),
u as (select source, lang, replace(t, '|', ' ') as t from kept where k = 1),
c as (select source, lang, 'words-1' as tokenizer, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) as n from u
      union all select source, lang, 'pieces-2', len(regexp_extract_all(t, '{_PIECES}')) from u)
select source, lang, tokenizer, cast(count(*) as bigint) as n_docs, cast(sum(n) as bigint) as n_tokens from c group by all
"""

#: Conversations as lists of turns; a shorter list that starts a longer one is dropped, and of equal ones all but the first.
SNAPSHOT_COLLAPSE = """
with o as (select conv_id, role, text, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) - 1 as position
           from conversations where conv_id is not null),
c as (select conv_id, list({'r': role, 't': text} order by position) as turns, count(*) as n from o group by conv_id),
k as (select * from c a where not exists (
        select 1 from c b where b.conv_id <> a.conv_id and b.turns[1:a.n] = a.turns and (b.n > a.n or b.conv_id < a.conv_id)))
select o.conv_id, cast(k.n as bigint) as n_turns, cast(o.position as bigint) as position, coalesce(role, 'unknown') as role,
       '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || chr(10) || '<|end|>' || chr(10) as rendered
from o join k on o.conv_id = k.conv_id
"""

_HOST = "translate(regexp_extract(coalesce({0}, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract(coalesce({0}, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1)"


def _rule() -> str:
    cases = [
        f"when (host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}') then '{r.text}'"
        for r in sorted(U.RULES, key=lambda r: -len(r.text))
    ]
    return f"case {' '.join(cases)} end"


def _verdict() -> str:
    return "case " + " ".join(f"when rule = '{r.text}' then '{r.verdict}'" for r in U.RULES) + " end"


#: The pages of the driver name no canonical address and no redirect: aliases here are spellings of one address.
URL_REDIRECTS = f"""
with h as (select page_id, url, {_HOST.format('url')} as host, {_PATH.format('url')} as path from pages),
r as (select *, {_rule()} as rule,
      case when contains(url, '://') then regexp_replace(host, '^www[.]', '') ||
        regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
          regexp_extract(url, '^(?s:.*?)://[^/?#]*((?s:.*))$', 1), '#(?s:.*)$', ''),
          '([?&])(utm_[a-z]+|ref|fbclid|gclid)=[^&#]*&', '\\1', 'g'), '([?&])(utm_[a-z]+|ref|fbclid|gclid)=[^&#]*$', '\\1'),
          '[?&]$', ''), '/([?]|$)', '\\1', 'g') end as node from h),
v as (select *, {_verdict()} as own from r),
b as (select distinct node from v where own = 'block')
select page_id, host, path, rule, coalesce(own, case when b.node is not null then 'block' end, 'allow') as verdict
from v left join b on v.node = b.node
"""

#: Base 32 takes five bits a letter: 20 bits, or five hexadecimal digits, are four letters.
WARC_BUNDLES = """
with p as (select page_id, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes, sha1(coalesce(html, '')) as h from pages),
g as (select h, payload_bytes, max(page_id) as m, count(*) as n from p group by all),
q as (select page_id, payload_bytes, h, m, n > 1 and m is not null and page_id is distinct from m as again from p join g using (h, payload_bytes))
select page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (cast(('0x' || substr(h, 5 * (i // 4) + 1, 5)) as bigint) >> (15 - 5 * (i % 4))) % 32 + 1, 1)), '') as payload_digest,
       case when again then 'revisit' else 'response' end as record_type, case when again then m end as refers_to
from q
"""

#: The CRC-32 of the decimal of c, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split({c}::varchar, ''), lambda s: ascii(s)::bigint)),
  lambda x, b: list_reduce(list_prepend(xor(x, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))))"""

#: Every node as the list of its turns. Distinct lists are nodes; a node is expanded into its prefixes to sum over subtrees.
CONVERSATION_TRIE = f"""
with o as (select conv_id, coalesce(role, '') as r, coalesce(text, '') as t, turn from conversations where conv_id is not null),
p as (select *, row_number() over (partition by conv_id order by turn nulls first, substr(sha256(length(r) || ':' || r || t), 1, 32)) as i from o),
c as (select conv_id, list({{'r': r, 't': t}} order by i) as turns from p group by conv_id),
h as (select *, {_CRC32.format(c="conv_id")} % 6 as h from c),
b as (select h.conv_id, list_concat(coalesce(l.turns[1:h.h], []), h.turns[h.h + 1:]) as turns
      from h left join c l on l.conv_id = h.conv_id - h.conv_id % 100),
m as (select conv_id, turns[1:d] as path, d, d = len(turns) as ends from (select *, unnest(range(0, len(turns) + 1)) as d from b)),
k as (select path, d, min(conv_id) as conv_id, count(*) as n,
             sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256 from m group by path, d),
ch as (select path[1:d - 1] as path, count(*) as n from k where d > 0 group by 1),
v as (select k.*, coalesce(ch.n, 0) as n_children, case when k.d > 0 then (k.n - 1) * length(k.path[k.d].t) else 0 end as saved
      from k left join ch on k.path = ch.path),
s as (select path[1:e] as path, sum(saved) as saved, count(*) filter (where n_children = 0) as leaves
      from (select *, unnest(range(0, d + 1)) as e from v) group by 1)
select v.conv_id, cast(v.d as bigint) as depth, u.conv_id as parent_conv_id, cast(v.n as bigint) as n_convs,
       cast(v.n_children as bigint) as n_children, cast(s.leaves as bigint) as n_leaves, cast(s.saved as bigint) as saved_tokens, v.ends_sha256
from v join s on v.path = s.path left join v u on v.d > 0 and u.d = v.d - 1 and u.path = v.path[1:v.d - 1]
"""

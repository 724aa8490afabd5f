"""The same results in DuckDB SQL, for the queries that SQL can express."""

from __future__ import annotations

from . import mixing, quality, resampling, sharding, substring

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _bits() -> str:
    cases = [f"case when {fails} then {quality.BIT[name]} else 0 end" for name, fails in quality.RULES]
    return " + ".join(cases)


_STOP = " ".join(f"when '{lang}' then len(list_filter(w, lambda x: lower(x) in {tuple(words)}))" for lang, words in quality.STOP_WORDS.items())
_COUNT = "cast(length(t) - length(regexp_replace(t, '{0}', '', 'g')) as bigint)"

#: b: a row for each document with the measurements and the failure bits
LEDGER = rf"""d as (select row_number() over () rid, doc_id, lang, source, text, coalesce(text, '') t, {_WORDS} w from documents),
lines as (select rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) l from d),
trimmed as (select rid, l, list_transform(l, lambda x: regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')) k from lines),
grams as (select rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] g from d, lateral (select unnest(range(1, len(w) - 1)) i)),
twice as (select rid, i, count(*) over (partition by rid, g) n from grams),
hit as (select rid, count(distinct p) n from (select rid, unnest([i, i + 1, i + 2]) p from twice where n > 1) group by rid),
pairs as (select rid, max(n) n from (select rid, w[i] || ' ' || w[i + 1] g, count(*) n from d, lateral (select unnest(range(1, len(w))) i) group by all) group by rid),
m as (select d.rid, doc_id, source, text, cast(len(w) as bigint) n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) word_chars,
  {_COUNT.format("[#*$%&|<>]")} n_symbols, cast(len(l) as bigint) n_lines, cast(len(l) - len(list_distinct(l)) as bigint) n_dup_lines, cast(coalesce(hit.n, 0) as bigint) n_repeat_words,
  cast(len(list_filter(w, lambda x: not regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) as bigint) n_bare_words, case when len(w) = 0 then 0 else {_COUNT.format("[0-9]")} end n_digits, case when len(w) = 0 then 0 else {_COUNT.format("[A-Z]")} end n_upper,
  cast(len(list_filter(k, lambda x: x like '%...' or x like '%…')) as bigint) n_ellipsis_lines, cast(len(list_filter(k, lambda x: regexp_matches(x, '^[-*•|]'))) as bigint) n_bullet_lines,
  cast(coalesce(list_max(list_transform(w, lambda x: length(x))), 0) as bigint) longest_word, cast(case when pairs.n > 1 then 2 * pairs.n else 0 end as bigint) n_top_pair,
  cast(case lang {_STOP} else -1 end as bigint) n_stop_words
  from d join trimmed using (rid) left join hit using (rid) left join pairs using (rid)),
b as (select *, {_bits()} fail_bits from m)"""

OP9 = rf"""with {LEDGER}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & {quality.BASE} <> 0 base_failed, fail_bits & {quality.POLICIES[quality.PRODUCTION]} = 0 kept,
  n_lines, n_bare_words, n_digits, n_upper, n_ellipsis_lines, n_bullet_lines, longest_word, n_top_pair, n_stop_words, cast(fail_bits as int) fail_bits from b"""

ABLATIONS = rf"""with {LEDGER}, r as (select unnest({[{"rule": k, "bit": v} for k, v in quality.BIT.items()]}, recursive := true))
select rule, cast(count(*) filter (where fail_bits & "bit" <> 0) as bigint) n_failing, cast(count(*) filter (where fail_bits = "bit") as bigint) n_failing_alone,
  cast(count(*) filter (where fail_bits & ~"bit" = 0) as bigint) n_kept_without from b, r group by rule"""

OP10 = rf"""
with {LEDGER}, e0 as (select rid, doc_id, source, text, n_words size, fail_bits from b),
s as (select source, cast(sum(size) as bigint) n, row_number() over (order by source nulls last) i from e0 group by source),
w as (select *, list_extract({list(mixing.WEIGHTS)}, (i - 1) % {len(mixing.WEIGHTS)} + 1)::double w from s),
r as (select *, {mixing.MOST_EPOCHS}::double * n / w ratio from w),
l as (select *, ({mixing.SHARE}::double * (select sum(n) from r) - coalesce(sum({mixing.MOST_EPOCHS}::double * n) over (order by ratio, i rows between unbounded preceding and 1 preceding), 0))
  / sum(w) over (order by ratio, i rows between current row and unbounded following) lev from r),
v as (select coalesce((select lev from l where lev <= ratio order by ratio, i limit 1), 1e300) lev),
t as (select source, n, case when v.lev <= ratio then least({mixing.MOST_EPOCHS}::double * n, v.lev * w) else {mixing.MOST_EPOCHS}::double * n end target from l, v),
e as (select *, case when n > 0 then least(floor(target / n), {mixing.MOST_EPOCHS}) else 0 end epochs from t),
k as (select e0.*, n, target, epochs, -ln((cast(('0x' || substr(md5(coalesce(cast(doc_id as varchar), 'null') || ':' || md5(coalesce(text, '')) || ':{mixing.SEED}'), 1, 13)) as bigint) + 0.5::double) / 4503599627370496::double)
  * (1 << bit_count(fail_bits)) key from e0 join e on e0.source is not distinct from e.source),
p as (select *, sum(size) over (partition by source order by key, doc_id nulls last rows unbounded preceding) ends from k),
c as (select *, cast(case when size = 0 then 0 else epochs + case when ends - size / 2.0::double <= target - epochs * n and epochs < {mixing.MOST_EPOCHS} then 1 else 0 end end as int) copies from p)
select doc_id, size, n source_size, target, copies * size taken, copies from c"""

OP5 = rf"""
with d as (select doc_id, cast(coalesce(strlen(text), 0) as bigint) bytes,
  cast(('0x' || substr(md5(coalesce(cast(doc_id as varchar), 'null') || ':' || md5(coalesce(text, ''))), 1, 15)) as bigint) h from documents),
u as (select h, depth, h >> ({sharding.BITS} - depth) prefix, bytes from d, (select unnest(range(0, {sharding.BITS} + 1)) depth)),
f as (select depth, prefix, sum(bytes) <= {sharding.LIMIT} fits from u group by all having sum(bytes) <= {sharding.LIMIT} or min(h) = max(h)),
a as (select u.h, min(u.depth) depth from u join f on u.depth = f.depth and u.prefix = f.prefix group by 1),
x as (select d.*, a.depth, d.h >> ({sharding.BITS} - a.depth) prefix, row_number() over (partition by d.h) rn from d join a using (h)),
y as (select x.*, case when fits then 0 else (rn - 1) // greatest(1, {sharding.LIMIT} // greatest(bytes, 1)) end page from x join f on x.depth = f.depth and x.prefix = f.prefix)
select doc_id, bytes, cast(depth as int) depth, prefix, cast(page as bigint) page, bytes > {sharding.LIMIT} oversize, 'd' || depth || '-' || prefix || '-' || page shard from y"""

OP8 = rf"""
with d as (select row_number() over () rid, doc_id, {_WORDS} w from documents),
x as (select rid, i, w[i] word, case when i + {substring.WINDOW - 1} <= len(w) then array_to_string(w[i:i + {substring.WINDOW - 1}], ' ') end g from d, lateral (select unnest(range(1, len(w) + 1)) i)),
n as (select *, case when g is not null and count(*) over (partition by g) > 1 then 1 else 0 end starts from x),
k as (select *, max(starts) over (partition by rid order by i rows between {substring.WINDOW - 1} preceding and current row) gone from n),
a as (select rid, count(*) n_words, cast(sum(gone) as bigint) n_removed, coalesce(string_agg(word, ' ' order by i) filter (where gone = 0), '') kept from k group by rid)
select doc_id, coalesce(n_words, 0) n_words, coalesce(n_removed, 0) n_removed, sha256(coalesce(kept, '')) kept_sha256 from d left join a using (rid)"""

#: crcs(s, crc): the unsigned CRC-32 of each s of a table texts(s), byte by byte over all of them
_CRCS = r"""bits as (select i::bigint b, i::bigint c, 0 k from range(256) r(i) union all select b, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from bits where k < 8),
lut as (select b, c from bits where k = 8),
steps as (select s, 1::bigint i, 4294967295::bigint c, hex(encode(s)) x from texts union all
  select s, i + 1, xor(steps.c >> 8, lut.c), x from steps join lut on lut.b = xor(steps.c & 255, cast('0x' || substr(x, 2 * i - 1, 2) as bigint)) where 2 * i <= length(x)),
crcs as (select s, xor(c, 4294967295) crc from steps where 2 * i > length(x))"""

OP11 = rf"""
with recursive d as (select row_number() over () rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{resampling.WORD}') w from documents),
t as (select regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{resampling.WORD}') w from benchmark),
f as (select rid, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) s from d),
g as (select unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) s from t),
texts as (select s from f union select s from g),
{_CRCS},
ds as (select crc % {resampling.BUCKETS} b, count(*) n from f join crcs using (s) group by 1),
ts as (select crc % {resampling.BUCKETS} b, count(*) n from g join crcs using (s) group by 1),
gain as (select ds.b, cast(floor(1000 * ln(((coalesce(ts.n, 0) + 1)::double * ((select sum(n) from ds)::double + {resampling.BUCKETS})) / ((ds.n + 1)::double * (coalesce((select sum(n) from ts), 0)::double + {resampling.BUCKETS})))) as bigint) gain
  from ds left join ts using (b)),
m as (select rid, count(*) n, cast(sum(gain) as bigint) total from f join crcs using (s) join gain on b = crc % {resampling.BUCKETS} group by rid),
s as (select d.rid, doc_id, len(w) words, coalesce(n, 0) n_features, coalesce(cast((total - ((total % n) + n) % n) // n as bigint), 0) weight,
  cast(floor(-1000 * ln(-ln((cast('0x' || substr(sha256('{resampling.SEED}:' || coalesce(cast(doc_id as varchar), 'null')), 1, 8) as bigint) + 0.5::double) / 4294967296::double))) as bigint) noise from d left join m using (rid)),
r as (select rid, row_number() over (order by weight + noise desc, doc_id nulls last, rid) k, count(*) over () n from s where words >= {resampling.FEWEST_WORDS})
select doc_id, n_features, weight, weight + noise score, case when k <= {resampling.DRAWN} * n // 100 then k end "rank" from s left join r using (rid)"""

OP13 = rf"""
with recursive e as (select conv_id c, turn, coalesce("role", '') r, coalesce(text, '') t from conversations where conv_id is not null),
turns as (select c, row_number() over (partition by c order by turn nulls first, dg) i, dg, n from
  (select c, turn, substr(sha256(cast(length(r) as varchar) || ':' || r || t), 1, 32) dg, cast(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) as bigint) n from e)),
texts as (select distinct cast(c as varchar) s from e),
{_CRCS},
convs as (select cast(s as bigint) c, crc % 4 h, (select count(*) from turns b where b.c = cast(s as bigint) - cast(s as bigint) % 20 and b.i <= crc % 4) k from crcs),
built as (select v.c, b.i p, dg, n from convs v join turns b on b.c = v.c - v.c % 20 and b.i <= h union all select v.c, k + i - h, dg, n from convs v join turns o on o.c = v.c and o.i > h),
m as (select c, 0 d, '' key, 0 n from convs union all select c, p, string_agg(dg, '') over (partition by c order by p), n from built),
deep as (select c, max(d) d from m group by c),
node as (select key, d, min(c) c, count(*) n_convs, max(n) n from m group by key, d),
up as (select x.key, x.d, x.c, x.n_convs, x.n, a.key pkey from node x left join m a on a.c = x.c and a.d = x.d - 1),
kids as (select pkey key, count(*) n_children from up where pkey is not null group by 1),
own as (select up.*, coalesce(n_children, 0) n_children from up left join kids using (key)),
sums as (select a.key, cast(sum(case when n_children = 0 then 1 else 0 end) as bigint) n_leaves, cast(sum((n_convs - 1) * own.n) as bigint) saved_tokens from own join m a on a.c = own.c and a.d <= own.d group by a.key),
ends as (select key, string_agg(cast(c as varchar), ',' order by c) ids from m join deep using (c, d) group by key)
select own.c conv_id, cast(own.d as bigint) "depth", p.c parent_conv_id, own.n_convs, own.n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) ends_sha256
from own join sums using (key) left join node p on p.key = own.pkey left join ends on ends.key = own.key"""

ORACLES = {
    "op5_extendible_sharding": OP5,
    "op8_substring_dedup": OP8,
    "op9_quality_rules": OP9,
    "op10_source_mixing": OP10,
    "op11_importance_resampling": OP11,
    "op13_conversation_trie": OP13,
    "quality_ablations": ABLATIONS,
}

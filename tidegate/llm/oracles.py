"""SQL counterparts, for the operators that SQL can express. Texts stand as plain DuckDB SQL."""

from __future__ import annotations

from tidegate.llm.common import LOWER, UPPER
from tidegate.llm.mixing import SEED
from tidegate.llm.warc_revisits import PERMITTED, TRACKING

_REACH = """
ends as (select a, b from links union select b, a from links),
reach as (
  select a as node, b as other from ends
  union select r.node, l.b from reach r join ends l on r.other = l.a
)"""

OP4 = f"""
with recursive v as (
  select vec_id, cast(embedding as double[]) e,
    coalesce(len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0, false) fine from embeddings),
links as (select p.vec_id a, q.vec_id b from v p join v q on p.vec_id > q.vec_id
  where p.fine and q.fine and list_cosine_similarity(p.e, q.e) >= 0.9),
{_REACH},
copies as (select e, count(*) n from v where fine group by e)
select v.vec_id,
  (select count(*) from links l where l.a = v.vec_id or l.b = v.vec_id) n_links,
  least(v.vec_id, coalesce((select min(other) from reach r where r.node = v.vec_id), v.vec_id)) component_id,
  least(v.vec_id, coalesce((select min(other) from reach r where r.node = v.vec_id), v.vec_id)) = v.vec_id kept,
  coalesce(c.n, 1) n_copies
from v left join copies c on v.fine and v.e = c.e
"""

OP5 = f"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') w from documents),
s as (
  select distinct doc_id, case when len(w) < 5 then array_to_string(w, ' ') else array_to_string(w[i:i+4], ' ') end g
  from w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(i) where len(w) > 0),
n as (select doc_id, count(*) n, md5(string_agg(g, '|' order by g)) whole from s group by doc_id),
common as (select p.doc_id a, q.doc_id b, count(*) c from s p join s q on p.g = q.g and p.doc_id > q.doc_id group by 1, 2),
links as (select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
{_REACH},
least_of as (select node, min(other) m from reach group by node),
copies as (select whole, count(*) n_copies from n group by whole)
select d.doc_id, coalesce(n.n, 0) n_shingles, least(d.doc_id, coalesce(l.m, d.doc_id)) component_id, coalesce(c.n_copies, 1) n_copies
from documents d left join n on n.doc_id = d.doc_id left join least_of l on l.node = d.doc_id left join copies c on c.whole = n.whole
"""

OP7 = f"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint size,
    md5('{SEED}' || coalesce(cast(doc_id as varchar), '') || '|' || coalesce(text, '')) k from documents),
src as (select source, sum(size)::bigint source_size from d group by source),
placed as (select *, row_number() over (order by source is null, source) place from src),
w as (select *, ((place - 1) % 3) + 1 weight, source_size * 3 cap from placed),
r as (select *, cap / weight ratio from w),
l as (select *,
    (sum(source_size) over () - coalesce(sum(cap) over (order by ratio, place rows between unbounded preceding and 1 preceding), 0))::double
    / (sum(weight) over () - coalesce(sum(weight) over (order by ratio, place rows between unbounded preceding and 1 preceding), 0))::double lev from r),
t as (select source, source_size, place, weight, least(cap::double, weight * max(case when lev <= ratio then lev end) over ()) target from l),
q as (select d.*, t.source_size, t.place, t.weight, t.target,
    sum(size) over (partition by d.source order by k, doc_id rows between unbounded preceding and current row) sent
  from d join t on d.source is not distinct from t.source),
turns as (select *, ((turn * source_size + sent)::double / weight) finish from q, unnest([0, 1, 2]) x(turn)),
served as (select *, sum(size) over (order by finish, place, turn, k, doc_id rows between unbounded preceding and current row) so_far from turns)
select doc_id, any_value(size) size, any_value(source_size) source_size, any_value(target) target,
  (count(*) filter (so_far <= (select sum(source_size) from src)) * any_value(size))::bigint taken,
  (count(*) filter (so_far <= (select sum(source_size) from src)))::bigint copies
from served group by doc_id
"""

_TEXT = "regexp_replace(trim(url), '#.*$', '')"
_REST = "regexp_replace(txt, '^[A-Za-z][A-Za-z0-9+.-]*://', '')"
_QUERY = (
    "list_sort(list_filter(string_split(regexp_extract(rest, '[?](.*)$', 1), '&'), "
    f"lambda p: p <> '' and not regexp_matches(lower(p), '^({TRACKING})(=|$)')))"
)

OP1 = f"""
with base as (
  select page_id, url, md5(coalesce(html, '')) h, 1704067200 + (page_id % 97) * 3600 t0 from pages),
captures as (
  select page_id * 4 + k record_id, url, page_id, k, h,
    case k when 0 then 'response' else 'revisit' end warc_type,
    case when k = 0 and page_id % 17 = 0 then 404 when k = 0 then 200 else 304 end status,
    t0 + case k when 0 then 0 when 1 then 18000 when 2 then 36000 else -86400 end ts,
    case when page_id % 5 = 4 then null when k = 2 and page_id % 3 = 0 then '"changed"' when k = 2 then 'W/"' || substr(h, 1, 8) || '"'
      else '"' || substr(h, 1, 8) || '"' end etag,
    case when page_id % 7 = 6 then null else 'day ' || (page_id % 31) end last_modified
  from base, unnest([0, 1, 2, 3]) t(k)),
u as (select *, {_TEXT} txt from captures),
v as (select *, {_REST} rest from u),
x as (select *, {_QUERY} kept from v),
y as (select *, case when contains(txt, '://') then
    regexp_replace(regexp_replace(regexp_replace(translate(regexp_extract(rest, '^[^/?]*'), '{UPPER}', '{LOWER}'), '^[^@]*@', ''), '^www[.]', ''), ':(80|443)$', '')
    || regexp_replace(regexp_extract(rest, '^[^/?]*(/[^?]*)?', 1), '/+$', '')
    || case when len(kept) > 0 then '?' || array_to_string(kept, '&') else '' end else trim(url) end url_key from x),
full_ones as (select *, row_number() over (partition by url_key, ts order by record_id desc) rn from y where warc_type = 'response' and status = 200),
found as (
  select r.record_id, r.url_key, r.ts, r.etag, r.last_modified, r.h, r.k, r.page_id, f.record_id refers_to, f.ts f_ts, f.etag f_etag,
    f.last_modified f_lm, f.h f_h, f.page_id f_page
  from (select * from y where warc_type = 'revisit') r
  left join (select * from full_ones where rn = 1) f on f.url_key = r.url_key and f.ts < r.ts
  qualify row_number() over (partition by r.record_id order by f.ts desc) = 1),
judged as (select *, case when refers_to is null then 'no_earlier'
    when etag is not null and f_etag is not null then case when regexp_replace(etag, '^W/', '') = regexp_replace(f_etag, '^W/', '') then 'resolved' else 'mismatch' end
    when last_modified is not null and f_lm is not null then case when last_modified = f_lm then 'resolved' else 'mismatch' end
    when h = f_h then 'resolved' else 'mismatch' end outcome from found)
select record_id, url_key, ts, refers_to, f_ts refers_to_ts, outcome,
  case when outcome = 'resolved' then f_h end digest,
  case when outcome = 'resolved' then coalesce(etag, f_etag) end h_etag,
  case when outcome = 'resolved' then 'max-age=' || (60 * k) end h_cache_control,
  case when outcome = 'resolved' then 'text/html' end h_content_type,
  case when outcome = 'resolved' then 'page=' || f_page end h_set_cookie,
  case when outcome = 'resolved' then cast(ts as varchar) end h_date
from judged
"""
assert "cache-control" in PERMITTED and "set-cookie" not in PERMITTED

_FAILS = {
    "short": "n_words < 50", "repeats": "100 * n_repeat_words > 50 * n_words", "symbols": "10 * n_symbols > n_words",
    "lines": "10 * n_dup_lines > 3 * n_lines", "lengths": "word_chars < 3 * n_words or word_chars > 10 * n_words",
}
_COUNTED = ", ".join(f"count(*) filter ({rule}) {name}" for name, rule in _FAILS.items())
_PRIORS = ", ".join(f"avg({n} / n_docs::double) {n}_m, coalesce(var_samp({n} / n_docs::double), 0) {n}_v" for n in _FAILS)
_TRUE = ", ".join(f"{n}_v - {n}_m * (1 - {n}_m) * chance {n}_t" for n in _FAILS)
_STRENGTH = ", ".join(
    f"{n}_m, greatest(1.0, least(10000.0, case when {n}_t > 0 then {n}_m * (1 - {n}_m) / {n}_t - 1 else 10000.0 end)) {n}_s" for n in _FAILS
)
_BLOCKED = " or ".join(f"({n} + {n}_m * {n}_s) / (n_docs + {n}_s) > 0.5" for n in _FAILS)

OP13 = f"""
with w as (
  select doc_id, source, coalesce(text, '') x, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') w from documents),
l as (select *, list_filter(string_split(x, chr(10)), lambda s: regexp_matches(s, '[^\\x20\\x09-\\x0D]')) l from w),
windows as (select doc_id, i, w[i] a, w[i + 1] b, w[i + 2] c from w, unnest(range(1, len(w) - 1)) t(i)),
found as (select doc_id, i, count(*) over (partition by doc_id, a, b, c) n from windows),
covered as (select doc_id, count(distinct i + j) n from found, unnest([0, 1, 2]) u(j) where n > 1 group by doc_id),
f as (
  select l.doc_id, source, len(w)::bigint n_words, length(array_to_string(w, ''))::bigint word_chars,
    length(regexp_replace(x, '[^#*$%&|<>]', '', 'g'))::bigint n_symbols, len(l)::bigint n_lines,
    (len(l) - len(list_distinct(l)))::bigint n_dup_lines, coalesce(c.n, 0)::bigint n_repeat_words
  from l left join covered c using (doc_id)),
hosts as (select source, count(*) n_docs, {_COUNTED} from f where source is not null group by source),
prior as (select avg(1.0::double / n_docs) chance, {_PRIORS} from hosts),
true_var as (select *, {_TRUE} from prior),
strength as (select {_STRENGTH} from true_var),
verdict as (select source, {_BLOCKED} blocked from hosts, strength)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({_FAILS["short"]} or {_FAILS["repeats"]}) base_failed,
  not ({_FAILS["short"]} or {_FAILS["repeats"]}) and not coalesce(blocked, false) kept, coalesce(blocked, false) host_blocked
from f left join verdict using (source)
"""

# The crc32 of each ``names.name``, byte by byte.
_CRC = """
bits as (select i, list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) v from range(256) t(i)),
steps as (
  select name, hex(encode(name)) h, 0::bigint p, 4294967295::bigint c from names
  union all
  select name, h, p + 1, xor(c >> 8, v) from steps join bits on i = xor(c, ('0x' || substr(h, 2 * p + 1, 2))::bigint) & 255 where 2 * p < length(h)),
crc as (select name, xor(c, 4294967295) c from steps where 2 * p = length(h))"""
OP12 = f"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') w from documents),
b as (select regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') w from benchmark),
f as (select doc_id, array_to_string(w[i:i + k - 1], ' ') name, count(*) n from d, unnest([1, 2, 3]) u(k), unnest(range(1, len(w) - k + 2)) t(i) group by all),
g as (select array_to_string(w[i:i + k - 1], ' ') name, count(*) n from b, unnest([1, 2, 3]) u(k), unnest(range(1, len(w) - k + 2)) t(i) group by all),
names as (select name from f union select name from g),
{_CRC},
s as (select c % 10000 b, sum(n) n from f join crc using (name) group by 1),
t as (select c % 10000 b, sum(n) n from g join crc using (name) group by 1),
sums as (select coalesce((select sum(n) from s), 0)::double + 10000 so, coalesce((select sum(n) from t), 0)::double + 10000 ta),
gain as (select r.b, floor(1000 * ln((coalesce(t.n, 0) + 1)::double * so / ((coalesce(s.n, 0) + 1)::double * ta)))::bigint gain
  from range(10000) r(b) left join s using (b) left join t using (b), sums),
w as (select doc_id, sum(n)::bigint n_features, sum(n * gain)::bigint weight from f join crc using (name) join gain on b = c % 10000 group by doc_id),
scored as (select d.doc_id, len(d.w) n_words, coalesce(n_features, 0) n_features, coalesce(weight, 0) weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || d.doc_id), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint score
  from d left join w using (doc_id)),
placed as (select doc_id, row_number() over (order by score desc, doc_id) place from scored where n_words >= 20)
select doc_id, n_features, weight, score, case when place <= (select count(*) from placed) * 5 // 100 then place end rank
from scored left join placed using (doc_id)
"""
OP11 = f"""
with recursive r as (
  select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) run from documents),
u as (select doc_id, run, count(*) n, doc_id || ':' || run name from r group by all),
names as (select name from u),
{_CRC},
v as (select case when c % 97 = 0 then substr(run, 1, c % length(run)) || substr(run, c % length(run) + 2) else run end word, n from u join crc using (name)),
vocab as (select word, sum(n)::bigint n from v where length(word) >= 5 group by word having sum(n) >= 3),
shapes as (
  select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) shape, true cut from vocab, unnest(range(1, length(word) + 1)) t(i)
  union all select word, n, 0, word, false from vocab),
near as (
  select distinct a.word, b.word near, b.n near_n from shapes a join shapes b on a.shape = b.shape and a.word <> b.word
  where (a.cut <> b.cut) or (a.cut and a.i = b.i)),
best as (select word, count(*) n_near, arg_min(near, (-near_n, near)) near, max(near_n) near_n from near group by word),
judged as (select word, n, coalesce(n_near, 0)::bigint n_near, case when near_n >= 2 * n then near end form, case when near_n >= 2 * n then near_n end form_n
  from vocab left join best using (word)),
chain as (select word, word last from judged union all select c.word, j.form from chain c join judged j on j.word = c.last where j.form is not null)
select j.word, j.form, c.last root, j.n, j.n_near, j.form_n from judged j join chain c using (word) join judged e on e.word = c.last where e.form is null
"""

ORACLES = {
    "op1_warc_revisits": OP1, "op4_embedding_dedup": OP4, "op5_ngram_join": OP5, "op7_source_mixing": OP7, "op11_spelling_variants": OP11, "op12_importance_resampling": OP12,
    "op13_host_rules": OP13,
}

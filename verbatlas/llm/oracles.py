"""SQL that must give the rows of the queries, where SQL can express them.

The other operators are held against brute force in the tests: FTRL (1), Newton tilts and their rounding
(2), tree scoring (4), best fit (6), Markov models (7), chaining (10), qd whitening (11) and sums over segmentations
(13) have no form in SQL.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _classes(links: str) -> str:
    """CTEs after ``links(a, b)`` in both directions: ``root(id, root)``, the least id that can be reached."""
    return f"""
reach as (select a as id, b as other from {links} union select r.id, l.b from reach r join {links} l on l.a = r.other),
root as (select id, least(id, min(other)) as root from reach group by id)"""


ORACLES["op3_ngram_join"] = f"""
with recursive t as (select doc_id, {_WORDS} as w from documents),
g as (select distinct doc_id, md5(array_to_string(list_slice(w, i, i + 4), chr(1))) as h
      from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from t where len(w) > 0)),
s as (select doc_id, count(*) as n, md5(string_agg(h, '' order by h)) as key from g group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from g a join g b on a.h = b.h and a.doc_id <> b.doc_id group by 1, 2),
links as (select a, b from p join s x on x.doc_id = a join s y on y.doc_id = b where c >= 0.8 * (x.n + y.n - c) - 1e-9),
{_classes("links")}
select d.doc_id, coalesce(root, d.doc_id) as class_id, (select count(*) from links where a = d.doc_id) as n_links,
       coalesce(min(d.doc_id) over (partition by s.key), d.doc_id) as representative
from documents d left join root on root.id = d.doc_id left join s on s.doc_id = d.doc_id
"""
# Without shingles a document represents itself alone.
ORACLES["op3_ngram_join"] = ORACLES["op3_ngram_join"].replace("partition by s.key", "partition by coalesce(s.key, d.doc_id::varchar)")

_LENGTHS = (5, 6, 7, 8, 9, 10)
_LIMITS = (0.15, 0.14, 0.13, 0.12, 0.11, 0.10)
_CHARS = ", ".join(f"coalesce(sum(chars) filter (n = {n}), 0)::bigint as chars_{n}" for n in _LENGTHS)
_GOOD = " and ".join(f"coalesce(chars_{n}, 0) <= {limit} * word_chars" for n, limit in zip(_LENGTHS, _LIMITS, strict=True))

ORACLES["op5_repetition"] = rf"""
with t as (select doc_id, coalesce(text, '') as text, {_WORDS} as w from documents),
g as (select doc_id, n, i, count(*) over same as c, row_number() over (same order by i) as r
      from (select doc_id, n, i, md5(array_to_string(list_slice(w, i, i + n - 1), chr(1))) as h
            from (select doc_id, w, unnest(range(1, len(w) + 1)) as i from t), (values (3), (5), (6), (7), (8), (9), (10)) v(n)
            where i + n - 1 <= len(w))
      window same as (partition by doc_id, n, h)),
p as (select distinct doc_id, n, unnest(range(i, i + n)) as i from g where if(n = 3, c > 1, r > 1)),
s as (select doc_id, n, count(*) as words, sum(length(w[i])) as chars from p join t using (doc_id) group by doc_id, n),
m as (select doc_id, coalesce(sum(words) filter (n = 3), 0)::bigint as n_repeat_words, {_CHARS} from s group by doc_id),
l as (select doc_id, line, row_number() over (partition by doc_id, line) as r
      from (select doc_id, unnest(string_split(text, chr(10))) as line from t)
      where regexp_matches(line, '[^\x20\x09-\x0D]')),
k as (select doc_id, count(*) as n_dup_lines,
             sum(list_sum(list_transform(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), lambda x: length(x))))::bigint as line_chars
      from l where r > 1 group by doc_id),
b as (select doc_id, len(w)::bigint as n_words,
             coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols from t),
a as (select b.*, coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
             coalesce(line_chars, 0) as line_chars, {", ".join(f"coalesce(chars_{n}, 0) as chars_{n}" for n in _LENGTHS)}
      from b left join m using (doc_id) left join k using (doc_id))
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and line_chars <= 0.20 * word_chars and {_GOOD} as kept
from a
"""

ORACLES["op8_pigeonhole"] = f"""
with recursive v as (
    select vec_id, embedding::double[] as e from embeddings
    where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id
          where list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.95),
{_classes("links")}
select vec_id, (select count(*) from links where a = vec_id) as n_links, coalesce(root, vec_id) as component_id,
       vec_id = coalesce(root, vec_id) as kept
from embeddings left join root on id = vec_id
"""

ORACLES["op9_suffixes"] = """
with t as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
w as (select doc_id, i, md5(substr(x, 2 * i + 1, 800)) as h
      from (select doc_id, x, unnest(range(0, length(x) // 2 - 399)) as i from t where length(x) >= 800)),
r as (select doc_id, i from (select doc_id, i, count(*) over (partition by h) as c from w) where c > 1),
e as (select doc_id, i, coalesce(i > lag(i) over d + 400, true) as first from r window d as (partition by doc_id order by i)),
s as (select doc_id, min(i) as low, max(i) + 400 as high
      from (select doc_id, i, sum(first::int) over (partition by doc_id order by i) as span from e) group by doc_id, span),
o as (select doc_id, low, high, lag(high, 1, 0) over (partition by doc_id order by low) as before from s),
k as (select doc_id, string_agg(substr(x, 2 * before + 1, 2 * (low - before)), '' order by low)
                     || substr(any_value(x), 2 * max(high) + 1) as rest,
             sum(high - low)::bigint as n_removed, count(*) as n_spans,
             string_agg(low || ':' || high, ',' order by low) as spans
      from o join t using (doc_id) group by doc_id)
select doc_id, (length(x) // 2)::bigint as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(rest, x))) as kept_sha256, coalesce(spans, '') as spans
from t left join k using (doc_id)
"""

# The hash of the contract, bit by bit: a byte and seven zeros for every character of the id.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::ubigint, flatten(list_transform(range(1, length((doc_id::varchar)) + 1),
        lambda k: [ascii((doc_id::varchar)[k])::ubigint, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, b: case when xor(c, b) % 2 = 1 then xor(xor(c, b) // 2, 3988292384::ubigint) else xor(c, b) // 2 end),
    4294967295::ubigint)::bigint"""

ORACLES["op12_periods"] = rf"""
with t as (select doc_id, {_WORDS} as w, len(w) as n, {_CRC32} as h from documents),
u as (select *, if(h % 10 = 0 and n > 0, (h // 10) % n, null) as a,
             if(h % 10 = 0 and n > 0, 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8), null) as p from t),
x as (select doc_id, n, unnest(range(n)) as i,
             unnest(if(a is null, w, list_transform(range(n), lambda k: w[1 + if(k < a, k, a + (k - a) % p)]))) as word from u),
lags as (select doc_id, l.i, r.i - l.i as q from x l join x r using (doc_id, word) where r.i - l.i between 1 and l.n // 4),
islands as (select doc_id, q, min(i) as start, count(*) + q as length
            from (select *, i - row_number() over (partition by doc_id, q order by i) as island from lags)
            group by doc_id, q, island having count(*) + q >= greatest(6, 4 * q)),
runs as (select * from islands a where not exists (select 1 from islands b where a.doc_id = b.doc_id and b.q < a.q and a.q % b.q = 0
            and b.start <= a.start and b.start + b.length >= a.start + a.length)),
gone as (select distinct doc_id, unnest(range(start + q, start + length)) as i from runs),
kept as (select x.doc_id, string_agg(word, ' ' order by x.i) as collapsed
         from x left join gone on gone.doc_id = x.doc_id and gone.i = x.i where gone.i is null group by x.doc_id),
listed as (select doc_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' order by start, q) as lines
           from runs group by doc_id),
-- Lengths and periods are far below 2**26, so different quotients differ in their first twenty digits.
best as (select * from (select *, row_number() over (partition by doc_id order by length::decimal(38, 0) * 10000000000000000 // q desc,
                                                      start, q) as place from runs) where place = 1)
select d.doc_id, coalesce(n_runs, 0) as n_runs, b.start, b.length, b.q as period, 1000 * b.length // b.q as exponent_milli,
       sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(collapsed, '')) as collapsed_sha256
from documents d left join listed l on l.doc_id = d.doc_id left join best b on b.doc_id = d.doc_id
     left join kept k on k.doc_id = d.doc_id
"""

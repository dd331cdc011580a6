"""SQL (DuckDB) with the same results, for the queries that SQL can express."""

from __future__ import annotations

WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

WARC = """
with p as (select page_id, coalesce(html, '') as html from pages),
h as (select *, sha1(html) as hex, min(page_id) over (partition by html) as first_id from p),
q as (select *, list_transform(range(8), lambda k: ('0x' || substr(hex, 1 + 5 * k, 5))::bigint) as quads from h)
select page_id, cast(octet_length(encode(html)) as bigint) as payload_bytes,
  array_to_string(list_transform(quads, lambda v:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 15) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 10) & 31) + 1, 1)
    || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 5) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v & 31) + 1, 1)), '') as payload_digest,
  case when page_id = first_id or first_id is null then 'response' else 'revisit' end as record_type,
  case when page_id = first_id or first_id is null then null else first_id end as refers_to
from q
"""

DECONTAMINATE = f"""
with d as (select row_number() over () as rn, doc_id, {WORDS} as ws from documents),
b as (select cast(item_id as varchar) as item, {WORDS} as ws from benchmark),
bl as (select item, ws, least(10, len(ws)) as n from b where len(ws) > 0),
bi as (select item, ws, n, unnest(range(1, len(ws) - n + 2)) as i from bl),
bw as (select distinct item, n, array_to_string(ws[i:i + n - 1], ' ') as w from bi),
di as (select rn, ws, n, unnest(range(1, greatest(1, len(ws) - n + 2))) as i from d, (select distinct n from bw)),
dw as (select rn, n, i, array_to_string(ws[i:i + n - 1], ' ') as w from di),
hit as (select rn, n, i, item from dw join bw using (n, w)),
covered as (select rn, count(distinct place) as n_hit from (select rn, unnest(range(i, i + n)) as place from hit) group by rn),
items as (select rn, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from hit group by rn)
select doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (rn) left join items using (rn)
"""

TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

SEARCH = f"""
with d as (select row_number() over () as rn, doc_id, {TERMS} as ws from documents),
total as (select count(*) as docs, sum(len(ws)) as tokens from d where len(ws) > 0),
q as (select row_number() over () as item, item_id, unnest(list_distinct({TERMS})) as term from (select distinct item_id, text from benchmark)),
tf as (select rn, doc_id, n, term, count(*) as tf from (select rn, doc_id, len(ws) as n, unnest(ws) as term from d)
  where term in (select term from q) group by all),
weight as (select term, cast(floor(1000 * ln(cast(2 * any_value(docs) + 2 as double) / (2 * count(*) + 1))) as bigint) as w from tf, total group by term),
impact as (select rn, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // tokens))) as impact from tf join weight using (term), total),
scored as (select item, item_id, rn, doc_id, cast(sum(impact) as bigint) as score from q join impact using (term) group by all having sum(impact) > 0)
select item_id, cast(rank as integer) as rank, doc_id, score
from (select *, row_number() over (partition by item order by score desc, doc_id) as rank from scored) where rank <= 50
"""


def _codebook_rounds(rounds: int) -> str:
    """``rounds`` times: assign all parts (a0, a1, ...) and move the entries (c1, c2, ...)."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
a{k} as materialized (select rn, part, any_value(v) as v, arg_min(entry, (d, entry)) as entry, min(d) as d from (
  select rn, p.part, p.v, entry, list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as d
  from p join c{k} c on c.part = p.part) group by rn, part)""")
        if k < rounds:
            steps.append(f"""
s{k} as (select part, entry, i, cast(sum(v[i]) as bigint) as s, count(*) as n from a{k}, (select unnest(range(1, w + 1)) as i from width) group by part, entry, i),
n{k} as (select part, entry, list((s - ((s % n) + n) % n) // n order by i) as v from s{k} group by part, entry),
c{k + 1} as materialized (select part, entry, coalesce(n{k}.v, c{k}.v) as v from c{k} left join n{k} using (part, entry))""")
    return ",".join(steps)


CODES = f"""
with k as materialized (select row_number() over (order by vec_id, embedding) as rn, vec_id, label,
    list_transform(embedding, lambda x: cast(floor(4096 * cast(x as double)) as bigint)) as v
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
width as (select len(v) // 8 as w from k where rn = 1),
p as materialized (select rn, part, v[part * w + 1 : part * w + w] as v from k, width, (select unnest(range(8)) as part)),
c0 as materialized (select part, rn - 1 as entry, v from p where rn <= 16),
{_codebook_rounds(6)},
coded as (select rn, string_agg(printf('%02x', entry), '' order by part) as code, cast(sum(d) as bigint) as error from a6 group by rn),
books as (select sha256(string_agg(array_to_string(v, ','), ',' order by part, entry)) as codebooks_sha256 from c6)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from k join coded using (rn), books
"""

SQL = {"op3_warc": WARC, "op7_decontaminate": DECONTAMINATE, "op11_vector_codes": CODES, "op12_lexical_search": SEARCH}

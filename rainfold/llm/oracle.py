"""DuckDB statements for the training-data queries that SQL can express on whole tables."""

_STRIP = r"'^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$'"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LINE_DEDUP = f"""
with split as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place
  from documents
), keyed as (
  select doc_id, place, line,
         translate(regexp_replace(line, {_STRIP}, '', 'g'), '{_UPPER}', '{_LOWER}') as key
  from split
), repeated as (
  select key, max(doc_id) as survivor from keyed where length(key) >= 40
  group by key having count(distinct doc_id) >= 5
), decided as (
  select k.doc_id, k.place, k.line, r.key is null or k.doc_id = r.survivor as keep
  from keyed k left join repeated r on k.key = r.key
)
select doc_id, count(*) as n_lines, count(*) filter (where not keep) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by place) filter (where keep), ''))
         as kept_sha256
from decided group by doc_id
"""

WARC = """
with rows as (
  select page_id, sha256(coalesce(html, '')) as payload_digest,
         cast(octet_length(encode(coalesce(html, ''))) as bigint) as payload_bytes
  from pages
), firsts as (
  select payload_digest, min(page_id) as first from rows where payload_bytes >= 100 group by all
)
select page_id, payload_bytes, payload_digest,
       case when page_id > first then 'revisit' else 'response' end as record_type,
       case when page_id > first then first end as refers_to
from rows left join firsts using (payload_digest)
"""

# The format is one header for each run of a role, a separator between its turns and one end.
CHAT = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -1, unnest([0, 1]), unnest(['user', 'assistant']), '<|im_end|><|im_start|>assistant ok'
), placed as (
  select *, lag(role) over (partition by conv_id order by turn, role, text) is distinct from role
              as opens,
         length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) as written
  from rows
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text))
         as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint)
         as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text)
         filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(written + case when opens then 12 + length(role) + 1 + 11 else 10 end) as bigint)
         as formatted_chars
from placed group by conv_id
"""

TOP_K = """
with whole as (
  select row_number() over () as row, vec_id,
         list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.row, q.vec_id as query_id, x.vec_id,
         cast(list_sum(list_transform(list_zip(q.v, x.v), lambda p: p[1] * p[2])) as bigint) as score
  from whole q join whole x on x.row <> q.row
  where q.vec_id % 50 = 0
)
select query_id, rank, vec_id, score from (
  select *, cast(row_number() over (partition by row order by score desc, vec_id) as integer)
              as rank
  from scored
) where rank <= 5
"""

HARD_NEGATIVES = """
with whole as (
  select row_number() over () as row, vec_id,
         case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.row as anchor, a.vec_id as anchor_id, x.row, x.vec_id, x.label = a.label as same,
         coalesce(cast(list_sum(list_transform(list_zip(a.v, x.v), lambda p: p[1] * p[2]))
           as bigint), 0) as score
  from whole a join whole x on x.row <> a.row where a.vec_id % 100 = 0
), positives as (
  select *, row_number() over (partition by anchor order by score desc, vec_id) as place
  from scored where same
), ranked as (
  select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id,
         p.score as positive_score, n.score as negative_score,
         cast(row_number() over (partition by p.anchor, p.row order by n.score desc, n.vec_id)
           as integer) as rank
  from positives p join scored n on n.anchor = p.anchor and not n.same
    and 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score
  where p.place <= 5
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score
from ranked where rank <= 5
"""

_TERMS = (
    r"regexp_extract_all(coalesce(text, ''),"
    r" '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

RANKED = f"""
with documents_terms as (
  select row_number() over () as row, doc_id, {_TERMS} as terms from documents
), held as (
  select row, doc_id, cast(len(terms) as bigint) as n, terms from documents_terms
  where len(terms) > 0
), totals as (
  select count(*) as docs, cast(sum(n) as bigint) as length from held
), counted as (
  select row, translate(term, '{_UPPER}', '{_LOWER}') as term, count(*) as tf
  from (select row, unnest(terms) as term from held) group by all
), weights as (
  select term, cast(floor(1000 * ln(cast(2 * any_value(docs) + 2 as double)
           / cast(2 * count(*) + 1 as double))) as bigint) as w
  from counted, totals group by term
), asked as (
  select distinct item_id, translate(unnest({_TERMS}), '{_UPPER}', '{_LOWER}') as term
  from benchmark
), scored as (
  select item_id, row, any_value(doc_id) as doc_id, cast(sum(w * ((1000000000 * tf)
           // (1000 * tf + 8 * (10 + (90 * n * docs) // length)))) as bigint) as score
  from asked join counted using (term) join weights using (term) join held using (row), totals
  group by item_id, row
)
select item_id, rank, doc_id, score from (
  select *, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer)
              as rank
  from scored where score > 0
) where rank <= 10
"""

ORACLE_SQL = {
    "op2_line_dedup": LINE_DEDUP,
    "op4_warc": WARC,
    "op5_chat": CHAT,
    "op7_top_k": TOP_K,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op13_ranked_search": RANKED,
}

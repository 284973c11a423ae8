"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# Base32 of a SHA-1: 40 hex digits are 8 groups of 20 bits, each 4 letters.
ORACLES["op9_warc_archives"] = """
with rows as (
  select page_id, coalesce(html, '') as html from pages
), sized as (
  select page_id, strlen(html) as payload_bytes, sha1(html) as hex from rows
), spelled as (
  select page_id, payload_bytes, hex,
    list_aggregate(list_transform(range(32), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((
        ('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)),
      'string_agg', '') as payload_digest
  from sized
), firsts as (
  select hex, min(page_id) as first from sized group by hex
)
select page_id, payload_bytes, payload_digest,
  case when page_id is not distinct from first then 'response' else 'revisit' end as record_type,
  case when page_id is not distinct from first then null else first end as refers_to
from spelled join firsts using (hex)
"""

# Every five-word shingle of every document, shared shingles counted per pair, then reachability.
ORACLES["op1_odd_sketch_near_duplicates"] = r"""
with recursive texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words
  from documents
), shingles as (
  select distinct doc_id, list_aggregate(words[i : i + 4], 'string_agg', ' ') as shingle
  from (select doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as i
        from texts where len(words) > 0)
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2
), links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * shared.n >= 75 * (x.n + y.n - shared.n)
), both_ways as (
  select a, b from links union all select b, a from links
), reach as (
  select doc_id as a, doc_id as b from texts
  union
  select reach.a, both_ways.b from reach join both_ways on reach.b = both_ways.a
), component as (
  select a as doc_id, min(b) as component_id from reach group by a
)
select doc_id, coalesce(n, 0)::BIGINT as n_shingles, component_id, doc_id = component_id as kept
from component left join sizes using (doc_id)
"""

ORACLES["op2_phrase_automata"] = r"""
with texts as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), windows as (
  select doc_id, i, list_aggregate(words[i : i + 34], 'string_agg', ' ') as phrase
  from (select doc_id, words, unnest(range(1, len(words) - 33)) as i from texts where len(words) >= 35)
), recurring as (
  select phrase from windows group by phrase having count(*) > 1
), gone as (
  select distinct doc_id, unnest(range(i, i + 35)) as pos
  from windows where phrase in (select phrase from recurring)
), places as (
  select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as pos from texts
), kept as (
  select places.doc_id, string_agg(word, ' ' order by pos) filter (gone.pos is null) as text,
    count(gone.pos) as n_removed
  from places left join gone using (doc_id, pos) group by places.doc_id
)
select doc_id, len(words)::BIGINT as n_words, coalesce(n_removed, 0)::BIGINT as n_removed,
  sha256(coalesce(kept.text, '')) as kept_sha256
from texts left join kept using (doc_id)
"""

ORACLES["op5_prefix_filtered_decontamination"] = r"""
with texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from documents
), items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from benchmark
), windows as (
  select distinct item_id, least(len(words), 13) as size,
    list_aggregate(words[i : i + least(len(words), 13) - 1], 'string_agg', ' ') as phrase
  from (select item_id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) as i
        from items where len(words) > 0)
), places as (
  select doc_id, size, i, list_aggregate(words[i : i + size - 1], 'string_agg', ' ') as phrase
  from (select doc_id, words, size, unnest(range(1, len(words) - size + 2)) as i
        from texts, (select distinct size from windows) where len(words) >= size)
), hits as (
  select doc_id, item_id, i, size from places join windows using (size, phrase)
), covered as (
  select doc_id, count(distinct pos) as n_hit
  from (select doc_id, unnest(range(i, i + size)) as pos from hits) group by doc_id
), named as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct doc_id, item_id::VARCHAR as item from hits) group by doc_id
)
select doc_id, len(words)::BIGINT as n_words, coalesce(n_hit, 0)::BIGINT as n_hit,
  coalesce(n_items, 0)::BIGINT as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words) as contaminated
from texts left join covered using (doc_id) left join named using (doc_id)
"""

# Hex digits stand for bytes: two a byte. Each document's strings are distinct by position.
ORACLES["op4_deep_shallow_suffixes"] = r"""
with texts as (
  select doc_id, hex(encode(coalesce(text, ''))) as digits, strlen(coalesce(text, '')) as n_bytes
  from documents
), strings as (
  select doc_id, i, md5_number(substr(digits, 2 * i + 1, 100)) as string
  from (select doc_id, digits, unnest(range(n_bytes - 49)) as i from texts where n_bytes >= 50)
), firsts as (
  select string, min(doc_id) as first from strings group by string having min(doc_id) < max(doc_id)
), starts as (
  select doc_id, i from strings join firsts using (string) where doc_id > first
), runs as (
  select doc_id, i, i > 50 + coalesce(lag(i) over (partition by doc_id order by i), -100) as new from starts
), numbered as (
  select doc_id, i, sum(new::INT) over (partition by doc_id order by i) as run from runs
), spans as (
  select doc_id, run, min(i) as lo, max(i) + 50 as hi from numbered group by doc_id, run
), edges as (
  select doc_id, lo, hi, lead(lo) over (partition by doc_id order by lo) as next_lo from spans
), kept as (
  select doc_id, sum(hi - lo) as n_removed, count(*) as n_spans,
    string_agg(substr(digits, 2 * hi + 1, 2 * (coalesce(next_lo, n_bytes) - hi)), '' order by lo) as tail,
    substr(any_value(digits), 1, 2 * min(lo)) as head
  from edges join texts using (doc_id) group by doc_id
)
select doc_id, n_bytes::BIGINT as n_bytes, coalesce(n_removed, 0)::BIGINT as n_removed,
  coalesce(n_spans, 0)::BIGINT as n_spans,
  sha256(unhex(coalesce(head || tail, digits))) as kept_sha256
from texts left join kept using (doc_id)
"""

ORACLES["op12_hilbert_block_negatives"] = """
with vectors as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, r.vec_id, r.label = a.label as own,
    list_dot_product(a.v, r.v)::BIGINT as score
  from vectors a join vectors r on r.vec_id <> a.vec_id
  where a.vec_id % 100 = 0
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score
  from scored where own
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id,
  row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::INT as rank,
  vec_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not own and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) <= 10
"""

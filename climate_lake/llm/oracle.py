"""SQL counterparts of the corpus queries that SQL can express."""

from __future__ import annotations

FILL_MIDDLE = """
with drawn as (
  select doc_id, coalesce(text, '') as text,
         sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents
), cut as (
  select doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') as units,
         cast('0x' || substr(h, 1, 8) as bigint) as h1, cast('0x' || substr(h, 9, 8) as bigint) as h2,
         cast('0x' || substr(h, 17, 8) as bigint) as h3, cast('0x' || substr(h, 25, 8) as bigint) as h4
  from drawn
), counted as (
  select *, cast(len(units) as bigint) as n,
         least(h1 % (len(units) + 1), h2 % (len(units) + 1)) as a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) as b,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
                   or h3 % 100 >= 90 then 'plain'
              when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from cut
), parted as (
  select *, array_to_string(units[1:a], '') as prefix, array_to_string(units[a + 1:b], '') as middle,
         array_to_string(units[b + 1:], '') as suffix
  from counted
)
select doc_id, n, form, case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
       case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
       sha256(case form when 'plain' then text
                        when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from parted
"""

RANKED_SEARCH = r"""
with lowered as (
  select doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents
), words as (
  select doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from lowered
), held as (
  select doc_id, term, count(*) as tf from words group by doc_id, term
), sizes as (
  select doc_id, cast(sum(tf) as bigint) as n from held group by doc_id
), everything as (
  select count(*) as docs, cast(sum(n) as bigint) as terms from sizes
), frequency as (
  select term, count(*) as df from held group by term
), weighed as (
  select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) as bigint) as w from frequency, everything
), measured as (
  select doc_id, 100 - 90 + (90 * n * docs) // terms as m from sizes, everything
), item_terms as (
  select distinct item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark
), scored as (
  select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
  from item_terms join held using (term) join weighed using (term) join measured using (doc_id)
  group by item_id, doc_id
), ranked as (
  select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank, doc_id, score
  from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""

ORACLES = {
    "op11_fill_middle": FILL_MIDDLE,
    "op13_ranked_search": RANKED_SEARCH,
}

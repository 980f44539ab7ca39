"""SQL for DuckDB equal to the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op5_source_mix"] = r"""
with docs as (
    select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
           md5(coalesce(doc_id::varchar, 'null') || ':5') as place
    from documents
), sources as (
    select source, sum(size)::bigint as source_size,
           [5, 2, 1][1 + ((row_number() over (order by source nulls last) - 1) % 3)::int] as weight
    from docs group by source
), levels as (
    select *, sum(source_size) over () as total,
           coalesce(sum(3 * source_size) over before, 0) as capped,
           sum(weight) over (rows between unbounded preceding and unbounded following)
               - coalesce(sum(weight) over before, 0) as free
    from sources where source_size > 0
    window before as (order by 3.0 * source_size / weight, source rows between unbounded preceding and 1 preceding)
), level as (
    select min_by((total - capped)::double / free, capped) as level
    from levels where (total - capped) * weight <= 3 * source_size * free
), targets as (
    select source, source_size, least(3.0::double * source_size, level * weight)::double as target
    from sources, level where source_size > 0
    union all select source, source_size, 0.0::double from sources where source_size = 0
), epochs as (
    select *, case when source_size = 0 then 0 else floor(target)::bigint // source_size end as whole,
           case when source_size = 0 then 0 else floor(target)::bigint % source_size end as rest
    from targets
), placed as (
    select docs.*, coalesce(sum(size) over (partition by source order by place
               range between unbounded preceding and current row), 0)
               - sum(size) over (partition by source, place) as before,
           sum(size) over (partition by source, place) as together
    from docs
)
select doc_id, size, source_size, target,
       (whole * size + case when before >= rest then 0 when before + together < rest then size
            else floor(size::hugeint * (rest - before) / together) end)::bigint as taken
from placed join epochs on placed.source is not distinct from epochs.source
"""

ORACLES["op6_substring_dedup"] = r"""
with words as (
    select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
    from documents
), windows as (
    select r, i, array_to_string(w[i:i + 34], ' ') as content
    from words, unnest(generate_series(1, len(w) - 34)) as u(i)
), again as (
    select r, i from windows where content in (select content from windows group by content having count(*) > 1)
), gone as (
    select distinct r, i + k as p from again, unnest(generate_series(0, 34)) as u(k)
), places as (
    select r, p, w[p] as word from words, unnest(generate_series(1, len(w))) as u(p)
), kept as (
    select r, count(*) as n, string_agg(word, ' ' order by p) as t
    from places anti join gone using (r, p) group by r
)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed,
       sha256(coalesce(t, '')) as kept_sha256
from words left join kept using (r)
"""

ORACLES["op9_vector_groups"] = r"""
with recursive usable as (
    select vec_id, label, embedding::double[] as v from embeddings
    where label is not null and embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
    select a.vec_id as a, b.vec_id as b from usable a join usable b
        on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
    where list_cosine_similarity(a.v, b.v) >= 0.98
), reach(a, b) as (
    select vec_id, vec_id from embeddings
    union
    select reach.a, links.b from reach join links on reach.b = links.a
), lowest as (select a, min(b) as component_id from reach group by a
), counted as (select a, count(*) as n from links group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from embeddings join lowest on vec_id = lowest.a left join counted on vec_id = counted.a
"""

ORACLES["op11_reversed_search"] = r"""
with texts as (
    select row_number() over () as r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t
    from documents
), items as (
    select row_number() over () as k, item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t
    from benchmark
), totals as (
    select count(*)::bigint as n_docs, sum(len(t))::bigint as n_terms from texts where len(t) > 0
), counts as (
    select r, doc_id, len(t)::bigint as n, term, count(*)::bigint as tf
    from texts, unnest(t) as u(term) group by all
), weights as (
    select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
    from counts, totals group by term, n_docs
), wanted as (
    select k, item_id, term, count(*)::bigint as times from items, unnest(t) as u(term) group by all
), scored as (
    select k, item_id, doc_id, r,
           sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::bigint as score
    from wanted join weights using (term) join counts using (term), totals group by all
), placed as (
    select *, row_number() over (partition by k order by score desc, doc_id nulls last) as place
    from scored where score > 0
)
select item_id, place::int as rank, doc_id, score from placed where place <= 10
"""

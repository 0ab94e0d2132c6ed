"""The SQL of those queries whose results SQL can state over whole tables, for DuckDB."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPLICATES = rf"""
with recursive words as (
  select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents
), sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) = 1 then [w[1]]
    else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end as s
  from words
), shingles as (
  select doc_id, len(s) as n, unnest(s) as x from sets
), links as (
  select a.doc_id as a, b.doc_id as b
  from shingles a join shingles b on a.x = b.x and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id
  having 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
), edges as (
  select a, b from links union all select b, a from links
), reach(a, b) as (
  select doc_id, doc_id from sets
  union
  select r.a, e.b from reach r join edges e on r.b = e.a
), component as (
  select a as doc_id, min(b) as component_id from reach group by a
)
select doc_id, len(s)::bigint as n_shingles, component_id, doc_id = component_id as kept
from sets join component using (doc_id)
"""

DECONTAMINATION = rf"""
with words as (
  select doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), items as (
  select item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), patterns as (
  select distinct item_id, least(10, len(w)) as n,
    unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2), lambda i: array_to_string(w[i : i + least(10, len(w)) - 1], ' '))) as p
  from items where len(w) > 0
), windows as (
  select doc_id, n, unnest(range(1, len(w) - n + 2)) as i, w
  from words join (select distinct n from patterns) on len(w) >= n
), found as (
  select doc_id, i, x.n, item_id
  from (select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') as p from windows) x join patterns using (n, p)
), hits as (
  select doc_id, count(*) as n_hit
  from (select distinct doc_id, unnest(range(i, i + n)) as k from found) group by doc_id
), held as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item_id::varchar as item from found) group by doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join hits using (doc_id) left join held using (doc_id)
"""

SUBSTRING_DEDUP = r"""
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), windows as (
  select doc_id, i, array_to_string(w[i : i + 19], ' ') as p
  from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from words)
), later as (
  select doc_id, i from (select doc_id, i, row_number() over (partition by p order by doc_id, i) as k from windows) where k > 1
), gone as (
  select distinct doc_id, unnest(range(i, i + 20)) as i from later
), kept as (
  select doc_id, count(*) as n, string_agg(word, ' ' order by i) as t
  from (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from words) anti join gone using (doc_id, i)
  group by doc_id
)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from words left join kept using (doc_id)
"""

SUFFIX_DEDUP = """
with texts as (
  select doc_id, encode(coalesce(text, '')) as b from documents
), windows as (
  select doc_id, s, row_number() over (partition by b[s + 1 : s + 100] order by doc_id, s) as nth
  from (select doc_id, b, unnest(range(0, greatest(octet_length(b) - 99, 0))) as s from texts)
), later as (
  select doc_id, s, lag(s) over (partition by doc_id order by s) as previous from windows where nth > 1
), marked as (
  select doc_id, s, sum(case when previous is null or s > previous + 100 then 1 else 0 end) over (partition by doc_id order by s) as run from later
), runs as (
  select doc_id, min(s) as lo, max(s) + 100 as hi from marked group by doc_id, run
), gaps as (
  select doc_id, hi as lo, lead(lo) over (partition by doc_id order by lo) as hi from runs
  union all
  select doc_id, 0, min(lo) from runs group by doc_id
), parts as (
  select g.doc_id, g.lo, hex(b[g.lo + 1 : coalesce(g.hi, octet_length(b))]) as part from gaps g join texts using (doc_id)
), kept as (
  select doc_id, string_agg(part, '' order by lo) as bytes from parts group by doc_id
), cut as (
  select doc_id, sum(hi - lo) as n_removed, count(*) as n_spans from runs group by doc_id
)
select doc_id, octet_length(b)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  sha256(case when bytes is null then b else unhex(bytes) end) as kept_sha256
from texts left join cut using (doc_id) left join kept using (doc_id)
"""


def _framed(column: str) -> str:
    return f"case when {column} is null then '-' else octet_length(encode({column}::varchar))::varchar || ':' || {column}::varchar end"


_LEAF = " || ".join(map(_framed, ("doc_id", "source", "lang", "n_chars", "text")))
_TAMPERED = _LEAF.replace("text", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

#: crc32 bit by bit, then both trees level by level; a path has the siblings of one row on all levels.
MERKLE_MANIFEST = f"""
with recursive crc(doc_id, k, c) as (
  select doc_id, 0, 4294967295::bigint from documents
  union all
  select doc_id, k + 1, case when k % 9 = 0 then xor(c, ascii(substr(doc_id::varchar, k // 9 + 1, 1))::bigint)
    when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end
  from crc where k < 9 * length(doc_id::varchar)
), sums as (
  select doc_id, xor(max_by(c, k), 4294967295) as crc from crc group by doc_id
), leaves as (
  select doc_id, source, row_number() over (partition by source order by doc_id) - 1 as place, count(*) over (partition by source) as n,
    sha256({_LEAF}) as leaf, case when crc % 5 = 0 then sha256({_TAMPERED}) else sha256({_LEAF}) end as shown
  from documents left join sums using (doc_id)
), nodes(source, level, place, n, h) as (
  select source, 0, place, n, leaf from leaves
  union all
  select source, level + 1, place // 16, (n + 15) // 16, sha256(string_agg(h, '' order by place)) from nodes where n > 1 group by source, level, place // 16, n
), tops as (
  select source, h as subroot, row_number() over (order by source nulls first) - 1 as place, count(*) over () as n from nodes where n = 1
), upper(level, place, n, h) as (
  select 0, place, n, subroot from tops
  union all
  select level + 1, place // 16, (n + 15) // 16, sha256(string_agg(h, '' order by place)) from upper where n > 1 group by level, place // 16, n
), steps as (
  select doc_id, d.level, string_agg(h, '' order by d.place) filter (d.place < l.place // (16 ** d.level)::bigint) as before, string_agg(h, '' order by d.place) filter (d.place > l.place // (16 ** d.level)::bigint) as after
  from leaves l join nodes d on d.source is not distinct from l.source and d.n > 1 and d.place // 16 = l.place // (16 ** (d.level + 1))::bigint
  group by doc_id, d.level
  union all
  select doc_id, 1000 + u.level, string_agg(h, '' order by u.place) filter (u.place < t.place // (16 ** u.level)::bigint), string_agg(h, '' order by u.place) filter (u.place > t.place // (16 ** u.level)::bigint)
  from leaves l join tops t on t.source is not distinct from l.source join upper u on u.n > 1 and u.place // 16 = t.place // (16 ** (u.level + 1))::bigint
  group by doc_id, u.level
), path as (
  select doc_id, row_number() over (partition by doc_id order by level) as step, coalesce(before, '') as before, coalesce(after, '') as after from steps
), folded(doc_id, step, h) as (
  select doc_id, 0, shown from leaves
  union all
  select f.doc_id, p.step, sha256(p.before || f.h || p.after) from folded f join path p on p.doc_id = f.doc_id and p.step = f.step + 1
), ends as (
  select doc_id, max_by(h, step) as folded_root from folded group by doc_id
), proofs as (
  select doc_id, string_agg(before || after, '' order by step) as siblings from path group by doc_id
)
select l.doc_id, leaf, subroot, r.h as root, sha256(coalesce(siblings, '')) as proof_sha256, folded_root, folded_root = r.h as verified
from leaves l join tops t on t.source is not distinct from l.source join upper r on r.n = 1 join ends using (doc_id) left join proofs using (doc_id)
"""

HARD_NEGATIVES = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, r.vec_id as other_id, a.label = r.label as same, list_inner_product(a.v, r.v)::bigint as score
  from rows a join rows r on a.vec_id % 100 = 0 and r.vec_id <> a.vec_id
), positives as (
  select anchor_id, other_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
)
select p.anchor_id, positive_id, row_number() over (partition by p.anchor_id, positive_id order by score desc, other_id) as rank,
  other_id as negative_id, positive_score, score as negative_score
from positives p join scored s on s.anchor_id = p.anchor_id and not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
qualify rank <= 5
"""

ORACLES = {
    "op5_near_duplicates": NEAR_DUPLICATES,
    "op8_decontamination": DECONTAMINATION,
    "op10_substring_dedup": SUBSTRING_DEDUP,
    "op11_suffix_dedup": SUFFIX_DEDUP,
    "op12_merkle_manifest": MERKLE_MANIFEST,
    "op13_hard_negatives": HARD_NEGATIVES,
}

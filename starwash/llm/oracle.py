"""DuckDB SQL for the corpus queries that SQL can express.

Secrets (positions of regex matches), SimHash (XXH64), tokens, the forest and the regression have no such form;
tests hold them against brute force.
"""

from __future__ import annotations

from starwash.llm.mixing import MAX_EPOCHS, SEED, WEIGHTS
from starwash.llm.substring import WINDOW as REPEATED_WORDS
from starwash.llm.suffixes import LENGTH as REPEATED_BYTES
from starwash.llm.decontaminate import BENCHMARK_WORD, WINDOW as BENCHMARK_WORDS

LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
BLANK_WORD = r"[^\x20\x09-\x0D]+"
NOTHING = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # SHA-256 of an empty text

CHATS = r"""
with turns as (
  select conv_id, list({'r': coalesce(role, 'unknown'), 't': coalesce(text, '')} order by turn) as t
  from conversations where conv_id is not null group by conv_id
), firsts as (
  select min(conv_id) as conv_id, t, len(t) as n from turns group by t
), kept as (
  select * from firsts a where not exists (
    select 1 from firsts b where b.t[1] = a.t[1] and b.n > a.n and b.t[1:a.n] = a.t
  )
)
select conv_id, cast(0 as bigint) as piece, n as n_turns,
  array_to_string(list_transform(t, lambda x: '<|' || x.r || '|>' || chr(10) || x.t || '<|end|>' || chr(10)), '') as text
from kept
"""

MIX = f"""
with sized as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '{BLANK_WORD}')), 0) as bigint) as size
  from documents
), hashed as (
  select *, cast('0x' || substr(md5('{SEED}:' || doc_id || ':' || size), 1, 3) as bigint) as bucket from sized
), sources as (
  select source, cast(sum(size) as bigint) as source_size from sized group by source
), weighed as (
  select *, cast([{', '.join(map(str, WEIGHTS))}][1 + (row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)}] as double) as weight,
    cast(source_size * {MAX_EPOCHS} as double) as cap
  from sources
), levels as (
  select *, (sum(source_size) over () - coalesce(sum(cap) over earlier, 0))
    / (sum(weight) over () - coalesce(sum(weight) over earlier, 0)) as level
  from weighed window earlier as (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding)
), goals as (
  select source, source_size, least(cap, weight * max(level) over ()) as target from levels
), parts as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end as whole from goals
), wants as (
  select *, greatest(0, target - whole * source_size) as wanted from parts
), filled as (
  select source, bucket, sum(sum(size)) over (partition by source order by bucket) as upto
  from hashed group by source, bucket
), edges as (
  select w.source, arg_min(f.bucket + 1, {{'m': abs(w.wanted - f.upto), 'b': f.bucket}}) as edge
  from wants w join filled f on w.source is not distinct from f.source
  where abs(w.wanted - f.upto) < w.wanted group by w.source
)
select h.doc_id, h.size, w.source_size, w.target,
  cast(h.size * (w.whole + case when h.bucket < coalesce(e.edge, 0) then 1 else 0 end) as bigint) as taken
from hashed h join wants w on h.source is not distinct from w.source
left join edges e on h.source is not distinct from e.source
"""

REPEATED_WORD_RUNS = f"""
with words as (
  select doc_id, coalesce(regexp_extract_all(text, '{BLANK_WORD}'), []) as w from documents
), windows as (
  select doc_id, i, array_to_string(w[i : i + {REPEATED_WORDS - 1}], ' ') as k
  from words, unnest(range(1, len(w) - {REPEATED_WORDS - 2})) as u(i)
), ranked as (
  select doc_id, i, row_number() over (partition by k order by doc_id, i) as nth from windows
), gone as (
  select distinct doc_id, i + j as p from ranked, unnest(range(0, {REPEATED_WORDS})) as v(j) where nth > 1
), places as (
  select words.doc_id, u.p, w[u.p] as word from words, unnest(range(1, len(w) + 1)) as u(p)
), texts as (
  select a.doc_id, sha256(string_agg(a.word, ' ' order by a.p)) as digest
  from places a left join gone g on a.doc_id = g.doc_id and a.p = g.p where g.p is null group by a.doc_id
), spans as (
  select g.doc_id, count(*) as removed, count(*) filter (b.p is null) as runs
  from gone g left join gone b on g.doc_id = b.doc_id and g.p = b.p + 1 group by g.doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(removed, 0) as n_removed, coalesce(runs, 0) as n_spans,
  coalesce(digest, '{NOTHING}') as kept_sha256
from words left join spans using (doc_id) left join texts using (doc_id)
"""

REPEATED_BYTE_RUNS = f"""
with texts as (
  select doc_id, hex(encode(coalesce(text, ''))) as h from documents
), windows as (
  select doc_id, i, md5(substr(h, 2 * i + 1, {2 * REPEATED_BYTES})) as k
  from texts, unnest(range(0, cast(length(h) / 2 as bigint) - {REPEATED_BYTES - 1})) as u(i)
), ranked as (
  select doc_id, i, row_number() over (partition by k order by doc_id, i) as nth from windows
), starts as (
  select doc_id, i, lag(i) over (partition by doc_id order by i) as before from ranked where nth > 1
), marked as (
  select *, sum(case when before is null or i > before + {REPEATED_BYTES} then 1 else 0 end)
    over (partition by doc_id order by i) as run
  from starts
), runs as (
  select doc_id, run, min(i) as a, max(i) + {REPEATED_BYTES} as b from marked group by doc_id, run
), gaps as (
  select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as kept_from from runs
), pieces as (
  select doc_id, count(*) as n_spans, sum(b - a) as n_removed, max(b) as last,
    string_agg(substr(h, 2 * kept_from + 1, 2 * (a - kept_from)), '' order by a) as front
  from gaps join texts using (doc_id) group by doc_id
)
select doc_id, cast(length(h) / 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(front || substr(h, 2 * last + 1), h))) as kept_sha256
from texts left join pieces using (doc_id)
"""

CONTAMINATION = f"""
with items as (
  select item_id, regexp_extract_all(translate(text, {LETTERS}), '{BENCHMARK_WORD}') as w from benchmark where text is not null
), grams as (
  select distinct cast(item_id as varchar) as item, least(len(w), {BENCHMARK_WORDS}) as n,
    array_to_string(w[i : i + {BENCHMARK_WORDS - 1}], ' ') as k
  from items, unnest(range(1, greatest(len(w) - {BENCHMARK_WORDS - 1}, 1) + 1)) as u(i) where len(w) > 0
), docs as (
  select doc_id, coalesce(regexp_extract_all(translate(text, {LETTERS}), '{BENCHMARK_WORD}'), []) as w from documents
), windows as (
  select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') as k
  from docs, (select distinct n from grams), unnest(range(1, len(w) - n + 2)) as u(i)
), hits as (
  select doc_id, i, n, item from windows join grams using (n, k)
), words as (
  select doc_id, count(distinct i + j) as n_hit from hits, unnest(range(0, n)) as v(j) group by doc_id
), found as (
  select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as digest
  from (select distinct doc_id, item from hits) group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  coalesce(digest, '{NOTHING}') as items_sha256, n_hit is not null as contaminated
from docs left join words using (doc_id) left join found using (doc_id)
"""

FINITE = "embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"

NEGATIVES = f"""
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
  from embeddings where label is not null and {FINITE}
), s as (
  select a.vec_id as anchor_id, r.vec_id as id, a.label = r.label as same,
    cast(coalesce(list_sum(list_transform(list_zip(a.e, r.e), lambda z: z[1] * z[2])), 0) as bigint) as score
  from v a, v r where a.vec_id % 100 = 0
), p as (
  select anchor_id, id as positive_id, score as positive_score from s where same and id <> anchor_id
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select anchor_id, positive_id,
  cast(row_number() over (partition by anchor_id, positive_id order by score desc, id) as integer) as rank,
  id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify rank <= 10
"""


def _lloyd(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """Every round as a common table expression: ``a`` assigns, the next ``c`` moves the centroids."""
    gap = "list_sum(list_transform(list_zip(v.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = [f"""v as (
  select row_number() over () as n, vec_id,
    list_transform(embedding, lambda x: cast(floor({scale} * cast(x as double)) as bigint)) as e
  from embeddings where len(embedding) = {dims} and {FINITE}
), c0 as materialized (
  select row_number() over (order by h nulls last, e) - 1 as c, e
  from (select sha256('{seed}:' || vec_id) as h, e from v order by h nulls last, e limit {k})
)"""]
    for t in range(rounds + 1):
        steps.append(f"""a{t} as materialized (
  select n, vec_id, v.e, c, cast({gap} as bigint) as d from v, c{t} as c
  qualify row_number() over (partition by n order by d, c) = 1
)""")
        if t < rounds:
            steps.append(f"""c{t + 1} as materialized (
  select c, coalesce(m.e, c{t}.e) as e from c{t} left join (
    select c, list(cast((s - ((s % m) + m) % m) // m as bigint) order by i) as e from (
      select c, i, sum(e[i]) as s, count(*) as m from a{t}, unnest(range(1, {dims + 1})) as u(i) group by c, i
    ) group by c
  ) m using (c)
)""")
    return f"""
with {", ".join(steps)}
select vec_id, cast(c as integer) as cluster, d as distance, cast(sum(d) over (partition by c) as bigint) as cluster_inertia,
  cast(sum(d) over () as bigint) as inertia, sha256(array_to_string(c{rounds}.e, ',')) as centroid_sha256
from a{rounds} join c{rounds} using (c)
"""


#: The article of these pages is an element of that name; SQL checks what the densities find.
MAIN_TEXT = r"""
with inner_html as (
  select page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) as h from pages
), plain as (
  select page_id, url, regexp_replace(regexp_replace(h, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') as t from inner_html
), decoded as (
  select page_id, url,
    regexp_replace(replace(replace(replace(t, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g') as t
  from plain
), spaced as (select page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) as text from decoded)
select page_id, url, text, cast(length(text) as bigint) as n_chars from spaced
"""

ORACLE: dict[str, str] = {
    "op3_chat_formatting": CHATS,
    "op4_mixing": MIX,
    "op5_suffix_array_dedup": REPEATED_BYTE_RUNS,
    "op7_substring_dedup": REPEATED_WORD_RUNS,
    "op8_benchmark_decontamination": CONTAMINATION,
    "op11_hard_negatives": NEGATIVES,
    "op12_centroid_clustering": _lloyd(),
    "op13_html_extraction": MAIN_TEXT,
}

"""SQL in DuckDB's dialect for the operators that SQL can express."""

MIXING = r"""
with sized as (
    select doc_id, source,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
        len(regexp_extract_all(coalesce(text, ''), '[!-@\[-`{-~]')) as marks,
        text is null as missing
    from documents
), weighted as (
    select doc_id, source, size,
        case when missing then 0.5e0
            else 1e0 / (1e0 + least(marks::double / greatest(size, 1), 1e0)) end as weight,
        -ln((('0x' || substr(md5('17:' || coalesce(doc_id::varchar, '')), 1, 12))::bigint::double
            + 0.5e0) / 281474976710656e0) as exponential
    from sized
), sources as (
    select source, sum(size)::bigint as source_size,
        (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight
    from weighted group by source
), levels as (
    select *, (sum(source_size) over ()
        - coalesce(sum(3 * source_size) over (order by 3 * source_size::double / weight, source
            nulls last rows between unbounded preceding and 1 preceding), 0))::double
        / sum(weight) over (order by 3 * source_size::double / weight, source nulls last
            rows between current row and unbounded following) as level
    from sources
), targets as (
    select source, source_size, least((3 * source_size)::double, weight
        * max(case when 3 * source_size::double / weight >= level then level end) over ()) as target
    from levels
), placed as (
    select w.doc_id, w.size, t.source_size, t.target,
        floor(t.target / greatest(t.source_size, 1))::bigint as epochs,
        coalesce(sum(w.size) over (partition by w.source
            order by w.exponential / w.weight, w.doc_id, w.size
            rows between unbounded preceding and 1 preceding), 0) as before
    from weighted w join targets t on w.source is not distinct from t.source
)
select doc_id, size::bigint as size, source_size, target,
    (size * (epochs + case when before + size / 2e0 <= target - epochs * source_size
        then 1 else 0 end))::bigint as taken
from placed
"""

DECONTAMINATION = r"""
with lowered as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
), items as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark
), windows as (
    select distinct item_id, least(len(w), 10) as n,
        array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as win
    from items, unnest(range(1, len(w) - least(len(w), 10) + 2)) as t(i)
    where len(w) > 0
), runs as (
    select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as win
    from lowered, (select distinct n from windows) as sizes, unnest(range(1, len(w) - n + 2)) as t(i)
), hits as (
    select doc_id, i, n, item_id from runs join windows using (n, win)
), words as (
    select doc_id, count(distinct p) as n_hit
    from (select doc_id, unnest(range(i, i + n)) as p from hits) group by doc_id
), found as (
    select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
    from (select distinct doc_id, item_id::varchar as id from hits) group by doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
    coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 as contaminated
from lowered left join words using (doc_id) left join found using (doc_id)
"""

NEAR_GROUPS = r"""
with recursive tokens as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') as w
    from documents
), shingles as (
    select distinct doc_id, array_to_string(w[i:i + 2], ' ') as s
    from tokens, unnest(range(1, greatest(len(w) - 1, 2))) as t(i) where len(w) > 0
), sizes as (
    select doc_id, count(*) as n from shingles group by doc_id
), links as (
    select x.doc_id as a, y.doc_id as b
    from shingles x join shingles y on x.s = y.s and x.doc_id <> y.doc_id
        join sizes p on p.doc_id = x.doc_id join sizes q on q.doc_id = y.doc_id
    where 100 * least(p.n, q.n) >= 85 * greatest(p.n, q.n)
    group by x.doc_id, y.doc_id, p.n, q.n
    having 100 * count(*) >= 85 * (p.n + q.n - count(*))
), reached as (
    select doc_id as a, doc_id as b from tokens
    union
    select reached.a, links.b from reached join links on reached.b = links.a
), least as (
    select a as doc_id, min(b) as component_id from reached group by a
)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id,
    doc_id = component_id as kept
from least left join sizes using (doc_id)
"""

CAPTURES = r"""
with hashed as (
    select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages
), placed as (
    select *, first_value(page_id) over same as first_id, row_number() over same as place
    from hashed window same as (partition by html order by page_id nulls last)
)
select page_id, strlen(html)::bigint as payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(hex, (5 * (i // 4) + 1)::int, 5))::bigint >> (15 - 5 * (i % 4))::int) & 31)::int
        + 1, 1)), '') as payload_digest,
    case when place = 1 then 'response' else 'revisit' end as record_type,
    case when place > 1 then first_id end as refers_to
from placed
"""

SUBSTRINGS = r"""
with docs as materialized (
    select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents
), chunks as materialized (
    select r, 1000 * c as base, substring(h, 2000 * c + 1, 2398) as part
    from docs, unnest(range(0, len(h) // 2000 + 1)) as t(c)
), starts as materialized (
    select r, base + j as i, md5(substring(part, 2 * j + 1, 400)) as s
    from chunks, unnest(range(0, least(1000, len(part) // 2 - 199))) as t(j) where len(part) >= 400
), copies as (
    select s from starts group by s having count(*) > 1
), hits as (
    select r, i, i - lag(i) over (partition by r order by i) as step from starts semi join copies using (s)
), placed as (
    select r, i, sum(case when step <= 200 then 0 else 1 end) over (partition by r order by i) as run from hits
), runs as (
    select r, min(i) as lo, max(i) + 200 as hi from placed group by r, run
), gaps as (
    select r, coalesce(lag(hi) over (partition by r order by lo), 0) as a, lo as b from runs
    union all select r, max(hi), null from runs group by r
), kept as (
    select r, string_agg(substring(h, 2 * a + 1, 2 * (coalesce(b, len(h) // 2) - a)), '' order by a) as rest
    from gaps join docs using (r) group by r
), removed as (
    select r, sum(hi - lo)::bigint as n, count(*) as spans from runs group by r
)
select doc_id, (len(h) // 2)::bigint as n_bytes, coalesce(n, 0)::bigint as n_removed,
    coalesce(spans, 0)::bigint as n_spans, sha256(unhex(coalesce(rest, h))) as kept_sha256
from docs left join removed using (r) left join kept using (r)
"""

PHRASES = r"""
with texts as (
    select coalesce(lang, 'und') as lang, translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
    from documents
), pieces as (
    select lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')),
        '[^\x20\x09]+') as w
    from texts
), totals as (
    select lang, sum(len(w))::bigint as n from pieces group by lang
), grams as (
    select lang, k, unnest(list_transform(range(1, len(w) - k + 2),
        lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase
    from pieces, unnest(range(1, 6)) as t(k) where len(w) >= k
), counts as (
    select lang, k, phrase, count(*)::bigint as f from grams group by lang, k, phrase
    having count(*) >= 100
), split as (
    select lang, k, phrase, f as a, string_split(phrase, ' ') as w from counts where k >= 2
), cuts as (
    select split.lang, phrase, a, c, array_to_string(w[1:c], ' ') as head,
        array_to_string(w[c + 1:k], ' ') as tail
    from split, unnest(range(1, 5)) as t(c) where c < k
), scores as (
    select cuts.lang, cuts.phrase, cuts.a, c, x.f as l, y.f as r, n,
        ((1000 * cuts.a::hugeint * n) // (x.f::hugeint * y.f))::bigint as score
    from cuts join counts x on x.lang = cuts.lang and x.phrase = head
        join counts y on y.lang = cuts.lang and y.phrase = tail
        join totals on totals.lang = cuts.lang
), best as (
    select * from scores qualify row_number() over (partition by lang, phrase order by score, c) = 1
), inner_phrases as (
    select lang, unnest(flatten(list_transform(range(2, k), lambda m:
        list_transform(range(1, k - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))))) as phrase, a
    from split
), longest as (
    select lang, phrase, max(a) as longer from inner_phrases group by lang, phrase
), ranked as (
    select lang, phrase, a, l, r, n, score, row_number() over (partition by lang
        order by score desc, a desc, encode(phrase)) as rank
    from best left join longest using (lang, phrase) where longer is null or 100 * longer < 100 * a
)
select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000
"""

QUERIES = {
    "op2_substring_dedup": SUBSTRINGS,
    "op5_source_mixing": MIXING,
    "op6_decontamination": DECONTAMINATION,
    "op7_near_dedup": NEAR_GROUPS,
    "op12_warc": CAPTURES,
    "op13_phrase_mining": PHRASES,
}

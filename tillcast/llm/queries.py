"""The queries of the subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from tillcast.llm.collocations import op12_collocations
from tillcast.llm.conversations import op11_conversation_repair
from tillcast.llm.decontaminate import op7_decontaminate
from tillcast.llm.language_id import op9_language_id
from tillcast.llm.lattice_lm import op3_lattice_lm
from tillcast.llm.line_dedup import op6_line_dedup
from tillcast.llm.mixing import op2_mixing
from tillcast.llm.near_duplicates import op10_jaccard_join
from tillcast.llm.personal_data import op4_personal_data
from tillcast.llm.quality_classifier import op1_quality_classifier
from tillcast.llm.quality_rules import op8_quality_rules
from tillcast.llm.secrets import op5_secret_scan
from tillcast.llm.sharding import op13_histogram_sort

QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_mixing": op2_mixing,
    "op3_lattice_lm": op3_lattice_lm,
    "op4_personal_data": op4_personal_data,
    "op5_secret_scan": op5_secret_scan,
    "op6_line_dedup": op6_line_dedup,
    "op7_decontaminate": op7_decontaminate,
    "op8_quality_rules": op8_quality_rules,
    "op9_language_id": op9_language_id,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_collocations": op12_collocations,
    "op13_histogram_sort": op13_histogram_sort,
}

#: Keys with the SQL that DuckDB runs on the same tables; queries without one are tested against brute force.
LINE_DEDUP_SQL = r"""
with lines as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place
    from documents
), keyed as (
    select doc_id, place, line,
        translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from lines
), firsts as (
    select key, min(doc_id) as first_doc from keyed where length(key) >= 10 group by key
), judged as (
    select k.doc_id, k.place, k.line, f.first_doc is null or f.first_doc = k.doc_id as kept
    from keyed k left join firsts f on f.key = k.key
)
select doc_id, count(*) as n_lines, count(*) filter (where not kept) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by place) filter (where kept), '')) as kept_sha256
from judged group by doc_id
"""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATE_SQL = rf"""
with docs as (
    select doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), items as (
    select item_id, w, least(10, len(w)) as n
    from (select item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark) where len(w) > 0
), item_windows as (
    select distinct item_id, n, array_to_string(w[k : k + n - 1], ' ') as win
    from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as k from items)
), doc_windows as (
    select doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') as win
    from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as k from docs, (select distinct n from items))
), found as materialized (
    select doc_id, d.n, k, item_id from doc_windows d join item_windows i on d.n = i.n and d.win = i.win
), hit as (
    select doc_id, count(distinct word) as n_hit from (select doc_id, unnest(range(k, k + n)) as word from found) group by doc_id
), listed as (
    select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
    from (select distinct doc_id, item_id::varchar as id from found) group by doc_id
), chained as (
    -- Windows that follow each other both in the document and in an item are one match.
    select doc_id, max(n) as longest from (
        select doc_id, item_id, k - j as diagonal, k - rank as run, count(*) + any_value(n) - 1 as n from (
            select f.doc_id, f.item_id, f.n, f.k, p.j, row_number() over (partition by f.doc_id, f.item_id, f.k - p.j order by f.k) as rank
            from found f
            join doc_windows d using (doc_id, n, k)
            join (select item_id, n, j, array_to_string(w[j : j + n - 1], ' ') as win
                  from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as j from items)) p
              on p.item_id = f.item_id and p.n = f.n and p.win = d.win)
        group by all)
    group by doc_id
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated, cast(coalesce(longest, 0) as bigint) as longest
from docs left join hit using (doc_id) left join listed using (doc_id) left join chained using (doc_id)
"""

JACCARD_SQL = rf"""
with recursive words as (
    select doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') as w from documents
), shingles as materialized (
    select distinct doc_id, array_to_string(w[k : k + 4], ' ') as s
    from (select doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) as k from words where len(w) > 0)
), sizes as (
    select doc_id, count(*) as n from shingles group by doc_id
), links as materialized (
    select a, b from (
        select x.doc_id as a, y.doc_id as b, count(*) as both_have
        from shingles x join shingles y on x.s = y.s and x.doc_id <> y.doc_id group by all)
    join sizes p on p.doc_id = a join sizes q on q.doc_id = b
    where 100 * both_have >= 80 * (p.n + q.n - both_have)
), reach as (
    select doc_id as a, doc_id as b from documents
    union
    select r.a, l.b from reach r join links l on l.a = r.b
)
select doc_id, class_id, coalesce(n_links, 0) as n_links
from (select a as doc_id, min(b) as class_id from reach group by a)
left join (select a as doc_id, count(*) as n_links from links group by a) using (doc_id)
"""

COLLOCATIONS_SQL = rf"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex({LOWER}, '[.,;:!?\x0A-\x0D]')) as piece from documents
), worded as (
    select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), phrases as (
    select lang, n, array_to_string(w[k : k + n - 1], ' ') as phrase, count(*) as f
    from (select lang, w, n, unnest(range(1, len(w) - n + 2)) as k from worded, (select unnest([1, 2, 3]) as n) where len(w) >= n)
    group by all
), totals as (
    select lang, cast(sum(f) as bigint) as n from phrases where n = 1 group by lang
), candidates as (
    select lang, n, phrase, string_split(phrase, ' ') as w, f as a from phrases where n >= 2 and f >= 10
), taken as (
    select distinct c.lang, c.phrase from candidates c
    join (select lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as phrase from candidates where n = 3) t
      on t.lang = c.lang and t.phrase = c.phrase and 100 * t.a >= 50 * c.a
), cuts as (
    select c.lang, c.phrase, c.a, k, l.f as l, r.f as r, cast(1000000 * c.a::hugeint * c.a // (l.f::hugeint * r.f) as bigint) as score
    from (select *, unnest(range(1, n)) as k from candidates anti join taken using (lang, phrase)) c
    join phrases l on l.lang = c.lang and l.phrase = array_to_string(c.w[1 : k], ' ')
    join phrases r on r.lang = c.lang and r.phrase = array_to_string(c.w[k + 1 : c.n], ' ')
), lowest as (
    select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
), ranked as (
    select lang, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank, phrase, a, l, r, score from lowest
)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""

QUERIES_SQL: dict[str, str] = {
    "op6_line_dedup": LINE_DEDUP_SQL,
    "op7_decontaminate": DECONTAMINATE_SQL,
    "op10_jaccard_join": JACCARD_SQL,
    "op12_collocations": COLLOCATIONS_SQL,
}

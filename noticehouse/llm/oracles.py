"""The same results in SQL, where SQL can express them."""

ORACLES: dict[str, str] = {
    "op3_stupid_backoff": """
with spoken as (
    select doc_id, row_number() over () as row,
           regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^ \\t\\n\\x0b\\f\\r]+') as words
    from documents
), placed as (
    select row, unnest(words) as word, generate_subscripts(words, 1) as place from spoken
), paired as (
    select row, place, word, lag(word) over (partition by row order by place) as before from placed
), singles as (
    select word, count(*) as n from paired group by word
), pairs as (
    select before, word, count(*) as n from paired where before is not null group by all having count(*) >= 2
), total as (
    select count(*) as n from paired
), scored as (
    select p.row,
           cast(round(1e6 * ln(case when p.before is null then own.n::double / total.n
                                    when pairs.n is not null then pairs.n::double / prior.n
                                    else 0.4::double * own.n / total.n end)) as bigint) as micro
    from paired p
    cross join total
    join singles own on own.word = p.word
    left join singles prior on prior.word = p.before
    left join pairs on pairs.before = p.before and pairs.word = p.word
), summed as (
    select row, count(*) as n_words, cast(sum(micro) as bigint) as micro from scored group by row
)
select doc_id, coalesce(n_words, 0) as n_words, coalesce(micro, 0) / 1e6::double as log_score,
       case when n_words > 0 then micro / 1e6::double / n_words end as per_word
from spoken left join summed using (row)
""",
    "op13_line_dedup": """
with bodies as (
    select doc_id, row_number() over () as row, string_split(coalesce(text, ''), chr(10)) as lines from documents
), placed as (
    select doc_id, row, unnest(lines) as line, generate_subscripts(lines, 1) as pos from bodies
), keyed as (
    select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from placed
), repeated as (
    select key, min(doc_id) as first from keyed where length(key) >= 10
    group by key having count(distinct doc_id) >= 2
)
select k.doc_id, count(*) as n_lines, count(*) filter (r.first < k.doc_id) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (r.first is null or r.first = k.doc_id), ''))
           as kept_sha256
from keyed k left join repeated r using (key)
group by k.row, k.doc_id
""",
}

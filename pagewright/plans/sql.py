"""SQL of the registered queries in DuckDB's dialect, written apart from the operators."""

from __future__ import annotations

_SPACE = r"[\s\x0B\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_ENDS = r"\r\n|[\n\r\x0B\f\x1c-\x1e\x{85}\x{2028}\x{2029}]"
_BREAK = "<!-- page break -->"


def _norm(x: str) -> str:
    return rf"trim(regexp_replace({x}, '{_SPACE}', ' ', 'g'))"


def _split(x: str) -> str:
    """Lines without an empty last one."""
    parts = f"string_split_regex({x}, '{_ENDS}')"
    return f"(case when list_extract({parts}, -1) = '' then list_slice({parts}, 1, len({parts}) - 1) else {parts} end)"


def _hash(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8))::bigint"


_PAGES = rf"""
raw as (
  select doc_id, source as filename, row_number() over (partition by source order by doc_id) - 1 as page_index,
         count(*) over (partition by source) as total_pages, coalesce({_split('text')}, []) as raw
  from documents
),
derived as (
  select doc_id, filename, page_index, total_pages,
         case when doc_id % 14 = 0 then list_prepend('Table of contents', l) else l end as body
  from (
    select *, case when doc_id % 7 = 0 then list_transform(raw, lambda x, i: left(x, 40) || repeat('.', (((i - 1) % 3) * 2)::int) || ' ' || i)
                   when doc_id % 7 = 1 then list_transform(raw, lambda x, i: i || '.1 ' || x) else raw end as l
    from raw
  )
),
pages as (
  select doc_id, filename, page_index, total_pages, body,
         list_filter(list_transform(body, lambda x: {_norm('x')}), lambda x: x <> '') as lines
  from derived
)"""

_TITLE = r"(?i)\b(?:table\s+of\s+contents|contents|sommaire|table\s+des\s+mati[eè]res|toc)\b"
_ELIGIBLE = r"(length(x) >= 5 and not regexp_full_match(x, '[\d\s.\-_/]+'))"
_DOTTED = r"regexp_matches(x, '^.{4,}(?:\.{2,}|…+)\s*\d{1,4}$')"
_TRAILING = r"(regexp_matches(x, '^.{4,}\s+\d{1,4}$') and regexp_matches(x, '[\p{L}\p{Nl}\p{No}]'))"
_NUMBERED = r"regexp_matches(x, '^(?:\d+(?:\.\d+)*\.?|[A-Za-z]\.|\([A-Za-z]\))\s+.+$')"
_LIKE = f"({_ELIGIBLE} and ({_DOTTED} or {_TRAILING}))"

_SCORES = rf"""{_PAGES},
counted as (
  select *, len(list_filter(lines[1:15], lambda x: regexp_matches(x, '{_TITLE}'))) > 0 as titled,
         page_index < least(25, greatest(8, floor(total_pages * 0.25))) as early,
         len(list_filter(lines, lambda x: {_ELIGIBLE})) as fits, len(list_filter(lines, lambda x: {_LIKE})) as likes,
         len(list_filter(lines, lambda x: {_ELIGIBLE} and {_DOTTED})) as dotted,
         len(list_filter(lines, lambda x: {_ELIGIBLE} and {_TRAILING})) as tails,
         len(list_filter(lines, lambda x: {_ELIGIBLE} and {_NUMBERED} and {_TRAILING})) as numbered
  from pages
),
rated as (select *, case when fits > 0 then likes / fits else 0 end as ratio from counted),
scored as (
  select *,
    (case when titled then 4 else 0 end
     + case when dotted >= 5 then 3 when dotted >= 2 then 2 when dotted = 1 then 1 else 0 end
     + case when tails >= 8 then 3 when tails >= 4 then 2 when tails >= 2 then 1 else 0 end
     + case when numbered >= 5 then 2 when numbered >= 2 then 1 else 0 end
     + case when fits >= 8 and ratio >= 0.5 then 2 when fits >= 8 and ratio >= 0.35 then 1 else 0 end
     + case when early then 1 when not titled then -2 else 0 end) as score,
    concat_ws('|', case when titled then 'toc_title:+4' end,
      case when dotted >= 5 then 'dotted_leaders>=5:+3' when dotted >= 2 then 'dotted_leaders>=2:+2' when dotted = 1 then 'dotted_leaders==1:+1' end,
      case when tails >= 8 then 'trailing_page_numbers>=8:+3' when tails >= 4 then 'trailing_page_numbers>=4:+2' when tails >= 2 then 'trailing_page_numbers>=2:+1' end,
      case when numbered >= 5 then 'section_numbered_lines>=5:+2' when numbered >= 2 then 'section_numbered_lines>=2:+1' end,
      case when fits >= 8 and ratio >= 0.5 then 'toc_like_ratio>=0.50:+2' when fits >= 8 and ratio >= 0.35 then 'toc_like_ratio>=0.35:+1' end,
      case when early then 'early_page:+1' when not titled then 'late_without_title:-2' end) as reasons
  from rated
),
manifest as (
  select *, is_toc and (score <= 6 or not titled or not early or likes < 5) as review
  from (select *, score >= 6 or (titled and likes >= 2) or (early and likes >= 8 and ratio >= 0.45) as is_toc from scored)
)"""

_MD = """
md as (
  select id, arg_max({'filename': filename, 'content': content}, {'p': parsed_at, 'f': filename}) as b
  from md_documents where content is not null group by id
),
docs as (select id, b.filename as filename, b.content as content from md)"""

_SECTIONS = """
secs as (
  select id, b.filename as filename, b.section as section, b.page_numbers as page_numbers
  from (select id, min({'filename': filename, 'section': section, 'page_numbers': page_numbers}) as b from sections group by id)
)"""

_JUDGE = """
tj as (
  select qtj_id, b.* from (
    select qtj_id, arg_min({'query': query, 'summary': summary, 'supposed_query_type': supposed_query_type, 'supposed_query_format': supposed_query_format,
                            'filenames': filenames, 'page_numbers': page_numbers}, ingested_at) as b
    from queries_to_judge group by qtj_id)
)"""

_CRITERIA = ("information_richness", "persona_relevance", "query_generation_potential", "conceptual_clarity")


def _grade(criterion: str) -> str:
    return f"({_hash('qtj_id', chr(39) + criterion + chr(39))} % 5 + 1)"


_GRADES = ", ".join(f"{_grade(c)} as g{k}" for k, c in enumerate(_CRITERIA))
_JUDGED = f"""{_JUDGE},
judged as (
  select *, {_GRADES}, (qtj_id % 11 = 0) or coalesce(len(filenames), 0) > 1 or coalesce(len(page_numbers), 0) > 1 as combined,
         len(list_distinct(coalesce(filenames, []))) > 1 as several
  from tj
),
ranked as (
  select *, least(g0, g1, g2, g3) as worst, (g0 + g1 + g2 + g3) / 4.0 as mean,
         case when not combined then 'single' when several then 'multi_document_combined' else 'same_document_combined' end as bucket
  from judged
)"""

_LISTS = f"""{_MD},
counts as (select filename, len(string_split(content, '{_BREAK}')) as n from docs),
lists as (select filename, n, range(0, n) as pages from counts)"""

_QUALITY = ", ".join(f"{_grade(c)} as q{k}" for k, c in enumerate(("relevancy", "self_sufficiency", "persona_adaptation", "query_type_following", "query_format_following")))
_GATE = f"""{_JUDGE},
gate as (
  select qtj_id, case when qtj_id % 17 = 0 then 'error'
    when q0 >= 4 and q1 >= 4 and q2 >= 4 and q3 > 1 and q4 > 1
      and not coalesce((supposed_query_type in ('multi-hop', 'enumerative') and supposed_query_format = 'keyword')
        or (supposed_query_type = 'boolean' and supposed_query_format in ('keyword', 'instruction')), false) then 'keep'
    else 'discard' end as status
  from (select *, {_QUALITY} from tj)
)"""

def _allocation(key: str, source: str) -> str:
    return f"""steps as (
  with recursive draw as (
    select {key}, 0 as step, 0 as adversarial, 0 as textual, 0 as tabular, 0 as visual, 0 as total, ['adversarial', 'textual', 'tabular', 'visual'] as open, null::varchar as pick
    from {source}
    union all
    select {key}, step + 1, adversarial + (good and choice = 'adversarial')::int, textual + (good and choice = 'textual')::int,
           tabular + (good and choice = 'tabular')::int, visual + (good and choice = 'visual')::int, total + good::int,
           case when live and full_now then list_filter(open, lambda x: x <> choice) else open end, choice
    from (
      select *, live and not full_now as good from (
        select *, total < 3 and len(open) > 0 as live,
               coalesce(case choice when 'adversarial' then adversarial >= 1 when 'textual' then textual >= 3 when 'tabular' then tabular >= 1 when 'visual' then visual >= 1 end, false) as full_now
        from (select *, open[({_hash(chr(39) + 'allocation' + chr(39), key, 'step + 1')} % greatest(len(open), 1)) + 1] as choice from draw where step < 16)))
  )
  select * from draw
),
allocated as (select {key}, adversarial, textual, tabular, visual from steps where step = 16)"""


_ALLOCATION = f"{_JUDGE},\n{_allocation('qtj_id', 'tj')}"

_MODULES = """
modules(pool, type, answerability, low, high) as (values
  ('tabular', 'extractive', 'full', 0, 2), ('tabular', 'boolean', 'full', 2, 3), ('tabular', 'boolean', 'partial', 3, 4), ('tabular', 'numerical', 'full', 4, 6),
  ('tabular', 'numerical', 'partial', 6, 8), ('tabular', 'compare-contrast', 'full', 8, 10), ('tabular', 'compare-contrast', 'partial', 10, 12), ('tabular', 'enumerative', 'partial', 12, 14),
  ('visual', 'extractive', 'full', 0, 4), ('visual', 'open-ended', 'full', 4, 10), ('visual', 'open-ended', 'partial', 10, 16), ('visual', 'boolean', 'full', 16, 18),
  ('visual', 'boolean', 'partial', 18, 20), ('visual', 'compare-contrast', 'full', 20, 22), ('visual', 'compare-contrast', 'partial', 22, 24), ('visual', 'enumerative', 'partial', 24, 26),
  ('textual', 'extractive', 'full', 0, 4), ('textual', 'open-ended', 'full', 4, 10), ('textual', 'open-ended', 'partial', 10, 16), ('textual', 'boolean', 'full', 16, 18),
  ('textual', 'boolean', 'partial', 18, 20), ('textual', 'compare-contrast', 'full', 20, 22), ('textual', 'compare-contrast', 'partial', 22, 24), ('textual', 'enumerative', 'partial', 24, 26))"""


def _drawn(key: str, source: str) -> str:
    """The modules drawn for the counts of each pool in source."""
    return f"""slots as (
  select {key}, pool, n from (select {key}, unnest(['tabular', 'visual', 'textual']) as pool, unnest([tabular, visual, textual]) as n from {source}) where n > 0
),
draws as (select {key}, pool, unnest(range(1, n + 1)) as draw from slots),
chosen as (
  select d.*, m.type, m.answerability,
    case m.type when 'enumerative' then ['question', 'instruction'] when 'multi-hop' then ['question', 'instruction'] when 'boolean' then ['question'] else ['question', 'instruction', 'keyword'] end as free
  from draws d join modules m on m.pool = d.pool and {_hash("'module'", 'd.' + key, 'd.pool', 'd.draw')} % case d.pool when 'tabular' then 14 else 26 end between m.low and m.high - 1
),
drawn as (select *, free[({_hash("'format'", key, 'pool', 'draw')} % len(free)) + 1] as format from chosen),
lines as (
  select {key}, row_number() over (partition by {key} order by pool, draw) as n,
         upper(substr(type, 1, 1)) || replace(substr(type, 2), '-', ' ') || ' query in the form of a ' || format || ', ' || answerability || 'ly answered by the ' || pool || ' content' as line
  from drawn
),
requests as (select {key}, string_agg(n || '. ' || line, chr(10) order by n) as requests from lines group by {key})"""


def _prompt(instruction: str, **shown: str) -> str:
    """The text of a prompt; shown has an expression for each part."""
    parts = [f"'{instruction}' || chr(10) || 'Reply in english with a JSON object.'"]
    return " || ".join(parts + [f"chr(10) || '{name.replace('_', ' ')}:' || chr(10) || coalesce({value}, '')" for name, value in shown.items()])


#: Whether the offline client answers a prompt with the hash d, and what it draws for a field.
_ANSWERED = "(('0x' || substr(d, 1, 8))::bigint % 29 <> 0)"


def _draw(field: str) -> str:
    return f"('0x' || substr(md5(d || '|{field}'), 1, 8))::bigint"


def _said(field: str) -> str:
    return f"'{field} ' || substr(d, 1, 8)"


_CANDIDATES = rf"""{_PAGES},
texts as (select doc_id, array_to_string(body, chr(10)) as content from pages),
cut as (select doc_id, unnest(string_split(content, '{_BREAK}')) as page, unnest(range(0, len(string_split(content, '{_BREAK}')))) as page_index from texts),
entries as (
  select doc_id, page_index, page, list_filter(list_transform(string_split(page, chr(10)), lambda x: [trim(x), trim(regexp_replace(trim(x), '[^a-z0-9]\s+', ' ', 'g'))]),
    lambda e: regexp_matches(e[2], '\d') and regexp_matches(e[2], '[a-z]') and length(e[1]) < 150) as e
  from cut
),
candidates as (
  select doc_id, page_index::bigint as page_index, page from entries
  where (page ilike '%table of contents%' or page ilike '%| page |%' or page ilike '%index%' or page ilike '%page no.%' or page ilike '%table des mati_res%')
    and len(list_filter(e, lambda x: len(regexp_extract_all(x[2], '\d+')) >= 4)) <= 5 and len(list_filter(e, lambda x: len(regexp_extract_all(x[2], '\d+')) < 4)) > 8
)"""

_TURNS = """
sizes as (select list(n order by b) as s from (select b, (select count(*) from {source} where bucket_no = b) as n from range(6) r(b))),
rounds as (
  select 0 as round, [0, 0, 0, 0, 0, 0]::bigint[] as low, list_transform(s, lambda n, i: least(n, greatest(1, {wanted} // 6 + case when i <= 3 then 20 else -20 end))) as high, s from sizes
  union all
  select round + 1, high, list_transform(s, lambda n, i: least(n, high[i] + greatest(1, ({wanted} - list_sum(high))::bigint // 6 + case when i <= 3 then 20 else -20 end))), s
  from rounds where list_sum(high) < {wanted}
),
placed as (select qtj_id, bucket_no, row_number() over (partition by bucket_no order by qtj_id) - 1 as k from {source})"""

_MEMBERS = f"""
own as (
  select i, label as c, (vec_id % 20)::varchar as d, vec_id as m, row_number() over (partition by i, label, vec_id % 20 order by {_hash("'m'", 'i', 'vec_id')}, vec_id) as rm,
         count(*) over (partition by i, label, vec_id % 20) as nd
  from embeddings, range(15) r(i)
),
heads as (
  select i, c, d, nd, row_number() over (partition by i, c order by {_hash("'d'", 'i', 'c', 'd')}, d) as rd from own where rm = 1
)"""


def _tuples(size: int) -> str:
    several = "docs >= 2" if size == 2 else "(docs >= 3 or twice is not null)"
    three = f"(docs >= 3 and ({_hash(chr(39) + 'three' + chr(39), 'i', 'c')} % 10 < 7 or twice is null))"
    multi = "rd <= 2 and rm = 1" if size == 2 else f"case when {three} then rd <= 3 and rm = 1 else rd <= 2 and (rm = 1 or (rm = 2 and rd = twice)) end"
    return f"""facts{size} as (
  select *, case when {several} and lone is not null then {_hash("'multi'", 'i', 'c')} % 1000 < 500 else {several} end as multi
  from (select i, c, count(*) as docs, min(case when nd >= {size} then rd end) as lone, min(case when rd <= 2 and nd >= 2 then rd end) as twice from heads group by i, c)
  where {several} or lone is not null
),
tuples{size} as (
  select i as iteration, c as cluster, multi, string_agg(m::varchar, ',' order by m) as members, count(distinct d) as documents
  from own join heads using (i, c, d, nd) join facts{size} using (i, c)
  where rm <= {size} and case when multi then {multi} else rd = lone end
  group by all
)"""


_NORMALIZED = (
    r"lower(regexp_replace(replace(replace(replace(replace(replace(translate({x}, 'áàâãäåçéèêëíìîïñóòôõöøúùûüýÿÁÀÂÃÄÅÇÉÈÊËÍÌÎÏÑÓÒÔÕÖØÚÙÛÜÝ', "
    r"'aaaaaaceeeeiiiinoooooouuuuyyAAAAAACEEEEIIIINOOOOOOUUUUY'), 'ß', 'ss'), 'æ', 'ae'), 'Æ', 'AE'), 'œ', 'oe'), 'Œ', 'OE'), '[\s\x0B\-]', '_', 'g'))"
)


# each dimension is a row, so that nothing is cast within the join
_NEAR = """
parts as materialized (select vec_id, unnest(embedding)::double as x, unnest(range(0, len(embedding))) as d from embeddings),
products as materialized (select a.vec_id as p, b.vec_id as q, round(sum(a.x * b.x), 9) as s from parts a join parts b on a.d = b.d and a.vec_id <> b.vec_id group by all),
kept as materialized (select p, q from products qualify row_number() over (partition by p order by s desc, q) <= 5)"""


def oracle_sql() -> dict[str, str]:
    return {
        "line_normalize": rf"""
            select doc_id, pos - 1 as pos, line from (
              select doc_id, unnest(list_transform(l, lambda x: {_norm('x')})) as line, unnest(range(1, len(l) + 1)) as pos
              from (select doc_id, {_split('text')} as l from documents where text is not null))
            where line <> ''""",
        "toc_line_features": f"""
            with {_PAGES}
            select doc_id, len(lines) as line_count, len(list_filter(lines, lambda x: {_ELIGIBLE})) as eligible,
                   len(list_filter(lines, lambda x: {_ELIGIBLE} and {_DOTTED})) as dotted, len(list_filter(lines, lambda x: {_ELIGIBLE} and {_TRAILING})) as trailing,
                   len(list_filter(lines, lambda x: {_LIKE})) as toc_like
            from pages""",
        "page_toc_score": f"""
            with {_SCORES}
            select filename, page_index, is_toc as is_toc_page, review as toc_needs_manual_review, score::bigint as toc_score, titled as toc_has_title, early as toc_is_early_page,
                   fits as toc_eligible_line_count, likes as toc_like_line_count, round_even(ratio::double, 4) as toc_like_ratio, dotted as toc_dotted_count,
                   tails as toc_trailing_page_number_count, numbered as toc_section_number_count, reasons as toc_reasons
            from manifest""",
        "page_manifest": f"""
            with {_SCORES}
            select filename, filename || '.pdf' as pdf_filename, page_index, page_index + 1 as page_number, page_index as image_page_number, is_toc as is_toc_page,
                   is_toc as exclude_from_visual_summaries, is_toc as exclude_from_image_rendering, case when is_toc then 'toc_page' else '' end as exclusion_reason,
                   substr(coalesce(array_to_string(lines, chr(10)), ''), 1, 500) as text_preview, 'ok' as parse_status, score::bigint as toc_score,
                   coalesce(array_to_string((list_filter(lines, lambda x: regexp_matches(x, '{_TITLE}') or {_LIKE}))[1:5], '|'), '') as toc_sample_lines
            from manifest""",
        "toc_document_summary": f"""
            with {_SCORES},
            own as (
              select filename, count(*) as n, list(page_index + 1 order by page_index) filter (is_toc) as t, list(page_index + 1 order by page_index) filter (review) as r
              from manifest group by filename
            )
            select filename, coalesce(n, 0) as total_pages, len(coalesce(t, [])) > 0 as toc_detected, coalesce(array_to_string(t, ','), '') as toc_pages,
                   len(coalesce(t, [])) as toc_page_count, coalesce(array_to_string(r, ','), '') as toc_manual_review_pages, len(coalesce(r, [])) as toc_manual_review_page_count,
                   'ok' as status, '' as error
            from own full join (select distinct filename from md_documents) using (filename)""",
        "excluded_pages": f"""
            with {_SCORES}
            select filename, string_agg(page_index::varchar, ',' order by page_index) as pages from manifest where is_toc group by filename""",
        "pages_kept": f"""
            with {_SCORES}
            select filename, page_index from manifest where not is_toc""",
        "toc_candidate_pages": f"""
            with {_CANDIDATES} select doc_id, page_index from candidates""",
        "contents_check": rf"""
            with {_CANDIDATES},
            asked as (select doc_id, page_index, md5({_prompt('Say whether this page is a table of contents.', page=f"replace(regexp_replace(lower(page), '{_SPACE}', ' ', 'g'), 'table of contents', '')")}) as d from candidates)
            select doc_id, page_index, {_ANSWERED} as ok, case when {_ANSWERED} then {_draw('has_table_of_contents')} % 2 = 1 end as has_table_of_contents from asked""",
        "heading_outline": rf"""
            with {_MD},
            lines as (select id, unnest(string_split(content, chr(10))) as line, unnest(range(0, len(string_split(content, chr(10))))) as pos from docs),
            run as (
              select *, 1 + sum(contains(line, '{_BREAK}')::int) over w as page,
                last_value(case when starts_with(line, '<!--<annotation kind="description">-->') then true when contains(line, '<!--<annotation/>-->') then false end ignore nulls) over w as hidden
              from lines window w as (partition by id order by pos rows unbounded preceding)
            )
            select id, pos::bigint as pos, length(regexp_extract(line, '^(#{{1,5}}) ', 1)) as level, line as title, page::bigint as page
            from run where not coalesce(hidden, false) and regexp_matches(line, '^#{{1,5}} ')""",
        "page_split_at_heading": rf"""
            with {_MD},
            pages as (select id, unnest(string_split(content, '{_BREAK}')) as page, unnest(range(0, len(string_split(content, '{_BREAK}')))) as page_index from docs),
            cuts as (
              select *, case {' '.join(f"when starts_with(regexp_replace(page, '^{chr(92)}s+', ''), '{'#' * k} ') then 0 when strpos(page, chr(10) || '{'#' * k} ') > 0 then strpos(page, chr(10) || '{'#' * k} ')" for k in range(1, 6))} else 0 end as cut
              from pages
            )
            select id, page_index::bigint as page_index, case when cut > 0 then substr(page, 1, cut - 1) else '' end as head, case when cut > 0 then substr(page, cut) else page end as tail
            from cuts""",
        "offset_mode": f"""
            with {_SECTIONS},
            offs as (select filename, id, list_max(page_numbers) - list_min(page_numbers) as "offset" from secs where len(page_numbers) > 0),
            counted as (select filename, "offset", count(*) as n, min(id) as first from offs group by all)
            select filename, "offset"::bigint as "offset" from counted qualify row_number() over (partition by filename order by n desc, first) = 1""",
        "offsets_by_rule": f"""
            with own as (select distinct source as id from documents) select id, {_hash("'shift'", 'id')} % 4 + 1 as "offset" from own""",
        "sections_by_rule": f"""
            with own as (select distinct source as id from documents),
            sized as (select id, {_hash("'shift'", 'id')} % 4 as shift, 25 + {_hash("'pages'", 'id')} % 9 as n from own),
            -- parts begin at pages shift + 1, shift + 4, ...; a section ends before the first of them that makes it five pages
            first as (select *, case shift when 1 then 5 when 2 then 6 else 7 end as stop, n + shift + 1 as total, shift + 1 + 3 * ((n - 1) // 3) as last from sized),
            ends as (select id, total, unnest(list_concat([0], range(stop, last + 1, 6))) as s, unnest(list_concat(range(stop, last + 1, 6), [total])) as e from first)
            select id, row_number() over (partition by id order by s) - 1 as ord, array_to_string(range(s, e), ',') as page_numbers from ends where e > s""",
        "titles_by_rule": f"""
            with own as (select source as id, doc_id as ord, doc_id % 7 as page, {_hash("'title'", 'doc_id')} % 5 as kind from documents where doc_id is not null)
            select id, min(ord) as ord, page from own group by id, page, kind""",
        "sliding_windows": f"""
            with {_LISTS}
            select filename, (s // 3)::bigint as "window", array_to_string(pages[s + 1 : s + 4], ',') as page_numbers
            from (select *, unnest(range(0, n, 3)) as s from lists)""",
        "tumbling_windows": f"""
            with {_LISTS}
            select filename, (s // 5)::bigint as "window", array_to_string(pages[s + 1 : s + 5], ',') as page_numbers
            from (select *, unnest(range(0, n, 5)) as s from lists)""",
        "windows_capped": f"""
            with {_LISTS},
            own as (select filename, s as "window", pages[s + 1 : s + 2] as p from (select *, unnest(range(0, n)) as s from lists) where s < 3)
            select filename, "window"::bigint as "window", array_to_string(p, ',') as page_numbers from own
            qualify row_number() over (order by filename, "window") <= 100""",
        "description_sample": f"""
            with {_LISTS} select filename, array_to_string(pages[1:3], ',') as pages from lists""",
        "corpus_stats": f"""
            with {_LISTS}, {_SECTIONS}, {_JUDGE},
            sums as (select distinct qtj_id, unnest(filenames) as filename from tj)
            select filename, n as pages, (select count(*) from secs s where s.filename = c.filename) as sections, (select count(*) from sums s where s.filename = c.filename) as summaries
            from counts c""",
        "corpus_reconcile": """
            select coalesce(l.filename, r.filename) as filename, case when l.filename is null then 'right' else 'left' end as side
            from (select distinct source as filename from documents) l full join (select distinct filename from sections where document_id is not null) r on l.filename = r.filename
            where l.filename is null or r.filename is null""",
        "page_count_mismatch": f"""
            with {_LISTS},
            right_counts as (select source as filename, max(page_number) + 1 as right_pages from documents where page_number is not null group by source)
            select filename, n as left_pages, right_pages::bigint as right_pages from counts join right_counts using (filename) where n <> right_pages""",
        "judgment_pass": f"""
            with {_JUDGED} select qtj_id, worst >= 4 as passing, bucket from ranked""",
        "judgment_mean": f"""
            with {_JUDGED} select qtj_id, mean::double as mean_grade from ranked""",
        "summary_touches_visual": f"""
            with {_JUDGE}, {_SECTIONS},
            want as (select qtj_id, f.filename as filename, unnest(p) as page from (select qtj_id, unnest(filenames) as filename, flatten(page_numbers) as p from tj) f),
            have as (select filename, unnest(page_numbers) as page from secs where contains(section, '<!--<annotation kind='))
            select qtj_id, qtj_id in (select qtj_id from want join have using (filename, page)) as visual from tj""",
        "combined_dedupe": f"""
            with {_JUDGED},
            keyed as (
              select qtj_id, array_to_string(list_transform(list_zip(filenames, page_numbers), lambda z: z[1] || '[' || coalesce(array_to_string(z[2], ','), '') || ']'), ' ') as k
              from ranked where worst >= 3 and filenames is not null
            )
            select min(qtj_id) as qtj_id from keyed group by k""",
        "priority_fill": f"""
            with {_JUDGED}
            select qtj_id, bucket, worst >= 4 as passing,
              case when worst < 4 then 'visual fallback selected summary' when bucket = 'single' then 'visual judged single summary'
                   when bucket = 'multi_document_combined' then 'visual judged multi-document combined summary' else 'visual judged same-document combined summary' end as selected_reason
            from ranked
            order by case when worst < 4 then 3 when bucket = 'multi_document_combined' then 0 when bucket = 'same_document_combined' then 1 else 2 end,
                     case when worst < 4 then -mean else 0 end, qtj_id
            limit 200""",
        "quota_round_robin": f"""
            with recursive {_JUDGE},
            own as (select qtj_id, qtj_id % 6 as bucket_no from tj), {_TURNS.format(source='own', wanted=400)}
            select qtj_id, bucket_no, round::bigint as round from placed join rounds on k >= low[bucket_no + 1] and k < high[bucket_no + 1]""",
        "balanced_selection": f"""
            with recursive {_JUDGED}, {_SECTIONS},
            want as (select qtj_id, f.filename as filename, unnest(p) as page from (select qtj_id, unnest(filenames) as filename, flatten(page_numbers) as p from tj) f),
            have as (select filename, unnest(page_numbers) as page from secs where contains(section, '<!--<annotation kind=')),
            seen as (select distinct qtj_id from want join have using (filename, page)),
            keyed as (
              select *, case when combined then array_to_string(list_transform(list_zip(filenames, page_numbers), lambda z: z[1] || '[' || coalesce(array_to_string(z[2], ','), '') || ']'), ' ') else 'single ' || qtj_id end as k
              from ranked where worst >= 2 and filenames is not null
            ),
            once as (select * from keyed qualify row_number() over (partition by k order by qtj_id) = 1),
            own as (
              select qtj_id, case when not combined then 2 when several then 0 else 1 end + case when qtj_id in (select qtj_id from seen) then 0 else 3 end as bucket_no from once
            ), {_TURNS.format(source='own', wanted=20)}
            select qtj_id, bucket_no::bigint as bucket_no, round::bigint as round,
                   'summary based on ' || ['sections from multiple documents', 'sections from a single document', 'a section from a single document'][bucket_no % 3 + 1]
                   || case when bucket_no < 3 then ' with' else ' without' end || ' visual information' as selected_reason
            from placed join rounds on k >= low[bucket_no + 1] and k < high[bucket_no + 1]""",
        "passing_count": f"""
            with {_JUDGED} select count(*) filter (worst >= 3) as passing from ranked""",
        "first_n": f"""
            with {_JUDGED} select qtj_id, combined from judged order by case when combined then 0 else 1 end, qtj_id limit 150""",
        "query_gate": f"""
            with {_GATE} select qtj_id, status from gate""",
        "query_gate_rates": f"""
            with {_GATE}
            select count(*) as queries, count(*) filter (status = 'error') as errors, count(*) filter (status = 'keep') as kept, count(*) filter (status = 'discard') as discarded,
                   (count(*) filter (status = 'keep'))::double / count(*) filter (status <> 'error') as kept_share from gate""",
        "self_answer_filter": rf"""
            with {_JUDGE} select qtj_id from tj where qtj_id % 13 <> 0 and not regexp_matches(query, '\d')""",
        "final_queries": f"""
            with {_JUDGE},
            own as (select *, qtj_id % 5 <> 0 and {_hash("'42'", 'qtj_id')} % 2 = 1 as pick from tj where query is not null)
            select qtj_id, case when pick then lower(query) else query end as query, case when pick then query end as original_query,
                   case when pick then 'rephrased' else 'original' end as generation_process from own""",
        "question_allocation": f"""
            with {_ALLOCATION} select qtj_id, adversarial::bigint as adversarial, textual::bigint as textual, tabular::bigint as tabular, visual::bigint as visual from allocated""",
        "module_sample": f"""
            with {_ALLOCATION}, {_MODULES},
            {_drawn('qtj_id', 'allocated')}
            select qtj_id, pool, draw, type, format, answerability from drawn""",
        "query_explode_qrels": f"""
            with {_JUDGE},
            pairs as (select qtj_id, unnest(list_zip(filenames, page_numbers)) as z from tj)
            select distinct qtj_id, filename, page::bigint as page from (select qtj_id, z[1] as filename, unnest(z[2]) as page from pairs) where filename is not null and page is not null""",
        "prompt_assembly": f"""
            with {_JUDGE}
            select qtj_id, 'Say whether the query holds its own answer.' || chr(10) || 'Reply in english with a JSON object.' || chr(10) || 'query:' || chr(10) || query as prompt from tj where query is not null""",
        "document_descriptions": f"""
            with {_MD}, asked as (select id, md5({_prompt('Describe in a few sentences what this document is about.', content='content')}) as d from docs)
            select id, {_ANSWERED} as ok, case when not {_ANSWERED} then 'OfflineError: chosen to fail' end as error, case when {_ANSWERED} then {_said('description')} end as description from asked""",
        "section_summaries": f"""
            with {_SECTIONS},
            asked as (select *, md5({_prompt('Summarise the section in Markdown, in fewer than 500 words.', document_description="'No description is available.'", section='section')}) as d from secs where section is not null)
            select id, filename, array_to_string(page_numbers, ',') as page_numbers, {_said('summary')} as summary from asked where {_ANSWERED}""",
        "summary_judgments": f"""
            with {_JUDGE},
            asked as (select qtj_id, md5({_prompt('Grade the summary from 1 to 5 for each criterion, for the reader described.', persona="'an engineer'", summary='summary')}) as d from tj where summary is not null),
            graded as (select qtj_id, {', '.join(f"case when {_ANSWERED} then {_draw(c)} % 5 + 1 else 1 end as {c}" for c in _CRITERIA)} from asked)
            select *, least({', '.join(_CRITERIA)}) >= 4 as passing from graded""",
        "rephrased_queries": f"""
            with {_JUDGE},
            asked as (
              select qtj_id, query, md5({_prompt('Say the query in other words; keep its type, format and meaning.', query='query', summary='summary', query_type='supposed_query_type', query_format='supposed_query_format')}) as d
              from tj where query is not null
            ),
            own as (select *, {_ANSWERED} and {_hash("'42'", 'qtj_id')} % 2 = 1 as pick from asked)
            select qtj_id, case when pick then {_said('rephrased_query')} else query end as query, case when pick then query end as original_query, case when pick then 'rephrased' else 'original' end as generation_process from own""",
        "generated_queries": f"""
            with {_JUDGE},
            own as (select distinct summary, md5(summary) as summary_id from tj where summary is not null),
            {_allocation('summary_id', 'own')}, {_MODULES}, {_drawn('summary_id', 'allocated')},
            asked as (
              select summary_id, md5({_prompt('Write one query for each request, as the reader described would.', persona="'an engineer'", summary='summary', requests='requests')}) as d
              from own join requests using (summary_id)
            )
            select summary_id, unnest([0, 1, 2])::bigint as query_no, {_said('queries')} || ' ' || unnest([0, 1, 2]) as query from asked where {_ANSWERED}""",
        "visual_descriptions": f"""
            with {_PAGES},
            asked as (select filename, least(3, count(*)) as shown, md5({_prompt('Describe the document that these page images begin.', filename='filename')}) as d from pages group by filename)
            select filename, shown, {_ANSWERED} as ok, case when {_ANSWERED} then {_said('description')} end as description from asked""",
        "page_queries": f"""
            with {_PAGES},
            own as (select filename || '/' || page_index // 5 as request_id, count(*) as pages, 1 as tabular, 1 as visual, 1 as textual from pages group by filename, page_index // 5),
            {_MODULES}, {_drawn('request_id', 'own')},
            asked as (select request_id, own.pages, md5({_prompt('Write queries that these pages answer, one for each request.', requests='requests')}) as d from own join requests using (request_id))
            select request_id, pages, unnest([0, 1, 2])::bigint as query_no, {_said('queries')} || ' ' || unnest([0, 1, 2]) as query from asked where {_ANSWERED}""",
        "text_embeddings": r"""
            with tj as (select qtj_id, arg_min({'s': summary}, ingested_at).s as summary from queries_to_judge group by qtj_id),
            lists as (select qtj_id, regexp_extract_all(lower(summary), '[\p{L}\p{N}_]+') as w from tj where summary is not null),
            units as (select qtj_id, unnest(list_concat(w, list_transform(w[2:], lambda x, i: w[i] || ' ' || x))) as unit from lists),
            hashed as (select qtj_id, ('0x' || substr(md5(unit), 1, 8))::bigint as h from units),
            sums as (select qtj_id, h // 2 % 64 as k, sum(case when h % 2 = 1 then 1 else -1 end) as x from hashed group by all),
            normed as (select qtj_id, k, x / sqrt(sum(x * x) over (partition by qtj_id)) as x from sums)
            select qtj_id, k::bigint as k, round(x::float::double * 1e4)::bigint as parts from normed where x <> 0""",
        "vectors_projected": """
            with parts as (select vec_id, unnest(embedding)::double as x, unnest(range(0, len(embedding))) as i from embeddings),
            signs as (select i, k, ('0x' || substr(md5('0|' || i || '|' || k), 1, 8))::bigint % 2 * 2 - 1 as s from range(64) a(i), range(8) b(k))
            select vec_id, k::bigint as k, round(sum(x * s) / sqrt(8) * 1e6)::bigint as micro from parts join signs using (i) group by vec_id, k""",
        "event_stamps": """
            select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as stamp, case event_type when 'click' then 'pressed' when 'view' then 'seen' else 'other' end as label,
                   event_type || ',-,-,-' as kinds, sha256(coalesce(props, '')) as hash from events""",
        "usage_log": """
            select 'model' as model_name, 'batch' as batch_description, count(*) as call_count, sum(event_id % 500)::bigint as input_tokens, sum(greatest(event_id % 300 - 5, 0))::bigint as output_tokens,
                   sum(event_id % 800)::bigint as total_tokens, 4::bigint as max_concurrency from events""",
        "mutual_knn": f"""
            with {_NEAR} select x.p as a, x.q as b from kept x join kept y on x.p = y.q and x.q = y.p where x.p < x.q""",
        "cluster_density": f"""
            with recursive {_NEAR},
            edges as materialized (select x.p as a, x.q as b from kept x join kept y on x.p = y.q and x.q = y.p),
            reach as (select a as node, a as other from edges union select node, b from reach join edges on other = a)
            select e.vec_id, c.cluster from embeddings e left join (select node, min(other) as cluster from reach group by node) c on c.node = e.vec_id""",
        "cluster_pairs": f"""
            with {_MEMBERS}, {_tuples(2)} select iteration, cluster::bigint as cluster, multi, members, documents from tuples2""",
        "cluster_triplets": f"""
            with {_MEMBERS}, {_tuples(3)} select iteration, cluster::bigint as cluster, multi, members, documents from tuples3""",
        "multi_doc_share": f"""
            with {_MEMBERS}, {_tuples(2)}, {_tuples(3)},
            found as (select distinct members, documents from (select members, documents from tuples2 union all select members, documents from tuples3))
            select count(*) as tuples, count(*) filter (documents > 1) as several, (count(*) filter (documents > 1))::double / count(*) as share from found""",
        "vectors_centred": """
            with parts as (select vec_id, unnest(embedding)::double as x, unnest(range(0, len(embedding))) as k from embeddings)
            select vec_id, k::bigint as k, round((x - avg(x) over (partition by k)) * 1e6)::bigint as micro from parts""",
        "summaries_fused": f"""
            with {_JUDGE},
            own as (select array_to_string(filenames, ',') as files, summary, min(qtj_id) as k from tj where summary is not null and filenames is not null group by all)
            select files, string_agg(summary, ' ' order by k) as summary from own group by files""",
        "usage_rollup": """
            select event_type as model, count(*) as call_count, sum(greatest(event_id % 1000 - 3, 0))::bigint as input_tokens,
                   sum(case when event_id % 7 <> 0 then event_id % 500 else 0 end)::bigint as output_tokens, sum(event_id % 1500)::bigint as total_tokens,
                   case when event_type = 'click' then null else sum(event_id % 100)::bigint end as cost
            from events group by event_type""",
        "usage_windows": """
            select epoch(time_bucket(interval '10 minutes', ts))::bigint as window_start, event_type as model, count(*) as call_count, sum(event_id % 1500)::bigint as tokens
            from events group by all""",
        "doc_uuid5": """
            with h as (select distinct source, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(source)) as s from documents)
            select source, substr(s, 1, 8) || '-' || substr(s, 9, 4) || '-5' || substr(s, 14, 3) || '-' || lower(printf('%02x', (('0x' || substr(s, 17, 2))::int & 63) | 128)) || substr(s, 19, 2) || '-' || substr(s, 21, 12) as uuid
            from h""",
        "filename_normalize": f"""
            with own as (select distinct coalesce(description, filename) as filename from md_documents),
            n as (select filename, {_NORMALIZED.format(x='filename')} as normalized from own)
            select filename, normalized, count(*) over (partition by normalized) > 1 as clash from n""",
        "data_url": """
            select doc_id, 'data:image/png;base64,' || to_base64(encode(text)) as url from documents where text is not null""",
        "think_strip": r"""
            select doc_id, trim(case when contains(r, '</think>') then split_part(r, '</think>', 2) else r end) as reply
            from (select doc_id, regexp_replace(case when doc_id % 3 = 0 then '<think>a' || chr(10) || 'b</think>' || text else text end, '\n+', ' ', 'g') as r from documents where text is not null)""",
        "json_payload": r"""
            select event_id, case when regexp_matches(r, '(?s)\{.*\}') then regexp_extract(r, '(?s)\{.*\}') else trim(r) end as payload
            from (select event_id, regexp_replace('Here it is:' || chr(10) || '```json' || chr(10) || props || chr(10) || '```', '\n+', ' ', 'g') as r from events where props is not null)""",
    }

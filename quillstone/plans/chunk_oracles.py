"""DuckDB SQL for the queries of chunk_queries, written from the operators' definitions."""

from .oracles import T

HALVES = "hv as (select doc_id, block_index, page, text, is_bold, is_italic, ((block_index + doc_id::bigint) % 400 * 5 + 5) / 100.0::double as x from e)"
HALF_BODY = """hs as (select doc_id, printf('%.1f', x)::double as size, sum(greatest(len(text), 1)) as w from hv group by all),
hb as (select doc_id, min(size) as body_size from (select *, sum(w) over (partition by doc_id order by size) as upto, sum(w) over (partition by doc_id) as total from hs where size > 0) where upto > total // 2 group by doc_id)"""
NL = """nl as (select doc_id, block_index as line, case when block_index % 6 = 0 then 'Heading ' when block_index % 6 in (1, 3) then (block_index // 6 + 1) || '.' || (block_index % 6) || case when block_index % 4 = 3 then 'a' else '' end || ' ' else '' end || text
    || case when block_index % 5 = 0 then ' See paragraph ' || (block_index % 9 + 1) || '.' || (block_index % 4) || ', Table ' || (block_index % 3 + 1) || '.1, Appendix ' || chr(65 + block_index % 5) || ', BS EN ' || (13500 + block_index % 3) || '-1:2018 and Requirement B' || (block_index % 6 + 1) else '' end as text from e)"""
CH = """ch as (select doc_id, block_index::bigint as i, page, text, case block_index % 6 when 0 then 'section_heading' when 4 then 'table' when 5 then 'caption' else 'paragraph' end as type, doc_id || '-' || type || '-' || block_index as chunk_id,
    text[:30] as label, case when block_index % 6 = 0 then block_index // 6 % 3 + 1 end as level from e)"""
SP = """sp as (select c.doc_id, c.i, h.i as hi, h.chunk_id as id, h.label from ch c join ch h on h.doc_id = c.doc_id and h.level is not null and h.i < c.i and h.level < coalesce(c.level, 9)
    where not exists (select 1 from ch x where x.doc_id = c.doc_id and x.level <= h.level and x.i > h.i and x.i < c.i))"""
TOC = """te as (select doc_id, i as ord, chunk_id || case when i // 6 % 3 = 2 then '?' else '' end as head, i as lo, case when i // 6 % 4 = 3 then i - 1 else i + 5 end as hi from ch where level is not null),
toc as (select * from te union all select doc_id, ord + 1, head, lo, lo + 2 from te where ord // 6 % 2 = 0)"""
# Patterns in the fixed form of the contract.
RF = r"""rf as (
    select doc_id, line, 'internal_paragraph' as pattern_name, 'internal' as type, unnest(regexp_extract_all(text, 'paragraph(?:s)?\s+(\d+\.\d+[a-z]?)', 1)) as target from nl
    union all select doc_id, line, 'appendix', 'internal', unnest(regexp_extract_all(text, 'Appendix\s+([A-Z])', 1)) from nl
    union all select doc_id, line, 'diagram', 'internal', unnest(regexp_extract_all(text, 'Diagram\s+(\d+\.\d+)', 1)) from nl
    union all select doc_id, line, 'table', 'internal', unnest(regexp_extract_all(text, 'Table\s+(\d+\.\d+)', 1)) from nl
    union all select doc_id, line, 'bs_standard', 'external_standard', unnest(regexp_extract_all(text, 'BS\s?(?:EN\s)?\d+(?:-\d+)?(?::\d{4})?', 0)) from nl
    union all select doc_id, line, 'approved_doc', 'external_document', unnest(regexp_extract_all(text, 'Approved Document\s+[A-Z]\d?', 0)) from nl
    union all select doc_id, line, 'requirement', 'requirement', unnest(regexp_extract_all(text, 'Requirement\s+(B[1-5])', 1)) from nl)"""
RS = """tg0 as (select distinct doc_id, regexp_extract(text, '^([0-9]+\\.[0-9]+[a-z]?)\\s+', 1) as target from nl where regexp_matches(text, '^[0-9]+\\.[0-9]+[a-z]?\\s+')),
tgt as (select doc_id, 'internal_paragraph' as pattern_name, target, doc_id || '-paragraph-' || target as chunk_id from tg0 union all select distinct doc_id, 'table', t, doc_id || '-table-' || t from tg0, (values ('1.1'), ('2.1')) v(t)),
ln as (select distinct doc_id, block_index as line, doc_id || '-table-1.1' as target_chunk_id from e where block_index % 10 = 0),
rp as (select r.doc_id, r.line, r.type, r.target, t.chunk_id as target_chunk_id, 'pattern' as source from rf r left join tgt t using (doc_id, pattern_name, target)),
rs as (select * from rp where not exists (select 1 from ln where ln.doc_id = rp.doc_id and ln.line = rp.line and ln.target_chunk_id = rp.target_chunk_id)
    union all select doc_id, line, 'internal', null, target_chunk_id, 'hyperlink' from ln)"""
EXTERNAL = r"case when type <> 'internal' then regexp_replace(trim(target), '\s+', '-', 'g') end"
RATE = "(select doc_id, count(target_chunk_id) as resolved, count(*) as total from rs where type = 'internal' group by 1)"
GAPS = "gb as (select * from b where reading_order_index % 50 <> 7)"
COUNT = r"len(list_filter(regexp_split_to_array({}, '\s+'), lambda x: x <> ''))"
TRIP = f"""(select d.doc_id::varchar as doc_id, coalesce(k, 0)::bigint as words_in_chunks, {COUNT.format("coalesce(d.text, '')")}::bigint as words_in_text from documents d
    left join (select doc_id, sum({COUNT.format('text')}) as k from gb group by 1) g on g.doc_id = d.doc_id::varchar)"""
FILES = """fa as (select doc_id as n, 'd' || (doc_id % 4) || '/' || doc_id || ['.json', '.jsonl', '.txt', '/run.log'][doc_id % 4 + 1] as path, doc_id % 3 = 0 as other from documents)"""

ORACLES = {
    "rounded_sizes": "select doc_id, printf('%.1f', (doc_id % 1000 * 5 + 5) / 100.0::double)::double as one, printf('%.2f', (doc_id % 1000 * 5 + 5) / 1000.0::double)::double as two, printf('%.1f', -((doc_id % 1000 * 5 + 5) / 100.0::double))::double as negative from documents",
    "body_size_of_halves": f"with {T}, {HALVES}, {HALF_BODY} select doc_id, coalesce(body_size, 10.0)::double as body_size from (select distinct doc_id from e) left join hb using (doc_id)",
    "blocks_of_halves": f"""with {T}, {HALVES}, {HALF_BODY} select doc_id || ':p' || page || ':b' || (row_number() over (partition by doc_id, page order by block_index) - 1) as block_id, printf('%.2f', x)::double as font_size,
        case when x >= body_size + 1.5 then 'large_text' when x <= body_size - 1 and x > 0 then 'small_text' when is_bold or is_italic then 'emphasis' when x > 0 then 'body' else 'unknown' end as looks_like from hv join hb using (doc_id)""",
    "preview_body_size": f"""with {T}, w as (select doc_id, unnest(list_resize([case when reading_order_index % 4 = 1 then 0.0 else font_size end::double], greatest(len(text), 1), case when reading_order_index % 4 = 1 then 0.0 else font_size end::double)) as size from b)
        select doc_id, list_sort(list(size))[count(*) // 2 + 1] as body_size from w group by 1""",
    "text_from_spans": "select doc_id, md5(array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> ''), ' ')) as digest from documents",
    "span_fonts": """select doc_id, case when doc_id % 7 = 0 then 0 else printf('%.2f', doc_id % 100 / 8.0::double)::double end::double as size, case when doc_id % 7 = 0 then '' else 'F0' end as font,
        doc_id % 7 <> 0 and doc_id % 32 // 16 % 2 = 1 as bold, doc_id % 7 <> 0 and doc_id % 32 // 2 % 2 = 1 as italic from documents""",
    "flipped_boxes": f"with {T} select block_id, x0, 842.0::double - y1 as y0, x1, 842.0::double - y0 as y1 from b",
    "source_digests": "select doc_id, case when doc_id % 5 = 0 or text is null then 'sha256:no-source-pdf' else 'sha256:' || sha256(text) end as digest, case when doc_id % 3 = 0 then 0 else doc_id % 10 + 1 end::int as page from documents",
    "uri_labels": "select page_id, left(case when contains(url, '://') then string_split(url, '/')[3] else url end, 40) as label from pages",
    "merged_paragraphs": f"""with {T}, {NL}, m as (select *, regexp_extract(text, '^([0-9]+\\.[0-9]+[a-z]?)\\s+', 1) as number, sum((number <> '')::int) over (partition by doc_id order by line) as island from nl)
        select doc_id, min(line) as first_line, nullif(max(number), '') as number, md5(string_agg(text, ' ' order by line)) as text, count(*) as n from m group by doc_id, island""",
    "section_paths": f"""with {T}, {CH}, {SP} select ch.doc_id, ch.i as order_index, coalesce(string_agg(id, ',' order by hi), '') as section_path_ids, max_by(id, hi) as parent_section_id, coalesce(string_agg(sp.label, ' > ' order by hi), '') as breadcrumb
        from ch left join sp on sp.doc_id = ch.doc_id and sp.i = ch.i group by ch.doc_id, ch.i""",
    "chunks_under_sections": f"with {T}, {CH}, {SP} select doc_id, id as section_id, count(*) as n from sp group by all",
    "chunk_rule_faults": f"""with {T}, {CH}, c as (select *, case when i % 7 = 1 then 'x' || chunk_id when i % 11 = 2 then chunk_id || '§' else chunk_id end as id from ch)
        select * from (select unnest(['chunk_id', 'prefix', 'pages', 'paths', 'heading_level', 'asset_path', 'caption_target']) as rule, unnest([
            count(*) filter (id like '%§'), count(*) filter (i % 7 = 1), count(*) filter (i % 13 = 0), count(*) filter (i % 8 = 1), count(*) filter (type = 'section_heading' and i % 12 = 0),
            count(*) filter (type = 'table' and i % 5 = 0), count(*) filter (type = 'caption' and i % 10 = 5)]) as n from c) where n > 0""",
    "toc_faults": f"""with {T}, {CH}, {TOC} select doc_id, ord, 'window' as problem from toc where hi < lo union all select doc_id, ord, 'unknown_heading' from toc where not exists (select 1 from ch where ch.doc_id = toc.doc_id and ch.chunk_id = toc.head)""",
    "nested_toc_windows": f"""with {T}, {CH}, {TOC}, ft as (select doc_id, head, max_by(lo, ord) as lo, max_by(hi, ord) as hi from toc group by all),
        p as (select c.doc_id, c.chunk_id, c.i, f.head, lo, hi from ch c left join ft f on f.doc_id = c.doc_id and f.head = c.doc_id || '-section_heading-' || (c.i // 6 * 6) where c.level is null)
        select doc_id, chunk_id, case when head is null then 'unknown_parent' else 'outside_window' end as problem from p where head is null or i < lo or i > hi""",
    "repeated_chunk_ids": f"with {T}, {CH}, c as (select doc_id, case when i % 9 = 8 then doc_id || '-table-4' else chunk_id end as chunk_id from ch) select doc_id, chunk_id, count(*) as n from c group by all having count(*) > 1",
    "span_slice_faults": f"""with {T}, {CH}, x as (select doc_id, chunk_id || case when i % 17 = 3 then '?' else '' end as chunk_id, i % 17 = 3 as lost, i, len(text) as n, text, unnest(range(5)) as span from ch),
        s as (select *, case span when 1 then i % 3 - 1 when 2 then n - i % 2 when 4 then 2 else 0 end as lo, case when span = 3 and i % 4 = 0 then n + 1 when span = 4 then n - 2 else n end as hi from x)
        select doc_id, chunk_id, span::int as span, case when lost then 'unknown_chunk' when lo < 0 then 'negative_start' when hi > n then 'beyond_text' else 'empty_slice' end as problem from s where lost or lo < 0 or hi > n or greatest(lo, 0) >= hi or lo >= n""",
    "chunks_in_joint_windows": f"""with {T}, {CH}, {TOC}, w as (select a.doc_id, a.ord as a, b.ord as b, a.lo, b.hi from toc a join toc b on a.doc_id = b.doc_id and b.ord = a.ord + 12 where a.ord % 18 = 0)
        select w.doc_id, a, b, count(*) as n from w join ch on ch.doc_id = w.doc_id and ch.i between lo and hi group by all""",
    "references_found": f"with {T}, {NL}, {RF} select *, {EXTERNAL} as external_id from rf",
    "references_resolved": f"with {T}, {NL}, {RF}, {RS} select * from rs",
    "reference_resolution_rate": f"with {T}, {NL}, {RF}, {RS} select *, resolved / total as rate from {RATE}",
    "references_index": f"""with {T}, {NL}, {RF}, {RS}, k as (select doc_id, line, case when type <> 'internal' then 'external_citations' when target_chunk_id is null then 'unresolved_internal' else 'by_target' end as part, coalesce({EXTERNAL}, target_chunk_id, target) as key from rs)
        select doc_id, part, key, count(*) as n, array_to_string(list_sort(list(distinct line)), ',') as lines from k group by all""",
    "glossary_terms_used": r"""with w as (select regexp_split_to_array(trim(regexp_replace(text, '[^\p{L}\p{N}]+', ' ', 'g')), ' ') as x from benchmark), t as (select distinct lower(array_to_string(x[:n], ' ')) as term from w, range(1, 4) r(n)),
        d as (select doc_id, ' ' || trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')) || ' ' as words from documents)
        select doc_id, term from d join t on contains(words, ' ' || term || ' ') where term <> ''""",
    "word_round_trip": f"with {T}, {GAPS} select *, case when words_in_text > 0 then words_in_chunks / words_in_text else 1 end::double as share from {TRIP}",
    "health_thresholds": f"""with {T}, {NL}, {RF}, {RS}, {GAPS},
        m as (select doc_id, y0 - case when reading_order_index % 30 = 4 then 100 else 0 end as y, lag(y) over (partition by doc_id, page order by reading_order_index) as before from gb),
        r as (select doc_id, 'internal_ref_resolution' as name, resolved / total as value from {RATE}
            union all select doc_id, 'page_coverage', coalesce(c, 0) / t from (select doc_id, count(*) as t from pg group by 1) left join (select doc_id, count(distinct page) as c from e where page <> 2 group by 1) using (doc_id)
            union all select doc_id, 'text_reconstruction_coverage', case when words_in_text > 0 then words_in_chunks / words_in_text else 1 end from {TRIP}
            union all select doc_id, 'reading_order_monotonicity', count(*) filter (y >= before) / count(*) from m where before is not null group by 1)
        select *, case name when 'internal_ref_resolution' then 0.95 when 'page_coverage' then 0.98 when 'text_reconstruction_coverage' then 0.97 else 0.98 end::double as threshold, value >= threshold as passed from r""",
    "status_pills": f"with {T} select doc_id, case when count(*) filter (reading_order_index % 17 = 5) = 0 then 'passed' else 'FAILED' end as pill from b group by 1",
    "stage_counters": f"""with {T} select doc_id, 'blocks_emitted' as counter, count(*) as n from b group by 1 union all select doc_id, 'pages_with_blocks', count(distinct page) from b group by 1
        union all select doc_id, 'region_' || region, count(*) from b group by all union all select doc_id, 'looks_' || looks_like, count(*) from b group by all""",
    "block_line_faults": f"""with {T}, k as (select doc_id as path, (row_number() over (partition by doc_id order by page, reading_order_index))::int as line from b), f as (select path, line, case line % 9 when 4 then 'json' when 2 then 'block_id,page' when 5 then 'region' when 6 then 'missing,looks_like' when 8 then 'unknown' end as rules from k)
        select * from (select * from f where rules is not null qualify row_number() over (partition by path order by line) <= 6)""",
    "page_document_faults": f"""with {T}, d as (select distinct doc_id as path, doc_id::bigint % 6 as k from pg) select path, case k when 1 then '$[0].rotation: enum' when 2 then '$[0].width: exclusiveMinimum' when 3 then '$[0].height: required' when 4 then '$: json' end as error from d where k between 1 and 4""",
    "run_diff_files": f"""with {FILES} select path, case when n % 7 = 0 then 'only_a' when n % 10 = 0 then 'only_b' when n % 4 = 0 then 'json' when n % 4 = 2 then 'bytes' when n % 5 = 2 then 'line_count' else 'line' end as status,
        case when n % 7 = 0 or n % 10 = 0 or n % 4 = 2 then null when n % 4 = 0 then '$.m.v[1]' when n % 5 = 2 then '3 4' else '2' end as place
        from fa where (n % 7 = 0) <> (n % 10 = 0) or n % 7 <> 0 and n % 10 <> 0 and other and n % 4 <> 3""",
}

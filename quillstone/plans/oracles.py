"""DuckDB SQL for the queries, written from the operators' definitions."""

SIZE = "case when i = 0 then 18.0 when len(text) <= 12 then 8.5 else 11.0 end::double"
T = f"""
l as (select doc_id::varchar as doc_id, unnest(string_split(text, chr(10))) as raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 as i from documents),
e0 as (select doc_id, i, trim(raw) as text from l where trim(raw) <> ''),
e as (select doc_id, (i // 40 + 1)::int as page, i::int as block_index, text, {SIZE} as font_size, 'Helvetica' as font_name, (i = 0 or text like '%:') as is_bold, text like '%?' as is_italic,
    case when len(text) <= 6 then 20.0 else 72.0 end::double as x0, (40 + 20 * (i % 40))::double as y0, 523.0::double as x1, (40 + 20 * (i % 40))::double + {SIZE} as y1 from e0),
pg as (select doc_id, unnest(range(1, max(page) + 1))::int as page_number, 595.0::double as width, 842.0::double as height, 0 as rotation from e group by doc_id),
sz as (select doc_id, font_size as size, sum(greatest(len(text), 1)) as w from e where font_size > 0 group by all),
bs as (select doc_id, min(size) as body_size from (select *, sum(w) over (partition by doc_id order by size) as upto, sum(w) over (partition by doc_id) as total from sz) where upto > total // 2 group by doc_id),
b as (select e.doc_id || ':p' || page || ':b' || (row_number() over (partition by e.doc_id, page order by block_index) - 1) as block_id, e.doc_id, page, (row_number() over (partition by e.doc_id, page order by block_index) - 1)::int as reading_order_index,
    text, font_size, font_name, is_bold, is_italic,
    case when y1 < 842::double * 0.07::double then 'header' when y0 > 842::double * (1::double - 0.07::double) then 'footer' when x0 < 595::double * 0.05::double then 'margin' else 'body' end as region,
    case when font_size >= body_size + 1.5 then 'large_text' when font_size <= body_size - 1 and font_size > 0 then 'small_text' when is_bold or is_italic then 'emphasis' when font_size > 0 then 'body' else 'unknown' end as looks_like,
    x0, y0, x1, y1 from e join bs using (doc_id)),
g as (select *, trim(regexp_replace(text, '[\\s\\x0B\\x1C-\\x1F\\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+', ' ', 'g')) as tk,
    'y' || round_even(y0 / 10, 0)::int || '|fs' || font_size || '|fn' || font_name || '|b' || is_bold::int || '|i' || is_italic::int || '|reg' || region as pk from b),
tg as (select doc_id, tk as key, count(*) as n, list(block_id order by page, reading_order_index) as m from g group by all having count(*) >= 2),
pgr as (select doc_id, pk as key, count(*) as n, list(block_id order by page, reading_order_index) as m from g group by all having count(*) >= 2),
se as (select doc_id, block_id, row_number() over (partition by doc_id order by page, reading_order_index) - 1 as order_index, sum((looks_like = 'large_text')::int) over (partition by doc_id order by page, reading_order_index)::bigint as section from b),
sb as (select doc_id, section, min(order_index) as first_order_index, max(order_index) as last_order_index, min_by(block_id, order_index) as first_block, max_by(block_id, order_index) as last_block from se group by all)
"""
H = r"""
np as (select coalesce(case when contains(url, '://') then string_split(url, '/')[3] end, '') as doc_id, (row_number() over (partition by coalesce(case when contains(url, '://') then string_split(url, '/')[3] end, '') order by page_id))::int as page, html from pages),
hx as (select doc_id, page, unnest(x) as raw, generate_subscripts(x, 1) - 1 as i from (select doc_id, page, regexp_extract_all(html, '(?s)<(?:title|h1|p|li|div|footer)(?:\s[^>]*)?>(.*?)</(?:title|h1|p|li|div|footer)>', 1) as x from np)),
he as (select doc_id, page, i::int as block_index, trim(regexp_replace(raw, '<[^>]*>', '', 'g')) as text, 72.0::double + 10 * (i % 3) as x0, 40.0::double + 20.0::double * i as y0, 400.0::double + 10 * (i % 3) as x1, 52.0::double + 20.0::double * i as y1 from hx where trim(regexp_replace(raw, '<[^>]*>', '', 'g')) <> ''),
lx as (select doc_id, page, unnest(x) as u, generate_subscripts(x, 1) - 1 as i from (select doc_id, page, regexp_extract_all(html, 'href="([^"]*)"', 1) as x from np)),
hl as (select doc_id, page, i::int as link_index, case when u like '/%' then 'internal' else 'external' end as kind, case when u not like '/%' then u end as uri, case when u like '/%' then (len(u) % 5 + 1)::int end as dest_page,
    80.0::double + 7 * i as x0, 47.0::double + 17.0::double * i as y0, 120.0::double + 7 * i as x1, 55.0::double + 17.0::double * i as y1 from lx)
"""
D = r"""
ra as (select doc_id, 'doc' || doc_id || '.json' as path, text from documents where doc_id % 10 <> 0),
rb as (select doc_id, 'doc' || doc_id || '.json' as path, case doc_id % 3 when 0 then text || chr(10) || 'more' when 1 then regexp_replace(text, '\n', chr(10) || 'x') else text end as text from documents where doc_id % 7 <> 0)
"""
RF = r"""
rf as (
    select doc_id, block_index as line, 'email' as kind, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+')) as target from e
    union all select doc_id, block_index, 'phone', unnest(regexp_extract_all(text, '[0-9]{3}-[0-9]{4}')) from e
    union all select doc_id, block_index, 'licence', unnest(regexp_extract_all(text, '(?i)licen[cs]e')) from e
    union all select doc_id, block_index, 'decimal', unnest(regexp_extract_all(text, '[0-9]+\.[0-9]+')) from e)
"""
CHUNK_RE = "^[A-Za-z0-9._-]+-(section_heading|paragraph|table|diagram|appendix|glossary_entry|regulation_quote|caption)-[A-Za-z0-9._-]+$"
RULED = "rl as (select block_id, coalesce(reading_order_index = 0, false) as suppressed, case when reading_order_index = 2 then 'noise' end as tag from b)"
COVER = "(select doc_id, count(distinct page) as covered from e group by 1)"

ORACLES = {
    "elements_from_text": f"with {T} select * from e",
    "elements_from_html": f"with {H} select doc_id, page, block_index, text from he",
    "page_geometry": f"with {T} select * from pg",
    "links_from_html": f"with {H} select * from hl",
    "body_font_size": f"with {T} select doc_id, coalesce(body_size, 10.0) as body_size from (select distinct doc_id from e) left join bs using (doc_id)",
    "blocks": f"with {T} select * from b",
    "region_breakdown": f"with {T} select doc_id, region, count(*) as n from b group by all",
    "looks_like_breakdown": f"with {T} select doc_id, looks_like, count(*) as n from b group by all",
    "hint_totals": f"with {T} select region, looks_like, count(*) as n from b group by all",
    "page_coverage": f"with {T} select doc_id, covered, total, covered / total as coverage from (select doc_id, count(*) as total from pg group by 1) join {COVER} using (doc_id)",
    "blocks_per_page": f"with {T} select doc_id, avg(n) as mean, min(n) as low, max(n) as high from (select doc_id, page, count(*) as n from e group by all) group by 1",
    "links_by_kind": f"with {H}, a as (select doc_id, case when link_index % 5 = 4 then 'external' when link_index % 7 = 6 then 'strange' else kind end as kind from hl) select doc_id, count(*) as total, count(*) filter (kind = 'internal') as internal, count(*) filter (kind = 'external') as external from a group by 1",
    "parse_counters": f"with {T}, {H} select 'elements' as name, count(*) as n from e union all select 'pages', count(*) from pg union all select 'links', count(*) from hl",
    "schema_conformance": f"""with {T}, f as (select *, reading_order_index % 17 = 5 as flat, reading_order_index % 23 = 7 as wrong, reading_order_index % 29 = 3 as minus from b),
        w as (select *, block_id || case when wrong then 'x' else '' end || ' ' || concat_ws(',', case when flat then 'bbox_area' end, case when wrong then 'block_id' end, case when minus then 'font_size' end) as why from f)
        select doc_id, case when count(*) filter (flat or wrong or minus) = 0 then 1.0 else 0.0 end::double as value, count(*) filter (flat or wrong or minus) as failures,
            coalesce(array_to_string((list(why order by page, reading_order_index) filter (flat or wrong or minus))[:20], ';'), '') as samples from w group by 1""",
    "page_and_link_faults": f"""with {T}, {H} select 'page' as what, 'rotation' as rule, count(*) as n from pg where page_number % 2 = 0 having count(*) > 0 union all select 'page', 'size', count(*) from pg where page_number % 3 = 0 having count(*) > 0
        union all select 'link', 'dest_page', count(*) from hl where link_index % 4 = 0 having count(*) > 0""",
    "text_groups": f"with {T} select doc_id, key, n, array_to_string(m, ',') as members from tg",
    "position_groups": f"with {T} select doc_id, key, n, array_to_string(m, ',') as members from pgr",
    "block_group_membership": f"with {T} select block_id, tk as key, count(*) over (partition by doc_id, tk) as n from g",
    "members_of_chosen": f"with {T} select g.block_id, coalesce(array_to_string(m, ','), g.block_id) as members from g left join tg on g.doc_id = tg.doc_id and g.tk = tg.key where reading_order_index = 0",
    "member_samples": f"with {T} select doc_id, key, array_to_string(m[:3], ',') as shown, greatest(n - 3, 0) as more from pgr",
    "block_summaries": f"with {T} select block_id, text[:200] as text, page, font_size, region from b",
    "page_nav": f"with {T} select doc_id, page_number, coalesce(n, 0) as n from pg left join (select doc_id, page as page_number, count(*) as n from e where page <> 2 group by all) using (doc_id, page_number)",
    "default_page_dims": f"""with {T}, h as (select *, case when page % 2 = 1 then 421.0 else 842.0 end::double as h from e)
        select page, case when y1 < h * 0.07::double then 'header' when y0 > h * (1::double - 0.07::double) then 'footer' when x0 < 595::double * 0.05::double then 'margin' else 'body' end as region, count(*) as n from h group by all""",
    "css_projection": f"with {T}, s as (select block_id, least(greatest(font_size, 11.0), 22.0)::double as px, greatest(0::double, (x0 / 595.0::double - 0.12::double) * 240.0::double) as indent from b) select block_id, px, case when indent > 2 then indent end as indent from s",
    "apply_rules": f"with {T}, {RULED} select * from rl",
    "decision_counts": f"with {T}, {RULED} select doc_id, count(*) filter (suppressed) as suppressed, count(tag) as tagged from rl join b using (block_id) group by 1",
    "ids_by_tag": f"with {T}, {RULED} select doc_id, tag, string_agg(block_id, ',' order by block_id) as ids from rl join b using (block_id) where tag is not null group by all",
    "group_state": f"with {T}, {RULED} select doc_id, key, bool_and(suppressed) as all_suppressed, case when count(distinct tag) = 1 and count(tag) = any_value(n) then min(tag) end as common_tag from (select doc_id, key, n, unnest(m) as block_id from pgr) join rl using (block_id) group by doc_id, key",
    "block_link_overlap": f"with {H} select e.doc_id || ':' || e.page || ':' || block_index as block_id, link_index, case when dest_page is not null then '↗p' || dest_page else left(uri, 40) end as label from he e join hl l on e.doc_id = l.doc_id and e.page = l.page and l.x0 < e.x1 and l.x1 > e.x0 and l.y0 < e.y1 and l.y1 > e.y0",
    "link_targets": f"with {H} select l.doc_id || ':' || l.page || ':' || link_index as point_id, e.doc_id || ':' || e.page || ':' || block_index as block_id from he e join hl l on e.doc_id = l.doc_id and e.page = l.page and (l.x0 + l.x1) / 2 between e.x0 and e.x1 and (l.y0 + l.y1) / 2 between e.y0 and e.y1",
    "slug_urls": r"""with s as (select page_id, regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') as s from pages), d as (select page_id, case when s = '' then 'document' else s end as s from s)
        select page_id, case when len(s) <= 40 then s else regexp_replace(case when contains(s[:40], '-') then regexp_replace(s[:40], '-[^-]*$', '') else s[:40] end, '-+$', '') end as slug from d""",
    "title_from_stem": r"""with n as (select page_id, regexp_extract(url, '([^/]*)$', 1) as n from pages), s as (select page_id, case when regexp_matches(n, '^.+\.[^.]*$') then regexp_replace(n, '\.[^.]*$', '') else n end as s from n)
        select page_id, case when trim(translate(s, '-_', '  ')) = '' then 'Untitled' else trim(translate(s, '-_', '  ')) end as title from s""",
    "sha256_text": "select doc_id, sha256(text) as sha256 from documents",
    "uri_host": "select page_id, case when contains(url, '://') then string_split(url, '/')[3] end as host from pages",
    "html_escape": """with x as (select doc_id, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(39), '&#x27;') as t from documents) select doc_id, len(t)::int as n, md5(t) as digest from x""",
    "observed_features": f"with {H} select unnest(['chunking', 'reference_resolution', 'table_of_contents', 'glossary_extraction', 'diagram_blocks', 'table_blocks', 'docling_parser']) as feature, case when feature = 'diagram_blocks' then (select count(*) from he) end as observed",
    "run_diff_paths": f"with {D} select coalesce(ra.path, rb.path) as path, case when rb.path is null then 'only_a' when ra.path is null then 'only_b' when ra.text <> rb.text then 'changed' else 'same' end as status from ra full join rb on ra.path = rb.path",
    "run_diff_lines": f"with {D} select ra.path, case when ra.doc_id % 3 = 0 then len(string_split(ra.text, chr(10)))::int + 1 else 2 end as line from ra join rb on ra.path = rb.path where ra.text <> rb.text",
    "reading_order_violations": """with t as (select conv_id::varchar as doc_id, (case when conv_id % 5 = 1 and turn = 2 then 1 else turn end)::int as order_index from conversations), n as (select doc_id, count(*) as n from t group by 1)
        select doc_id, order_index, 'duplicate' as problem from t group by all having count(*) > 1
        union all select distinct doc_id, order_index, 'outside' from t join n using (doc_id) where order_index < 0 or order_index >= n
        union all select doc_id, order_index, 'missing' from (select doc_id, unnest(range(n))::int as order_index from n) w where not exists (select 1 from t where t.doc_id = w.doc_id and t.order_index = w.order_index)""",
    "section_window_violations": f"""with {T} select se.doc_id, block_id as chunk_id, case when se.section = 3 then 'unknown_parent' else 'outside_window' end as problem from se join sb on se.doc_id = sb.doc_id and se.section = sb.section
        where se.section = 3 or se.section % 2 = 0 and order_index = last_order_index""",
    "heading_violations": f"with {T} select doc_id, section as section_id, first_block || '?' as heading_chunk_id from sb where section = 1",
    "asset_linkage_violations": """with c as (select conv_id, turn, exists (select 1 from conversations n where n.conv_id = m.conv_id and n.turn = m.turn + 1) as there from conversations m where turn % 2 = 0),
        p as (select *, case when conv_id % 7 = 0 then 'no_target' when not there then 'unknown_target' when conv_id % 4 = 0 then 'not_an_asset' when conv_id % 3 = 0 then 'one_way' end as problem from c)
        select conv_id::varchar as doc_id, conv_id || ':' || turn as chunk_id, problem from p where problem is not null""",
    "span_bounds_violations": f"with {T} select block_id as chunk_id, (len(text) + 1)::int as \"end\", len(text)::int as length from b where reading_order_index % 9 = 0",
    "chunk_id_format": f"with {T}, i as (select doc_id || '-' || case looks_like when 'large_text' then 'section_heading' when 'emphasis' then 'shout' else 'paragraph' end || '-' || case when page = 2 then '§2' else page::varchar end as id from b) select regexp_matches(id, '{CHUNK_RE}') as ok, count(*) as n from i group by 1",
    "toc_bounds": f"with {T} select * from sb",
    "section_range_scan": f"with {T} select sb.doc_id, sb.section, count(*) as n from se join sb on se.doc_id = sb.doc_id and order_index between first_order_index and last_order_index group by all",
    "monotonicity": f"""with {T}, m as (select doc_id, page, reading_order_index, y0 - case when reading_order_index % 5 = 4 then 100 else 0 end as y from b), w as (select doc_id, y, lag(y) over (partition by doc_id, page order by reading_order_index) as before from m)
        select doc_id, count(*) as steps, count(*) filter (y >= before) as rising from w where before is not null group by 1""",
    "reconstruction": f"""with {T} select d.doc_id::varchar as doc_id, coalesce(kept, 0) as kept, len(regexp_replace(d.text, '[ \\n]+', '', 'g'))::int as whole from documents d left join (select doc_id, sum(len(regexp_replace(text, '[ \\n]+', '', 'g')))::bigint as kept from b group by 1) k on d.doc_id::varchar = k.doc_id""",
    "refs_extracted": f"with {T}, {RF} select * from rf",
    "inverted_index": f"with {T}, {RF} select kind, lower(target) as target, count(*) as n, count(distinct doc_id) as docs from rf group by all",
    "defined_terms_used": """with t as (select distinct lower(regexp_extract(text, '([A-Za-z]{6,})', 1)) as term from benchmark), w as (select distinct doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) as term from documents)
        select term, count(distinct doc_id) as docs from w join t using (term) where term <> '' group by 1""",
    "validation_report": f"""with {T}, {H}
        select doc_id, 'page_coverage' as name, (covered / total)::double as value, null::double as threshold, true as passed from (select doc_id, count(*) as total from pg group by 1) join {COVER} using (doc_id)
        union all select doc_id, 'blocks_per_page', avg(n), null, true from (select doc_id, page, count(*) as n from e group by all) group by 1
        union all select doc_id, 'blocks_by_region', count(*)::double, null, true from b group by 1 union all select doc_id, 'blocks_by_looks_like', count(*)::double, null, true from b group by 1
        union all select doc_id, 'links_by_kind', count(*)::double, null, true from hl group by 1 union all select distinct doc_id, 'schema_conformance', 1.0::double, 1.0::double, true from b""",
}

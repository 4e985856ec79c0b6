"""DuckDB SQL that gives the rows of the queries in ``evidence``, written independently of them.

No SQL: the order-dependent merges q11, q25 and q54, the span search q15 and
the file sizes of q93, which are tested otherwise.
"""

from docloom.plans.oracles import AGAIN, FIRST, LABEL

_LINES = r"l as (select doc_id, [y for y in [trim(regexp_replace(replace(replace(x, chr(160), ' '), chr(61440), '- '), '[ \t]+', ' ', 'g')) for x in string_split(text, chr(10))] if y <> ''] as l from documents)"
_FOOTER, _NOISE = r"regexp_full_match(y, '[-–—]?\s*\d+\s*[-–—]?')", r"regexp_full_match(y, '[❶❷❸❹❺❻❼❽❾❿➊➋➌➍➎➏➐➑➒➓ㅇ□▪•*\- ]+')"
_OPENS = r"""(y like '#%' or y like '【%' or y like '<%>' or regexp_matches(y, '^[①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳❶❷❸❹❺❻❼❽❾❿]\s*\S') or regexp_matches(y, '^[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]+(?:[.)]|\s)')
 or regexp_matches(y, '^\d+[.)]\s*\S') or regexp_matches(y, '^\(.*[’'']?\d{2}.*\)$') or y like '※%' or regexp_matches(y, '^\*{1,3}\s*\S') or regexp_matches(y, '^(?:[-*]+|[ㅇ□▪•⇨➊➋➌➍➎➏➐➑➒➓])')) and not y like '|%'"""
_JOIN = r"""lambda a, b: case when a = '' then b when b = '' then a when regexp_matches(a, '[(\[{“"『]$') or regexp_matches(b, '^[)\]},.:;”"』]') then a || b else a || ' ' || b end"""

_HEADED = """lines as (select doc_id, unnest(range(1, len(l) + 1)) as pos, unnest(l) as line from (select doc_id, string_split(text, chr(10)) as l from documents)),
headed as (select doc_id, pos, line, last_value(case when length(line) <= 25 then line end ignore nulls) over (partition by doc_id order by pos rows between unbounded preceding and 1 preceding) as heading from lines)"""
_STRONG = "(cast(contains(t, 'the') as int) + cast(contains(t, 'les') as int) + cast(contains(t, 'der') as int))"
_ACTION = "(cast(contains(t, 'and') as int) + cast(contains(t, 'des') as int) + cast(contains(t, 'und') as int) + cast(contains(t, 'que') as int))"
_NEGATIVE = "(contains(t, '***') or contains(t, '###'))"
_PAREN = r"cast(regexp_matches(t, '\([^()]+\)') as int)"
_TERMS = "terms as (select l_orderkey as o_orderkey, p_type, p_brand, l_linenumber, l_suppkey, l_returnflag = 'R' as is_primary from lineitem join part on l_partkey = p_partkey)"
_IRI = "'http://example.org/docloom/resource/"

SQL: dict[str, str] = {
    "q10_page_assembly": f"""with {_LINES}, k as (select doc_id, len(l) as n_lines, len([y for y in l if {_FOOTER}]) as n_footers, len([y for y in l if not {_FOOTER} and {_NOISE}]) as n_noise,
  [y for y in l if not {_FOOTER} and not {_NOISE}] as k from l),
u as (select doc_id, i, y, sum(cast(i = 1 or ({_OPENS}) as int)) over (partition by doc_id order by i) as unit from (select doc_id, unnest(range(1, len(k) + 1)) as i, unnest(k) as y from k)),
j as (select doc_id, unit, list_reduce(list(y order by i), {_JOIN}) as y from u group by all),
p as (select doc_id, count(*) as n_units, string_agg(y, chr(10) || chr(10) order by unit) as t from j group by doc_id)
select doc_id, n_lines, coalesce(n_units, 0) as n_units, n_footers, n_noise, length(coalesce(t, '')) as n_chars, sha256(coalesce(t, '')) as page_sha256 from k left join p using (doc_id)""",
    "q16_passage_containment": "select doc_id, item_id from documents d, benchmark b where contains(d.text, b.text)",
    "q24_candidate_mine_dedupe": f"""with {_HEADED}, c as (select *, trim(regexp_replace(line, '\\s+', ' ', 'g')) as t from headed where length(line) > 25),
s as (select *, {_STRONG} as strong, {_STRONG} * 3 + {_ACTION} + {_PAREN} * 2 as points, cast(regexp_matches(t, '(?:19|20)\\d{{2}}') as int) - cast(length(t) > 180 as int) as extra from c),
k as (select *, case when greatest(a, b, q) = 0 then case when contains(line, 'a') then 'talent' else 'technology' end when a >= b and a >= q then 'technology' when b >= q then 'infrastructure_institutional' else 'talent' end as category
  from (select *, cast(contains(line, 'the') as int) + cast(contains(line, 'les') as int) as a, cast(contains(line, 'der') as int) + cast(contains(line, 'and') as int) as b, cast(contains(line, 'que') as int) as q from s)
  where length(t) >= 20 and t <> 'Copyright' and not t like '<%>' and not t like 'Licensed%' and not ({_NEGATIVE} and strong = 0)
    and (points + extra >= 4 or (points + extra >= 2 and contains(coalesce(heading, ''), 'a')))),
f as (select *, {FIRST} as y from k), g as (select *, case when length(y) < 2 then {AGAIN} else y end as x from f),
h as (select *, {LABEL.format(48, 45)} as label, case when length(t) > 150 then rtrim(left(t, 147)) || '...' else t end as summary from g),
r as (select *, row_number() over (partition by category, label order by points desc, doc_id, pos) as rk from h)
select doc_id, pos, category, label, summary, points from r where rk = 1""",
    "q26_rule_cascade": """with r as (select doc_id, source, n_chars, lower(text) as t from documents), c as (select *, case
  when contains(t, 'license') or contains(t, 'copyright') or contains(t, 'permission') then 1 when contains(t, '@') and not contains(t, 'example') then 2 when contains(t, 'the') and contains(t, 'and') then 3 else 4 end as k from r)
select doc_id, ['blocked', 'review', 'keep', 'none'][k] as status, ['license', 'contact', 'prose', 'no_rule'][k] as reason, ['high', 'medium', 'low', 'none'][k] as attention,
  case when source is null then 'missing_source' when n_chars > 5000 then 'authoritative' when n_chars > 500 then 'supporting' else 'supplementary' end as tier, [0, 1, 2, 9][k] as rank from c""",
    "q41_lens_projection_assign": f"""with {_TERMS}, k as (select o_orderkey, count(*) filter (is_primary) as n, min(p_type) filter (is_primary) as t from terms group by 1)
select o_orderkey, case when n = 1 then t end as p_type, case when coalesce(n, 0) = 1 then 'assigned' when coalesce(n, 0) > 1 then 'ambiguous' else 'unassigned' end as assignment from orders left join k using (o_orderkey)""",
    "q53_table_class": """with s as (select l_orderkey as k, count(*) as r, count(distinct p_brand) as c, list_sort(list(distinct p_brand)) as b from lineitem join part on l_partkey = p_partkey group by 1),
p as (select *, replace(array_to_string(b[1:4], ' | ')[1:200], ' ', '') as v from s),
w as (select k, case when k % 2 = 0 then case when contains(v, 'Brand#11') then 1 when r = 1 and c = 1 then 2 when r = 1 and c <= 3 then 3 when k % 10 = 0 then 4 when r >= 3 and c >= 4 then 5
   when r >= 4 and c >= 2 and (contains(v, '%') or contains(v, '202') or contains(v, '20''')) then 6 when c = 1 and r >= 3 then 7 when r >= 3 and c >= 2 then 8 else 9 end
  else case when r = 1 and c <= 3 then 10 when r <= 2 and c >= 8 then 11 when r >= 3 and c >= 2 then 12 else 13 end end as x from p),
n as (select *, case when x in (1, 2, 3, 4, 9, 10) then 'layout_false_positive' when x in (5, 6, 12) then 'structured_table' when x = 11 then 'fragment_or_broken' else 'review_required' end as table_class,
  ['front_matter_table', 'single_cell_layout_box', 'single_row_layout_box', 'floating_layout_box', 'hwpx_matrix_table', 'hwpx_grid_table', 'single_column_info_box', 'hwpx_needs_manual_review', 'small_hwpx_layout_box',
   'single_row_small_box', 'wide_text_fragment', 'shape_based', 'needs_manual_review'][x] as reason from w)
select k as l_orderkey, table_class, reason, case table_class when 'structured_table' then 'yes' when 'layout_false_positive' then 'no' else 'review' end as keep from n""",
    "q59_ocr_noise": """with l as (select doc_id, n_chars, unnest(range(0, len(x))) as pos, unnest(x) as line from (select *, string_split(text, chr(10)) as x from documents)), t as (select doc_id, cast(pos as int) as pos, replace(line, ' ', '') as c, n_chars % 100 / 100.0 as s from l),
n as (select *, length(c) as n, len(regexp_extract_all(c, '[가-힣A-Za-z0-9]')) / greatest(length(c), 1) as r, regexp_full_match(c, '[^\\p{L}\\p{N}]+') as signs from t)
select doc_id, pos, n = 0 or s < 0.65 or (n <= 4 and s < 0.85) or (r < 0.45 and s < 0.9) or signs as support, n = 0 or s < 0.6 or (n <= 2 and s < 0.85) or (r < 0.4 and s < 0.9) or signs as reference from n""",
    "q60_skip_reasons": f"""with l as (select doc_id, unnest(range(0, len(x))) as pos, unnest(x) as line from (select *, string_split(text, chr(10)) as x from documents)), c as (select doc_id, cast(pos as int) as pos, trim(regexp_replace(line, '\\s+', ' ', 'g')) as t from l), k as (select *, {_STRONG} + {_ACTION} > 0 as acts, length(t) as n from c)
select doc_id, pos, case when t like 'Copyright%' then 'section_scaffold' when regexp_matches(t, '^\\(?\\d+\\)?\\s*(?:items?|개)') then 'group_count_scaffold' when regexp_matches(t, '^(?:\\*|e\\.g\\.|예\\))') then 'example_scaffold'
  when t like 'Licensed%' and not acts then 'context_scaffold' when contains(right(t, 50), 'zz') and not contains(t, 'ing') then 'background_tail' when {_NEGATIVE} and not acts then 'background_statement'
  when n <= 40 and not acts then 'short_paragraph_scaffold' when (length(t) - length(replace(t, '[', '')) >= 3 or length(t) - length(replace(t, '→', '')) >= 2 or length(t) - length(replace(t, '․', '')) >= 4) and not acts then 'diagram_or_schedule_paragraph'
  when n >= 150 and not acts then 'long_background_paragraph' when not acts and n <= 80 then 'no_action_no_taxonomy' end as skip from k""",
    "q63_draft_pack": """with l as (select l_orderkey as k, list(l_linenumber order by l_linenumber, l_partkey) as i, list(l_partkey order by l_linenumber, l_partkey) as c, count(*) as n from lineitem group by 1),
c as (select k, unnest(range(0, n)) as p, unnest(c) as text from l), m as (select k, unnest(range(0, n)) as p, unnest(i) as item from l), d as (select k, p, text, k || '-C' || lpad(cast(p + 1 as varchar), 2, '0') as id from c)
select 'groups' as part, format('{{"l_orderkey":{},"n_contents":{},"n_items":{}}}', k, n, n) as row from l
union all select 'members', format('{{"is_representative":{},"item":{},"l_orderkey":{}}}', case when p = 0 then 'true' else 'false' end, item, k) from m
union all select 'contents', format('{{"content_id":"{}","display_order":{},"l_orderkey":{},"text":{}}}', id, p + 1, k, text) from d
union all select 'links', format('{{"content_id":"{}","item":{},"l_orderkey":{}}}', id, item, d.k) from d join m on d.k = m.k
union all select 'displays', format('{{"l_orderkey":{},"title_text":{}}}', k, c[1]) from l
union all select 'assertions', format('{{"l_orderkey":{},"status":"seed_draft"}}', k) from l""",
    "q64_apply_outputs": """with m as (select l.doc_id, case when quality = 0 and toxic = 1 then 'wrong' when toxic = 1 then 'none' else 'yes' end as c, d.doc_id is not null as there from labels l left join (select doc_id from documents where lang = 'en') d on d.doc_id = l.doc_id)
select 'outcomes' as part, cast(doc_id as varchar) as id, case when c = 'wrong' then 'invalid_decision' when not there then case when doc_id % 2 = 0 then 'missing_target' else 'inactive_missing_target' end else 'applied' end as value from m
union all select 'mappings', 'D-' || doc_id, unnest(['S-1:true:reviewed', 'S-2:false:reviewed']) from m where c = 'yes' and there
union all select 'assertions', 'D-' || doc_id, case when c = 'none' then 'NO_STRATEGY' else 'REVIEWED' end from m where c <> 'wrong' and there""",
    "q65_merged_batches": """with l as (select doc_id, lang from documents where doc_id % 3 <> 0), e as (select doc_id, quality from labels)
select l.doc_id, case when e.doc_id is null then lang else 'edit 1' end as note from l left join e using (doc_id)
union all select doc_id, 'duplicate' from e where quality = 1 union all select doc_id, 'missing' from e where doc_id not in (select doc_id from l)""",
    "q66_finalised": """with l as (select doc_id, case when lang = 'en' then 'done' end as s from documents where doc_id % 4 <> 0), d as (select doc_id, case when quality = 1 then 'done' end as s from labels)
select coalesce(l.doc_id, d.doc_id) as doc_id, case when d.doc_id is null then l.s else d.s end as status,
  case when d.doc_id is null then 'untouched' when l.doc_id is null then 'appended' when l.s is not distinct from d.s then 'same' else 'changed' end as change from l full outer join d on l.doc_id = d.doc_id""",
    "q67_packet_index": """select c_mktsegment, count(*) as n, count(*) filter (o_orderstatus = 'F') as n_f, count(*) filter (o_orderstatus = 'O') as n_o, count(*) filter (o_orderstatus = 'P') as n_p
from orders join customer on o_custkey = c_custkey group by 1""",
    "q68_rejections": "select o_orderpriority, count(*) as n_rejected, array_to_string(list_sort(list(distinct substr(o_orderpriority, 3, 10))), ' | ') as reasons from orders where o_orderstatus = 'F' group by 1",
    "q69_merge_graph": """with o as (select o_orderkey as k, case when o_orderkey % 5 = 0 then o_orderkey // 10 end as i, o_orderkey % 11 = 0 as gone from orders),
e as (select l_orderkey as k, list_sort(list(distinct cast(l_partkey as varchar))) as e from lineitem group by 1),
f as (select k, i from o where i is not null and not gone), s as (select i as k, flatten(list(coalesce(e, []) order by f.k)) as m from f left join e on e.k = f.k group by 1),
a as (select o.k, list_concat(coalesce(e.e, []), coalesce(m, [])) as v from o left join e on e.k = o.k left join s on s.k = o.k where i is null and not gone),
d as (select k, (select string_agg(x, ',' order by p) from (select x, min(p) as p from (select unnest(v) as x, unnest(range(len(v))) as p) group by x)) as value from a)
select k as item, coalesce(value, '') as value from d union all select k, 'no_evidence' from a where len(v) = 0
union all select f.k, case when o.k is null then 'missing_leader' when o.gone then 'dropped_leader' else 'nested_merge' end from f left join o on o.k = f.i where o.k is null or o.gone or o.i is not null""",
    "q70_content_signature": """with r as (select doc_id from documents where doc_id % 10 <> 0), g as (select doc_id, doc_id % 5 = 0 as blank, doc_id % 4 = 0 and n_chars <> 0 as old from documents where doc_id % 3 <> 0),
m as (select coalesce(r.doc_id, g.doc_id) as doc_id, r.doc_id as x, case when r.doc_id is null then 'missing' when g.doc_id is null or blank then 'skipped' when old then 'mismatched' else 'applied' end as match from r full outer join g on r.doc_id = g.doc_id)
select doc_id, case when match = 'applied' then 'lead' when x is not null then '' end as role, match from m""",
    "q71_review_tasks": """select o_orderkey, o_orderpriority || '  ' || o_custkey as title from orders where o_orderstatus = 'O' and o_orderpriority = '1-URGENT' and cast(o_custkey as varchar) like '1%'""",
    "q73_value_counts": """select coalesce(nullif(trim(case when doc_id % 3 = 0 then ' ' when doc_id % 7 <> 0 then lang end), ''), 'pending') as value, count(*) as n from documents group by 1""",
    "q74_search_filters": """select c_custkey, array_to_string(t, ',') as terms, list_filter(t, lambda x: x > '2')[1] as later from (
  select c_custkey, any_value(c_name) as name, any_value(c_mktsegment) as seg, list_sort(list(distinct o_orderpriority) filter (o_orderpriority is not null)) as t from customer left join orders on c_custkey = o_custkey group by 1)
where (contains(lower(name), 'customer#00000001') or contains(lower(name || ' ' || seg), 'building')) and len(t) > 0 and list_contains(t, '1-URGENT')""",
    "q75_facet_options": """select s as value, n, s = 'BUILDING' as selected from (select c_mktsegment as s, count(*) filter (c_acctbal > 9990) as n from customer group by 1) where n > 0 or s = 'BUILDING'""",
    "q76_unmapped_lists": "select o_custkey, count(*) as n, string_agg(cast(o_orderkey as varchar), ',' order by o_orderkey) as orders from orders where o_orderkey not in (select l_orderkey from lineitem) group by 1",
    "q77_asset_insight": """select l_partkey, count(distinct l_orderkey) as n_evidence, array_to_string(list_sort(list(distinct o_orderstatus)), ',') as kinds, [2, 1, 0][l_partkey % 3 + 1] as priority
from lineitem join orders on l_orderkey = o_orderkey group by 1""",
    "q78_scalars": """select event_id, strftime(ts, '%Y-%m-%d') as day, cast(json_extract_string(props, '$.k') as bigint) as k, cast(json_extract_string(props, '$.k') as int) as k_map,
  '{"event_type":"' || event_type || '","high":' || case when value > 50 then '"' || event_type || '"' else 'null' end || '}' as json, try_cast(event_type as int) as number, value > 0 as positive, value > 90 as large,
  case when value < 0 then 0 when value >= 100 then 11 else cast(floor(value / 10) as bigint) + 1 end as bucket, to_base64(encode(event_type)) as encoded from events""",
    "q79_turtle": f"""select {_IRI}nation/a/b%20c%2A' || n_nationkey as subject, '<' || {_IRI}nation/a/b%20c%2A' || n_nationkey || '>' || chr(10) || '  ex:inRegion <' || {_IRI}region/' || n_regionkey || '> ;' || chr(10) ||
  '  ex:label "' || n_name || ' \\"x\\"\\n" .' as block from nation""",
    "q80_json_ld": f"""select {_IRI}nation/' || n_nationkey as subject, '{{"@id":"' || {_IRI}nation/' || n_nationkey || '","@type":"Nation","label":"' || n_name || '"' ||
  case when n_nationkey % 2 = 0 then ',"inRegion":"' || {_IRI}region/' || n_regionkey || '"' else '' end || '}}' as node from nation""",
    "q81_adjacency": "select n_regionkey, string_agg(cast(n_nationkey as varchar), ',' order by n_nationkey) as neighbours from nation group by 1",
    "q82_coverage_checks": """with r as (select round(count(*) filter (doc_id in (select doc_id from labels)) / count(*), 4) as ratio from documents),
f as (select 'error' as level, 'no_source' as code, count(*) filter (source is null) as n, null::double as ratio from documents union all select 'warning', 'short_text', count(*) filter (n_chars < 50), null from documents
union all select 'error', 'no_text', count(*) filter (text is null), null from documents
union all select 'warning', 'label_coverage', cast(ratio < 0.9 as int), ratio from r
union all select 'error', 'nations_of_region', count(*), null from (select n_regionkey from nation group by 1 having count(*) <> 5) union all select 'error', 'regions', abs(count(*) - 5), null from region)
select *, case when n = 0 then 'pass' when level = 'error' then 'fail' else 'warn' end as status from f""",
    "q83_contract": """select o_orderkey, 'status' as code from orders where o_orderstatus not in ('F', 'O') union all select o_orderkey, 'price' from orders where not o_totalprice > 1000
union all select o_orderkey, 'priority' from orders where not regexp_matches(o_orderpriority, '^[1-3]-')""",
    "q84_ordered_lists": "select l_orderkey from lineitem group by 1 having list(l_linenumber order by l_linenumber) <> list(l_linenumber order by l_quantity, l_linenumber)",
    "q85_csv_round_trip": """select cast(doc_id as varchar) as id, sha256('a "q", ' || coalesce(text, '')) as sha256 from documents""",
    "q86_json_round_trip": "select l_orderkey as k, l_linenumber as n, l_returnflag as flag from lineitem",
    "q87_named_files": "select cast(o_orderkey as varchar) as o_orderkey, o_orderpriority, c_mktsegment as segment from orders join customer on o_custkey = c_custkey where c_mktsegment in ('BUILDING', 'MACHINERY')",
    "q88_partitioned_sink": "select o_orderstatus, count(*) as n from orders where o_orderstatus <> 'P' group by 1",
    "q90_cascade_counts": """with p as (select * from orders where o_orderstatus = 'P'), d as (select o_orderkey from p where o_orderkey not in (select min(o_orderkey) from p group by o_custkey))
select 'deleted orders' as name, count(*) as n from d union all select 'left orders', (select count(*) from orders) - count(*) from d
union all select 'deleted lineitem', count(*) from lineitem where l_orderkey in (select o_orderkey from d) union all select 'left lineitem', count(*) from lineitem where l_orderkey not in (select o_orderkey from d)
union all select 'aborted', cast(count(*) > 0 as int) from p""",
    "q89_upsert_unique": """with c as (select c_custkey as k, unnest(case when c_custkey % 2 = 0 then [1, 2, 3] else [1, 2] end) as j from customer where c_custkey % 3 = 0),
f as (select k, 'Customer#' || lpad(cast(k + [0, 3, 1][j] as varchar), 9, '0') as n, j, k * 10 + j as seq from c)
select k as c_custkey, n as c_name, cast(j as double) as c_acctbal from f where not exists (select 1 from f g where g.seq > f.seq and (g.k = f.k or g.n = f.n))
union all select c_custkey, c_name, c_acctbal from customer where c_custkey not in (select k from f) and c_name not in (select n from f)""",
    "q91_update_blank_keeps": "select c_custkey, c_name, case when c_custkey % 2 = 0 and c_custkey % 4 <> 0 then 'NEW' else c_mktsegment end as c_mktsegment from customer",
    "q92_load_pack": "select 'region' as name, 3::bigint as n_before, count(*) as n_after from region union all select 'nation', count(*) filter (n_regionkey < 3), count(*) from nation",
    "q94_page_fallback": """with t as (select doc_id, coalesce(text, '') as o, coalesce(case doc_id % 3 when 0 then '' when 1 then left(text, 20) else text end, '') as p from documents),
r as (select *, case when o = '' then null when trim(p) = '' then 'empty_page_text' when length(p) < greatest(80, floor(length(o) * 0.25)) then 'short_page_text' end as reason from t)
select doc_id, reason, sha256(case when reason is null then p else o end) as sha256 from r""",
    "q95_ocr_pages": "select user_id, sha256(string_agg(event_type, chr(10) order by event_id % 7, event_id)) as sha256, round(avg(round(value)), 6) as confidence from events group by 1",
    "q96_taxonomy_ids": """with p as (select p_brand as d, p_type as s, min(p_partkey) as q from part group by all), n as (select d, row_number() over (order by min(q), d) as i from p group by 1)
select d as domain, s as subdomain, 'TD-' || lpad(cast(i as varchar), 3, '0') as domain_id, 'TSD-' || lpad(cast(i as varchar), 3, '0') || '-' || lpad(cast(row_number() over (partition by d order by q, s) as varchar), 3, '0') as subdomain_id from p join n using (d)""",
    "q97_source_assets": "select source, lang, 'AST-' || lpad(cast(row_number() over (order by min(doc_id), source, lang) as varchar), 5, '0') as id from documents group by 1, 2",
    "q98_matrix_detail": f"""with {_TERMS}, r as (select n_name as policy, coalesce(p_type, 'unmapped') as domain, o_custkey, o_orderkey, o_orderstatus = 'F' as f, p_brand from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey left join terms using (o_orderkey)),
c as (select policy, domain, count(distinct o_custkey) as n_groups, count(distinct o_orderkey) as n_contents, count(distinct o_orderkey) filter (f) as n_reviewed from r group by all),
m as (select policy, domain, p_brand, row_number() over (partition by policy, domain order by count(*) desc, p_brand) as rk from r group by policy, domain, p_brand)
select c.*, case when n_reviewed = n_contents then 'reviewed' when n_reviewed = 0 then 'needs_review' else 'mixed' end as status, p_brand as top_strategy from c join m using (policy, domain) where rk = 1""",
    "q99_network_nodes": """with c as (select l_returnflag as p, p_type as d from lineitem join part on l_partkey = p_partkey), n as (select 'policy' as side, p as name, count(*) as weight from c group by p union all select 'domain', d, count(*) from c group by d)
select *, round(least(greatest(sqrt(weight) * 2, 6.0), 48.0), 4) as radius from n""",
}

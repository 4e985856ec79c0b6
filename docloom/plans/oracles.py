"""DuckDB SQL that gives the rows of the catalogue's queries, written independently of them."""

_TERMS = """order_terms as (
  select r_name, o_custkey, o_orderkey, p_type, n_lines from orders
  join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
  left join (select l_orderkey, p_type, count(*) as n_lines from lineitem join part on l_partkey = p_partkey group by all) on l_orderkey = o_orderkey
), cells as (
  select r_name as policy, coalesce(p_type, 'unmapped') as domain, count(distinct o_custkey) as n_groups,
         count(distinct o_orderkey) as n_contents, cast(coalesce(sum(n_lines), 0) as bigint) as n_evidence from order_terms group by all
)"""

_LINES = "lines as (select doc_id, unnest(range(1, len(l) + 1)) as pos, unnest(l) as line from (select doc_id, string_split(text, chr(10)) as l from documents))"


def _has(key: str, word: str) -> str:
    return f"cast(contains({key}, '{word}') as int)"


def _score(terms: list) -> str:
    parts = []
    for i, (name, aliases, policies, lang) in enumerate(terms, 1):
        score = [f"8 * {_has('k', name)}", f"2 * {_has('k', name)}"]
        score += [f"3 * {_has('k', a)} + {_has('k', a)} * {_has('f', a)}" for a in aliases]
        score += [f"4 * cast(contains(k, '{a}') or contains(f, '{a}') as int)" for a in policies]
        score += [f"4 * cast(lang = '{lang}' as int)"] if lang else []
        parts.append(f"{{'label': '{name}', 'display_order': {i}, 'score': cast({' + '.join(score)} as int)}}")
    return f"[{', '.join(parts)}]"


_LANGUAGE = [
    ("the", ["and", "with", "of"], ["ing"], "en"),
    ("les", ["des", "que", "dans"], ["eau"], "fr"),
    ("nicht", ["der", "sch", "und"], ["ung"], "de"),
    ("los", ["una", "por", "del"], ["ción"], "es"),
    ("license", ["copyright", "permission"], [], None),
]
_PART = ", ".join(
    f"{{'label': '{a} {b}', 'display_order': {i}, 'score': cast(6 * {_has('k', a + b)} + 2 * {_has('k', a)} + 2 * {_has('k', b)} as int)}}"
    for i, (a, b) in enumerate([("small", "ring"), ("red", "widget"), ("blue", "bolt"), ("hot", "gear")], 1)
)

_KEYED = "select doc_id, lang, regexp_replace(lower(text), '\\s+', '', 'g') as k, regexp_replace(lower(string_split(text, chr(10))[1]), '\\s+', '', 'g') as f from documents"
_SCORES = f"""scores as (
  select doc_id, s.label as label, s.display_order as display_order, s.score as score from (select doc_id, unnest({_score(_LANGUAGE)}) as s from ({_KEYED})) where s.score > 0
)"""

#: The label and summaries of a collapsed text.
LABEL = """case when length(x) > {0} then rtrim(left(x, {1})) || '...' else x end"""
FIRST = """case when trim(regexp_extract(t, '\\(([^()]+)\\)', 1)) <> '' then trim(regexp_extract(t, '\\(([^()]+)\\)', 1)) else trim(regexp_split_to_array(regexp_replace(t, '^(?:[-*•□○ㅇ▪]\\s*)+', ''), '[,:;]')[1]) end"""
AGAIN = """trim(regexp_split_to_array(regexp_replace(t, '^(?:[-*•□○ㅇ▪]\\s*)+', ''), '[,.·;:]')[1])"""

_CLIP = "case when length({0}) > {1} then left({0}, {1} - 1) || '…' else {0} end"

SQL = {
    "q07_line_blocks": r"""with l as (
  select doc_id, [y for y in [trim(regexp_replace(replace(replace(x, chr(160), ' '), chr(61440), '- '), '[ \t]+', ' ', 'g')) for x in string_split(text, chr(10))] if y <> ''] as l from documents
), u as (select doc_id, unnest(range(0, len(l))) as i, unnest(l) as line from l)
select doc_id, cast(100 + i as bigint) as line_order, line, line[1] = '|' and len(line) - len(replace(line, '|', '')) >= 2 as is_table,
       regexp_full_match(line, '- ?[0-9]+ ?-') as is_footer from u""",
    "q08_block_classify": r"""with e as (
  select page_id, unnest(range(1, len(l) + 1)) as pos, unnest(l) as e from (select page_id, regexp_extract_all(html, '<(?:h1|li|p)(?: [^>]*)?>[^<]*') as l from pages)
), t as (select page_id, pos, trim(substr(e, strpos(e, '>') + 1)) as text, regexp_extract(e, '^<([a-z0-9]+)', 1) as tag from e)
select page_id, pos, text, case when tag = 'h1' or length(text) <= 12 then 'heading' when regexp_matches(text, '^\[[0-9]+\]') then 'citation'
  when text ilike 'note%' or text like '*%' then 'note' when tag = 'li' or text like '-%' or text like '•%' then 'bullet' else 'paragraph' end as block_type from t""",
    "q27_exception_block": f"""with {_SCORES}, r as (
  select *, row_number() over (partition by doc_id order by score desc, display_order) as k, count(*) over (partition by doc_id) as n_terms from scores
) select doc_id, label, score, n_terms from r where k = 1 and label <> 'license'""",
    "q45_adapter_rows": """select o_orderkey, lower(c_name || ' ' || c_mktsegment || ' ' || o_orderpriority || ' ' || o_orderstatus) as search_text,
  case when exists (select 1 from lineitem where l_orderkey = o_orderkey) and not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_linestatus <> 'F')
       then 'reviewed' else 'needs_review' end as review_status, p.preferred_line
from orders join customer on o_custkey = c_custkey left join (
  select l_orderkey, arg_min(l_linenumber, case l_returnflag when 'R' then 0 when 'A' then 100 else 200 end + l_linenumber) as preferred_line from lineitem group by l_orderkey
) p on p.l_orderkey = o_orderkey""",
    "q52_projection_validate": """with g as (select l_orderkey, list(l_linenumber order by l_linenumber) as l from lineitem group by l_orderkey), f as (
  select 'error' as level, 'assigned_and_unassigned' as code, count(*) as n from (
    (select o_orderkey from orders where o_orderkey in (select l_orderkey from g)) intersect (select o_orderkey from orders where o_orderkey not in (select l_orderkey from g)))
  union all select 'warning', 'unassigned', count(*) from orders where o_orderkey not in (select l_orderkey from g)
  union all select 'error', 'line_key_repeated', count(*) from g where len(list_distinct(l)) <> len(l)
  union all select 'error', 'lines_out_of_order', count(*) from g where l[1] <> 1 or l[-1] <> len(l)
) select *, case when n = 0 then 'pass' when level = 'error' then 'fail' else 'warn' end as status from f""",
    "q56_bbox_overlap": """with b as (select l_orderkey, l_linenumber, l_returnflag, l_quantity as x0, l_linenumber * 10.0::double as y0, l_quantity + 10 as x1, l_linenumber * 10.0::double + 8 as y1 from lineitem),
t as (select l_orderkey, min(x0) as table_x0, min(y0) as table_y0, max(x1) as table_x1, max(y1) as table_y1 from b where l_returnflag = 'R' group by l_orderkey)
select l_orderkey, l_linenumber, table_x0, table_y0, table_x1, table_y1 from b join t using (l_orderkey)
where x0 < table_x1 and x1 > table_x0 and y0 < table_y1 and y1 > table_y0
  and (least(x1, table_x1) - greatest(x0, table_x0)) * (least(y1, table_y1) - greatest(y0, table_y0)) >= 0.35 * 80""",
    "q01_matrix_policy_domain": f"with {_TERMS} select *, cast((200 * n_contents + max(n_contents) over ()) // (2 * max(n_contents) over ()) as bigint) as intensity from cells",
    "q02_facets_leave_one_out": """with r as (
  select o_orderkey, c_mktsegment as seg, o_orderstatus as st from orders join customer on o_custkey = c_custkey
), t as (select distinct l_orderkey as k, p_type from lineitem join part on l_partkey = p_partkey),
promo as (select k from t where p_type = 'PROMO')
select 'segment' as facet, seg as value, count(*) as n from r where st = 'F' and o_orderkey in (select k from promo) group by seg
union all select 'status', st, count(*) from r where seg = 'BUILDING' and o_orderkey in (select k from promo) group by st
union all select 'type', p_type, count(*) from r join t on k = o_orderkey where seg = 'BUILDING' and st = 'F' group by p_type""",
    "q03_filter_sorted_rows": """select o_orderkey, c_name, o_totalprice from orders join customer on o_custkey = c_custkey
where o_orderstatus = 'F' and c_mktsegment = 'BUILDING' and o_orderpriority in ('1-URGENT', '2-HIGH') order by o_totalprice desc, o_orderkey limit 12""",
    "q04_overview_ratio": """select category, n, n_urgent, cast((200 * n_urgent + n) // (2 * n) as bigint) as percent from (
select c_mktsegment as category, count(*) as n, count(*) filter (o_orderpriority = '1-URGENT') as n_urgent from orders join customer on o_custkey = c_custkey group by 1)""",
    "q05_status_rollup": """select c_custkey, n as n_contents, r as n_reviewed,
case when n = 0 then 'empty' when r = n then 'reviewed' when r = 0 then 'needs_review' else 'mixed' end as status
from (select c_custkey, count(o_orderkey) as n, count(*) filter (o_orderstatus = 'F') as r from customer left join orders on o_custkey = c_custkey group by 1)""",
    "q06_network_edges": f"with {_TERMS} select policy, domain, n_contents as weight, round(least(greatest(sqrt(n_contents) * 1.5, 4.0), 40.0), 4) as radius from cells where domain <> 'unmapped'",
    "q09_unit_split_islands": f"""with {_LINES}, m as (select doc_id, pos, pos - row_number() over (partition by doc_id order by pos) as island from lines where length(line) <= 25)
select doc_id, min(pos) as first, count(*) as n from m group by doc_id, island having count(*) >= 2""",
    "q12_dedup_repeated_lines": f"""with {_LINES}, f as (select doc_id, line, min(pos) as p, count(*) as c from lines group by all)
select doc_id, cast(sum(c) as bigint) as n_lines, count(*) as n_kept, sha256(string_agg(line, chr(10) order by p)) as kept_sha256 from f group by doc_id""",
    "q13_label_summary": f"""with c as (select doc_id, trim(regexp_replace(string_split(text, chr(10))[1], '\\s+', ' ', 'g')) as t, trim(regexp_replace(text, '\\s+', ' ', 'g')) as w from documents),
a as (select *, {FIRST} as y from c), b as (select *, case when length(y) < 2 then {AGAIN} else y end as x from a)
select doc_id, {LABEL.format(48, 45)} as label, {LABEL.format(60, 57).replace("x", "y").replace("case when length(y)", "case when length(y)")} as merge_label,
  case when length(w) > 150 then rtrim(left(w, 147)) || '...' else w end as summary_short, case when length(w) > 180 then rtrim(left(w, 177)) || '...' else w end as summary_reviewed,
  case when length(w) > 220 then left(w, 217) || '...' else w end as summary_preview, case when length(w) > 180 then rtrim(left(w, 179)) || '…' else w end as summary_proxy,
  coalesce(nullif(trim(regexp_replace(lower(t), '[^0-9a-z가-힣]+', '-', 'g'), '-'), ''), 'item') as slug from b""",
    "q14_matchkey": """with k as (select doc_id, text, regexp_replace(lower(text), '\\s+', '', 'g') as k from documents)
select doc_id, length(k) as key_chars, sha256(k) as key_sha256, length(k) as compare_chars,
  len(list_distinct([w for w in regexp_split_to_array(lower(text), '[^0-9a-z가-힣]+') if length(w) >= 2 and regexp_full_match(w, '[a-z0-9]+')])) as n_keywords from k""",
    "q17_keyword_score": f"with {_SCORES} select * from scores",
    "q18_top2_margin": f"""with {_SCORES}, t as (select *, max(score) over (partition by doc_id) as top from scores),
r as (select *, row_number() over (partition by doc_id order by score desc, display_order) as rk from t where score >= greatest(4, top - 2))
select doc_id, label, display_order, score, cast(rk as int) as rank, cast(rk = 1 as int) as is_primary, case when score >= 10 then 'high' else 'medium' end as confidence,
  case when score >= 10 then 'high' when score >= 6 then 'medium' when score >= 4 then 'low' end as paragraph_confidence from r where rk <= 2""",
    "q19_top3_suggest": f"""with {_SCORES}, r as (select *, row_number() over (partition by doc_id order by score desc, display_order) as rk from scores)
select doc_id, max(label) filter (rk = 1) as suggested, max(label) filter (rk = 2) as alternate_1, max(label) filter (rk = 3) as alternate_2 from r group by doc_id""",
    "q20_subdomain_infer": f"""with s as (select p_partkey, unnest([{_PART}]) as s from (select p_partkey, regexp_replace(lower(p_name), '\\s+', '', 'g') as k from part)),
r as (select p_partkey, s.label as label, s.score as score, row_number() over (partition by p_partkey order by s.score desc, s.display_order) as rk from s where s.score > 0)
select p_partkey, label, score from r where rk = 1""",
    "q21_resource_unique_max": """with h as (select doc_id,
  cast(contains(t, 'license') as int) + cast(contains(t, 'copyright') as int) as a,
  cast(contains(t, '@') as int) + cast(contains(t, '+') as int) as b,
  cast(contains(t, '***') as int) + cast(contains(t, '###') as int) + cast(contains(t, '%%%') as int) as c
  from (select doc_id, lower(text) as t from documents)
), n as (select doc_id, case when a > b and a > c then 'legal' when b > a and b > c then 'personal' when c > a and c > b then 'junk' end as resource, greatest(a, b, c) as hits from h)
select *, case when resource is null then 'none' when hits >= 2 then 'high' else 'medium' end as confidence from n""",
    "q22_candidate_gate_lag": f"""with {_LINES}, b as (select *, lag(line) over (partition by doc_id order by pos) as prev from lines)
select doc_id, pos, case when regexp_matches(line, '[*#%$]{{3}}') then 'no' when contains(lower(line), 'licen') then 'review' when length(line) < 10 then 'review'
  when length(line) <= 25 and length(coalesce(prev, '')) <= 25 then 'no' else 'yes' end as candidate from b""",
    "q23_heading_carry_forward": f"""with {_LINES}, h as (
  select doc_id, pos, length(line) <= 25 as is_short, last_value(case when length(line) <= 25 then line end ignore nulls) over (partition by doc_id order by pos rows between unbounded preceding and 1 preceding) as heading from lines
) select doc_id, pos, heading from h where not is_short""",
    "q28_decision_key": f"""with c as (select *, trim(regexp_replace(string_split(text, chr(10))[1], '\\s+', ' ', 'g')) as t from documents),
a as (select *, {FIRST} as y from c), b as (select *, case when length(y) < 2 then {AGAIN} else y end as x from a), n as (select *, {LABEL.format(48, 45)} as name from b)
select doc_id, 'SRD-' || source || '-' || left(sha1(source || '|' || lang || '|' || doc_id || '|' || regexp_replace(lower(name), '\\s+', '', 'g')), 12) as decision_key,
  'TLR-' || lang || '-' || left(sha1(lang || '|' || source || '||' || doc_id || ' | a | b'), 12) as lens_key from n""",
    "q29_review_queue_double_anti": """select doc_id, source from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id and quality = 1)
and not exists (select 1 from labels l where l.doc_id = d.doc_id and toxic = 1)""",
    "q30_ledger_reconcile": """with q as (select doc_id, n_chars from documents where n_chars > 500), l as (select doc_id, quality = 1 as done from labels)
select coalesce(q.doc_id, l.doc_id) as doc_id, n_chars, q.doc_id is not null as active,
case when coalesce(done, false) then 'approved' when n_chars > 5000 then 'auto_seeded' else 'pending' end as status
from q full outer join l on q.doc_id = l.doc_id where q.doc_id is not null or done""",
    "q31_apply_decisions": """select l.doc_id, case when quality = 0 and toxic = 1 then 'invalid_decision' when d.doc_id is null then 'missing_target' else 'applied' end as outcome
from labels l left join (select doc_id from documents where lang = 'en') d on d.doc_id = l.doc_id""",
    "q32_batch_edit_first_wins": "select conv_id, role, min(turn) as turn, count(*) - 1 as n_beaten from conversations group by conv_id, role",
    "q33_packet_chunks": """with r as (select c_mktsegment, o_orderstatus, row_number() over (partition by c_mktsegment order by o_totalprice desc, o_orderkey) as rk from orders join customer on o_custkey = c_custkey)
select c_mktsegment as packet, (rk - 1) // 40 + 1 as batch, count(*) as n, count(*) filter (o_orderstatus = 'F') as n_f, count(*) filter (o_orderstatus = 'O') as n_o, count(*) filter (o_orderstatus = 'P') as n_p from r group by 1, 2""",
    "q34_brief_topk": """with c as (select p_type, p_brand, count(*) as n, min(p_partkey) as seen from part group by 1, 2),
r as (select *, row_number() over (partition by p_type order by n desc, seen, p_brand) as place from c) select p_type, p_brand, n, cast(place as int) as place from r where place <= 5""",
    "q35_priority_rank": "select o_orderkey, row_number() over (order by o_totalprice desc, o_orderkey) as priority_rank from orders",
    "q36_upsert_replace": "select c_custkey, case when c_acctbal < 0 then 'REVIEW' else c_mktsegment end as c_mktsegment, case when c_acctbal < 0 then 0.0::double else c_acctbal end as c_acctbal from customer",
    "q37_slice_delete_guard": "select o_orderkey, o_orderstatus from orders where o_orderstatus <> 'P' or o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R')",
    "q38_backlog_lattice": """with r as (select source, n_chars, case when quality is null then 'unreviewed' when toxic = 1 then 'blocked' when quality = 1 then 'done' else 'rework' end as status
from documents left join labels using (doc_id))
select source, status, case status when 'blocked' then 0 when 'rework' then 1 when 'unreviewed' then 2 else 3 end as priority, count(*) as n, cast(sum(n_chars) as bigint) as chars from r group by 1, 2, 3""",
    "q39_source_assets": "select source, lang, min(doc_id) as first_doc, count(*) as n_docs, count(distinct text) as n_texts from documents group by 1, 2",
    "q40_flat_export_nested": """select n_name, c_custkey, coalesce(string_agg(cast(o_orderkey as varchar), ',' order by o_orderkey), '') as order_keys
from customer join nation on c_nationkey = n_nationkey left join orders on o_custkey = c_custkey group by 1, 2""",
    "q42_lens_provisional_fill": """with a as (select *, row_number() over (partition by p_type, p_brand, p_size order by p_retailprice desc, p_partkey) > 1 as later from part),
b as (select *, row_number() over (partition by p_type order by later, p_retailprice desc, p_partkey) as place from a) select p_type, p_partkey, cast(place as int) as place from b where place <= 20""",
    "q43_lens_domain_rollup": """select p_type as domain, count(distinct l_suppkey) as n_groups, count(*) as n_contents, count(distinct p_brand) as n_terms, count(*) filter (l_returnflag = 'R') as n_returned
from lineitem join part on l_partkey = p_partkey group by 1""",
    "q44_draft_pack_quota": """with d as (select p_brand from part group by 1 order by min(p_partkey), 1 limit 6),
r as (select p_brand, p_partkey, row_number() over (partition by p_brand order by p_size desc, p_partkey) as place from part where p_brand in (select p_brand from d))
select p_brand, p_partkey, cast(place as int) as place from r where place <= 3""",
    "q46_best_evidence": """with r as (select *, row_number() over (partition by l_orderkey order by (l_returnflag = 'R') desc, l_quantity desc, l_extendedprice desc, l_linenumber, l_partkey) as rk from lineitem)
select l_orderkey, l_partkey, l_quantity from r where rk = 1""",
    "q47_briefing_tone": f"""with {_TERMS}, m as (select policy, domain, n_contents / (sum(n_contents) over (partition by domain) / count(*) over (partition by domain)) as ratio from cells)
select policy, domain, case when ratio >= 1 then 'full' when ratio >= 0.66 then 'strong' when ratio >= 0.33 then 'some' else 'weak' end as tone from m""",
    "q48_triples": """with b as (select 'http://example.org/docloom/resource/' as p)
select p || 'region/' || r_regionkey as subject, 'label' as predicate, r_name as object from region, b
union all select p || 'nation/' || n_nationkey, 'label', n_name from nation, b
union all select p || 'nation/' || n_nationkey, 'inRegion', p || 'region/' || n_regionkey from nation, b
union all select p || 'customer/' || c_custkey, 'label', c_name from customer, b
union all select p || 'customer/' || c_custkey, 'inNation', p || 'nation/' || c_nationkey from customer, b
union all select p || 'customer/' || c_custkey, 'segment', p || 'segment/' || c_mktsegment from customer, b""",
    "q49_induced_closure": """with n as (select n_nationkey as id from nation where n_regionkey in (1, 3)), c as (select c_custkey as id from customer where c_nationkey in (select id from n))
select 'nation' as kind, cast(id as bigint) as id from n union all select 'customer', id from c union all select 'order', o_orderkey from orders where o_custkey in (select id from c)""",
    "q50_shape_check": """select 'http://example.org/docloom/resource/order/' || o_orderkey as subject, 'hasPart' as path, count(l_orderkey) as n from orders left join lineitem on l_orderkey = o_orderkey
group by o_orderkey having count(l_orderkey) < 1 or count(l_orderkey) > 7""",
    "q51_store_validate": """with f as (
select 'warning' as level, 'order_without_line' as code, count(*) as n from orders where o_orderkey not in (select l_orderkey from lineitem)
union all select 'error', 'line_without_order', count(*) from lineitem where l_orderkey not in (select o_orderkey from orders)
union all select 'error', 'line_without_part', count(*) from lineitem where l_partkey not in (select p_partkey from part)
union all select 'error', 'line_without_supplier', count(*) from lineitem where l_suppkey not in (select s_suppkey from supplier)
union all select 'error', 'customer_without_nation', count(*) from customer where c_nationkey not in (select n_nationkey from nation)
union all select 'warning', 'document_without_label', count(*) from documents where doc_id not in (select doc_id from labels)
union all select 'error', 'order_key_repeated', count(*) from (select o_orderkey from orders group by 1 having count(*) > 1))
select *, case when n = 0 then 'pass' when level = 'error' then 'fail' else 'warn' end as status from f""",
    "q55_unpivot_taxonomy": """select 'p_brand' as taxonomy, p_brand as term, count(*) as n, min(p_partkey) as first_part from part group by p_brand
union all select 'p_type', p_type, count(*), min(p_partkey) from part group by p_type""",
    "q57_overlay_decisions": "select d.doc_id, case when toxic = 1 then 'toxic' else source end as source from documents d left join labels l on l.doc_id = d.doc_id",
    "q58_manifest_sha256": "select doc_id, cast(strlen(text) as bigint) as n_bytes, sha256(text) as sha256 from documents",
}

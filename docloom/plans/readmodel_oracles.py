"""DuckDB SQL for the queries of ``readmodel``, and for ``q61`` of ``evidence``."""

_LINES = "select doc_id, unnest(range(0, len(s))) as pos, unnest(s) as line from (select doc_id, string_split(text, chr(10)) as s from documents where text is not null)"
_FLAT = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"
_END = "unicode(right(c, 1)) between 44032 and 55203 and (unicode(right(c, 1)) - 44032) % 28 <> 0"
_MARKS = r"❶❷❸❹❺❻❼❽❾❿➊➋➌➍➎➏➐➑➒➓ㅇ□▪•*\-"
_CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳❶❷❸❹❺❻❼❽❾❿"
_CONTENT = "select o.o_custkey, o.o_orderkey, o.o_orderpriority, l.* from orders o join lineitem l on o_orderkey = l_orderkey"


def _has(*words: str) -> str:
    return "(" + " or ".join(f"contains(x, '{w}')" for w in words) + ")"


_ACTS = _has("for", "is", "that")
_ROLES = [
    (f"{_has('the')} and {_has('whst')}", "regulatory_delta", "detected_current_to_improvement_pattern"),
    (_has("nicht", "eau"), "meta_program_frame", "detected_program_frame_keyword"),
    (f"length(x) <= 30 and {_has('of', 'de')}", "meta_program_frame", "detected_short_meta_bullet"),
    ("regexp_matches(x, '(?i)on') and regexp_matches(x, '[“\"]')", "case_example", "detected_case_example_quote"),
    ("starts_with(x, 'Is')", "policy_action", "detected_improvement_direction_prefix"),
    (f"{_has('and')} and not {_has('that')}", "background_context", "detected_background_keyword"),
    (_has("ttion", "sch"), "problem_or_requirement", "detected_problem_keyword"),
    (f"{_has('un', 're')} and {_ACTS}", "policy_action", "detected_soft_problem_but_action_overrides"),
    (_has("un", "re"), "problem_or_requirement", "detected_problem_keyword"),
    (f"regexp_matches(x, '[Ee]n') and {_ACTS}", "policy_action", "detected_need_phrase_but_action_overrides"),
    ("regexp_matches(x, '[Ee]n')", "problem_or_requirement", "detected_need_phrase"),
]


def _case(of: int, default: str) -> str:
    return "case " + " ".join(f"when {r[0]} then '{r[of]}'" for r in _ROLES) + f" else '{default}' end"


SQL = {
    "q61_provisional_fill": """with p as (
  select *, row_number() over (partition by p_type, p_brand order by case when p_size > 40 then 0 when p_size > 20 then 1 else 2 end, p_size, -floor(p_retailprice), p_partkey) > 1 as later from part
), r as (
  select *, row_number() over (partition by p_type order by later, case when p_size > 40 then 0 when p_size > 20 then 1 else 2 end, p_size, -floor(p_retailprice), p_partkey) as place from p
), s as (
  select *, length(p_type) % 3 as n from r
)
select 'PIG-PROV-' || p_partkey as group_id, 'PIC-PROV-' || p_partkey as content_id, p_name as group_label, p_brand as group_summary, 'provisional_auto' as status,
       cast(case when n = 0 then 0 else 2 end + place as bigint) as display_order
from s where place <= case n when 0 then 6 when 1 then 4 else 0 end""",
    "q62_domain_rollup_maps": """with t as (
  select l_orderkey as o_orderkey, p_type, l_linenumber, cast(l_returnflag = 'R' as int) as is_primary from lineitem join part on l_partkey = p_partkey
), r as (
  select t.*, o_custkey, o_orderpriority, o_orderkey * 10 + l_linenumber as seq from t join orders using (o_orderkey)
), b as (
  select p_type as domain, count(distinct o_orderkey) as n_groups, count(distinct seq) as n_contents, count(distinct o_custkey) as n_policies, count(distinct o_orderkey) filter (is_primary = 1) as n_primary,
         arg_max(o_orderkey, seq) filter (o_orderpriority = '1-URGENT') as last_urgent from r group by p_type
)
select *, case when n_groups = 0 then 'empty' when n_primary = 0 then 'seed' when n_primary < 6 then 'expand' else 'covered' end as stage from b""",
    "q114_label_forms": rf"""with l as (
  {_LINES}
), v as (
  select doc_id, pos, ['', '①② ', '- ', '○ - '][(doc_id + pos) % 4 + 1] || line || ['', '가', '각', '정책2'][(doc_id + pos) // 4 % 4 + 1] as v,
         {_FLAT.format("['', cast(pos as varchar), 'section' || pos, 'Page ' || pos, line][(doc_id + pos) % 5 + 1]")} as p, trim(['image 3', '', 'figure', 'Image_12', line][(doc_id + pos) % 5 + 1]) as g from l
), c as (
  select *, {_FLAT.format("v")} as c, regexp_replace(p, '[^0-9]', '', 'g') as n from v
)
select doc_id, pos, sha256(regexp_replace(regexp_replace(v, '([가-힣])([A-Za-z0-9])', '\1 \2', 'g'), '([A-Za-z0-9])([가-힣][가-힣])', '\1 \2', 'g')) as spaced_sha256,
       sha256(trim(regexp_replace(c, '^(?:(?:[ㅇ○□-] |[➊➋①②③])\s*)+', ''))) as plain_sha256,
       c = '' or regexp_matches(c, '^(?:(?:[ㅇ○□-] |[➊➋①②③])|\()') or length(c) >= 45 and length(c) - length(replace(c, ' ', '')) <= 3 as raw,
       case when c <> '' and {_END} then '은' else '는' end as topic, case when c <> '' and {_END} then '을' else '를' end as object,
       sha256(case when p = '' then '위치 정보 확인' when regexp_matches(p, '^[0-9]+$') then n || '쪽'
              when starts_with(lower(p), 'section') then case when n = '' then '문서 위치' when cast(n as hugeint) <= 1 then '문서 앞부분' when cast(n as hugeint) <= 3 then '문서 중간' else '문서 후반부' end
              when starts_with(lower(p), 'page') then case when n = '' then '페이지' else n || '쪽' end else p end) as place_sha256,
       regexp_matches(g, '(?i)^(?:image[ _-]*[0-9]*)?$') as generic
from c""",
    "q115_line_rules": rf"""with l as (
  {_LINES}
), v as (
  select doc_id, pos, ['12', '① ', '-', 'p. 7', line || ' ① (' || line || ')', replace(line, '*', chr(57344)), line, '- 3 -'][(doc_id + pos) % 8 + 1] as v from l
)
select doc_id, pos, case when trim(v) = '' then 'empty' when regexp_matches(v, '^[{_MARKS} ]+$') and regexp_matches(v, '[{_MARKS}]') then 'noise' when regexp_matches(v, '^[-–—]?\s*\d+\s*[-–—]?$') then 'footer'
       when pos % 20 * 50 >= 920 and length(v) <= 12 and regexp_matches(v, '\d') then 'footer' when (doc_id + pos) % 10 >= 7 then 'table_overlap' else '' end as skip,
       cast(len(regexp_extract_all(v, '\S\s+[{_CIRCLED}]\s*\(')) + 1 as bigint) as n_sections, sha256(regexp_replace(v, '\p{{Co}}', '-', 'g')) as text_sha256
from v""",
    "q116_markdown_runs": rf"""with l as (
  {_LINES}
), m as (
  select doc_id, pos, trim(regexp_replace(replace(replace(case when (doc_id + pos) % 5 < 2 then '| a | ' || line || ' |' when (doc_id + pos) % 7 = 3 then '' else line end, chr(160), ' '), chr(61440), '- '), '[ \t]+', ' ', 'g')) as x from l
), k as (
  select *, regexp_matches(x, '^\|[^|]*\|') as t, lag(x) over w as px from m window w as (partition by doc_id order by pos)
), g as (
  select *, sum(case when px is null or x = '' or px = '' or t <> regexp_matches(px, '^\|[^|]*\|') then 1 else 0 end) over (partition by doc_id order by pos) as g from k
)
select doc_id, row_number() over (partition by doc_id order by g) as pos, case when bool_or(t) then 'table' else 'text' end as kind, sha256(string_agg(x, chr(10) order by pos)) as text_sha256
from g where x <> '' group by doc_id, g""",
    "q117_figures": """with f as (
  select user_id, event_id, case when event_id % 3 = 0 then 'skip' when event_id % 5 in (0, 4) then 'decorative' when event_id % 5 in (1, 3) or event_id % 2 = 0 then 'evidence_figure' else 'review_required' end as figure_class,
         case when event_id % 3 = 1 then 'high' when event_id // 3 % 3 = 0 then 'reviewed' when event_id // 3 % 3 = 1 then 'rejected' else 'raw' end as quality from events
)
select * from f where user_id is null or user_id not in (select user_id from f where event_id % 50 = 0 and user_id is not null)
union all select user_id, event_id, figure_class, 'checked' from f where event_id % 50 = 0""",
    "q118_seeded_tables": """with q as (
  select distinct l_orderkey as doc_id, concat_ws('-', l_linenumber, l_partkey, l_suppkey) as table_id, case l_returnflag when 'R' then 'layout_false_positive' when 'A' then 'structured_table' else 'review_required' end as table_class,
         cast(case when l_linenumber % 3 = 0 or l_linenumber < 2 then 0 else l_linenumber - 1 end as bigint) as n_rows, cast(case when l_linenumber % 3 = 0 or l_linenumber < 2 then 0 else 2 end as bigint) as n_cols from lineitem
), c as (
  select doc_id, table_id, printf('TBL-%d-%03d', doc_id, row_number() over (partition by doc_id order by table_id)) as canonical_id from q where table_class = 'structured_table'
)
select q.*, case table_class when 'layout_false_positive' then 'rejected' when 'structured_table' then 'accepted' else 'pending' end as decision, canonical_id from q left join c using (doc_id, table_id)""",
    "q119_statement_roles": f"""with l as (
  {_LINES}
), t as (select case when pos % 6 = 1 then '“' || line || '”' else line end as x from l)
select {_case(1, 'policy_action')} as role, {_case(2, '')} as note, count(*) as n from t group by all""",
    "q120_rolled_up": """with l as (
  select l_orderkey, l_linenumber * 1000000 + l_partkey as k, l_returnflag as f, [l_returnflag, 'P' || l_partkey % 3, 'S' || l_suppkey % 2] as m from lineitem
), o as (select *, row_number() over (partition by l_orderkey order by k, m) as r from l), e as (
  select l_orderkey, unnest(m) as x, r * 10 + unnest([1, 2, 3]) as p from o
), d as (select l_orderkey, x, min(p) as p from e group by all)
select l_orderkey, (select string_agg(x, ',' order by p) from d where d.l_orderkey = o.l_orderkey) as marks, string_agg(f, ' ' order by k, f) as flags from o group by l_orderkey""",
    "q121_lens_sync": """with q as (select o_orderkey, o_custkey from orders where o_orderstatus = 'O'), l as (
  select o_orderkey, ['approved', 'pending', 'revised'][o_orderkey // 3 % 3 + 1] as status, ['', 'seen', ' '][o_orderkey // 9 % 3 + 1] as notes from orders where o_orderkey % 3 = 0
), b as (
  select o_orderkey, o_custkey, l.status, l.notes, q.o_orderkey is not null as active, coalesce(l.status in ('approved', 'revised') or trim(l.notes) <> '', false) as keep from q full join l using (o_orderkey)
), a as (select distinct o_orderkey, o_custkey, status, notes, active, keep from b)
select o_orderkey, active, case when keep then status else 'pending' end as status, notes, o_custkey,
       case when o_orderkey % 4 = 0 and o_orderkey % 3 > 0 and o_orderkey // 4 % 2 = 1 then 'high' when o_orderkey % 4 = 0 or o_orderkey % 3 > 0 then 'medium' else 'low' end as priority,
       ['keep', 'attach', 'demote', 'review'][o_orderkey % 4 + 1] as action, case when o_orderkey % 3 = 1 then 'E1,E2' when o_orderkey % 2 = 0 then 'E7,E9' else 'E9' end as exceptions
from a where active or keep""",
    "q122_regrouped_pack": """with r as (
  select l_suppkey as policy, l_partkey % 20 as g, min({'a': l_orderkey * 10 + l_linenumber, 'd': l_returnflag}) as x from lineitem group by all
)
select policy, cast(row_number() over (partition by policy order by x.a, g, x.d) - 1 as int) as place, x.a as seq, g as "group", x.d as domain from r""",
    "q123_written_texts": """with e as (
  select doc_id, text, case when doc_id % 4 > 0 then lang end as lang, replace(replace(replace(replace(replace(replace(coalesce(text, ''), chr(10), ' '), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') as h from documents
)
select 'json' as form, doc_id, sha256(concat_ws('|', text, coalesce(lang, '-'))) as sha256 from e union all select 'html', doc_id, sha256('<li>' || doc_id || '|' || h || '</li>') from e""",
    "q124_policy_views": f"""with c as ({_CONTENT} where l_quantity > 10)
select o_custkey, count(distinct o_orderkey) as n_groups, count(*) as n_contents, least(count(*), 25) as n_visible, count(*) filter (l_returnflag = 'N') as n_curated, count(*) filter (l_returnflag <> 'N') as n_provisional,
       case when count(*) filter (l_returnflag = 'N') = 0 then 'provisional' when count(*) filter (l_returnflag <> 'N') = 0 then 'curated' else 'mixed' end as projection
from c group by o_custkey""",
    "q125_bucket_signals": f"""with c as ({_CONTENT})
select o_custkey, o_orderpriority, count(distinct o_orderkey) as n_groups, count(*) as n_contents, count(distinct o_orderkey) filter (l_quantity > 40) as n_matched_groups, count(*) filter (l_quantity > 40) as n_matched_contents from c group by all""",
    "q126_selection": """with w as (select *, o_custkey % 3 = 0 and o_orderkey = max(o_orderkey) over (partition by o_custkey) as hit from orders), o as (
  select o_custkey, o_orderkey, hit, row_number() over (partition by o_custkey order by hit desc, o_totalprice desc, o_orderkey) as r from w
), s as (
  select o_custkey, o_orderkey, hit as found from o where r = 1
)
select *, 'order=' || o_orderkey || ['', '&view=grid+%26+more', '&view=bad'][o_custkey % 3 + 1] as state, ['list', 'grid & more', 'list'][o_custkey % 3 + 1] as view, cast(o_orderkey as varchar) as read_order, '1' as page from s""",
    "q127_supporting_blocks": rf"""with k as (
  select distinct lower(w) as key from (select unnest(regexp_extract_all(text, '[A-Za-z]{{5,}}')) as w from benchmark)
), b as (
  select doc_id, pos, regexp_replace(lower(line), '\s+', '', 'g') as t from ({_LINES})
), s as (
  select b.doc_id, pos, count(*) - max(case when key = lower(regexp_extract(d.text, '[A-Za-z]{{5,}}')) then 1 else 0 end) as score from b join k on length(t) >= 20 and contains(t, key) join documents d on d.doc_id = b.doc_id group by all
), r as (select *, row_number() over (partition by doc_id order by score desc, pos) as rank from s)
select doc_id, cast(rank as int) as rank, pos as block_id, score from r where rank <= 2""",
    "q128_backlog": """with n as (select l_orderkey as o_orderkey, count(*) as n_lines from lineitem group by all), r as (
  select o_orderkey, o_orderstatus, n_lines, ['low', 'none', 'high', 'medium', 'odd'][o_orderkey % 5 + 1] as priority from orders join n using (o_orderkey)
)
select * from r order by [2, 3, 0, 1, 4][o_orderkey % 5 + 1], o_orderstatus, n_lines desc, o_orderkey limit 20""",
    "q129_catalogue_grid": """with g as (
  select c_custkey, unnest(['technology', 'infrastructure_institutional', 'talent']) as category, unnest([0, 1, 2]) as at from customer
), b as (
  select o_custkey, cast(o_orderpriority[1] as int) - 1 as at, count(*) as n, coalesce(min(o_orderkey) filter (o_orderkey % 5 > 0), 0) as least, coalesce(max(o_orderkey) filter (o_orderkey % 5 > 0), 0) as most from orders group by all
)
select c_custkey, category, c_custkey * 3 + g.at + 1 as number, n, least, most from g left join b on o_custkey = c_custkey and b.at = g.at""",
    "q130_rebuilt_ledger": """with d as (
  select l_orderkey, arg_max(l_partkey, l_linenumber * 1000000 + l_partkey) as p from lineitem where l_returnflag = 'R' group by all
)
select cast(o_orderkey as varchar) as o_orderkey, o_orderstatus, case when o_orderstatus = 'F' then o_orderpriority else '' end as o_orderpriority, coalesce(cast(p as varchar), '') as l_partkey, '' as note
from orders left join d on l_orderkey = o_orderkey where o_orderstatus in ('O', 'F')""",
    "q131_located_assets": f"""with p as (select doc_id, pos // 20 as place, min(doc_id * 1000000 + pos) as s from ({_LINES}) group by all)
select doc_id, place, printf('AST-%02d', row_number() over (order by s, doc_id, place)) as id from p""",
    "q132_last_decisions": """with d as (select l_orderkey, max({'s': l_linenumber * 1000000 + l_partkey, 'f': l_returnflag}).f as f from lineitem where l_returnflag <> 'N' group by all)
select o_orderkey, coalesce(f, o_orderstatus) as o_orderstatus from orders left join d on l_orderkey = o_orderkey""",
    "q133_streamed_ledger": """with r as (
  select *, l_orderkey * 100 + l_linenumber as seq, row_number() over (partition by l_partkey order by l_orderkey * 100 + l_linenumber desc, l_returnflag desc, l_suppkey desc) as r, count(*) over (partition by l_partkey) as n from lineitem
)
select l_partkey, l_returnflag, l_suppkey, seq, n from r where r = 1""",
}

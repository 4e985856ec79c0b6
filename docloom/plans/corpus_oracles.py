"""DuckDB SQL for the queries of ``corpus`` and for those folds of ``evidence`` that recursion can express."""

from docloom.plans.oracles import SQL as _EARLIER

_KINDS = {
    "heading": r"regexp_matches(t, '^(?:#|【)') or (t like '<%' and t like '%>') or regexp_matches(t, '^[①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳❶❷❸❹❺❻❼❽❾❿]\s*\S') or regexp_matches(t, '^[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]+(?:[.)]|\s)') or regexp_matches(t, '^\d+[.)]\s*\S')",
    "citation": r"regexp_matches(t, '^\(.*[’'']?\d{2}.*\)$')",
    "note": r"t like '※%' or regexp_matches(t, '^\*{1,3}\s*\S')",
    "bullet": r"regexp_matches(t, '^(?:[-*]+|[ㅇ□▪•⇨➊➋➌➍➎➏➐➑➒➓])')",
}
KIND = "case when t like '|%' then 'table_markdown' " + " ".join(f"when {c} then '{k}'" for k, c in _KINDS.items()) + " else 'paragraph' end"
_TIGHT = r"regexp_matches(a.t, '[(\[{“\"『]$') or regexp_matches(b.t, '^[)\]},.:;”\"』]')"
_JOIN = f"case when a.t = '' then b.t when b.t = '' then a.t when {_TIGHT} then a.t || b.t else a.t || ' ' || b.t end"
_OFF = "0 < {0}.x1 - {0}.x0 and {0}.x1 - {0}.x0 < 492 and abs(({0}.x0 + {0}.x1) / 2 - 300) <= 70"
_GOES_ON = f"""case
    when a.kind = 'table_markdown' or b.kind = 'table_markdown' then false
    when a.kind in ('paragraph', 'heading') and b.kind in ('paragraph', 'heading') and greatest(length(a.t), length(b.t)) <= 80 and b.y0 - a.y1 <= 36 and {_OFF.format('a')} and {_OFF.format('b')} then true
    when a.kind = 'citation' or b.kind = 'citation' or a.kind = 'heading' or b.kind in ('heading', 'bullet', 'note') or b.y0 - a.y1 > 40 then false
    when abs(b.y0 - a.y0) <= 8 then true
    when b.y0 - a.y1 < -8 or regexp_matches(a.t, '[.!?:;|]$') then false
    when regexp_matches(a.t, '[｢(\\[·]$') or regexp_matches(a.t, '(?:[,:→⇨]|및|등)$') and b.y0 - a.y1 <= 24 then true
    when b.kind <> 'paragraph' then false
    else b.y0 - a.y1 <= 12 or b.y0 - a.y1 <= 24 and length(b.t) <= 120 or b.x0 - a.x0 >= 8 or b.y0 - a.y1 <= 26 and (b.x1 - b.x0 >= 252 or b.x1 >= 360)
      and (b.x0 - a.x0 between -32 and 56 or abs(b.x1 - a.x1) <= 56 or a.x1 - a.x0 >= 390 or a.x1 >= 468) end"""

_NUMBER = "cast(user_id as bigint)"
_CELLS = ", ".join(f"coalesce(trim(regexp_replace(string_agg(t, ' ' order by x0, i) filter (c = {k}), '\\s+', ' ', 'g')), '') as c{k}" for k in range(5))
_MASK = " + ".join(f"case when c{k} <> '' then {1 << k} else 0 end" for k in range(5))
_MERGED = ", ".join(f"string_agg(c{k}, ' ' order by n) filter (c{k} <> '') as c{k}" for k in range(5))

SQL = {
    "q11_continuation_merge": f"""with recursive l as (
  select doc_id, unnest(range(0, len(s))) as p, unnest(s) as t from (select doc_id, string_split(text, chr(10)) as s from documents where text is not null)
), g as (
  select doc_id, row_number() over (partition by doc_id order by p) as n, t, {KIND} as kind, case when length(t) <= 25 then 80.0::double else 60.0::double end as x0, p * 20.0::double as y0,
         least(540.0::double, length(t) * 6.0::double + 80) as x1, p * 20.0::double + 12 as y1
  from l where t <> ''
), f as (
  select doc_id, n, 1::bigint as pos, 1::bigint as merged, t, kind, x0, y0, x1, y1 from g where n = 1
  union all
  select doc_id, n, case when go then pos else pos + 1 end, case when go then merged + 1 else 1 end, case when go then j else t end, case when go then k else kind end,
         case when go then least(u0, x0) else x0 end, case when go then least(v0, y0) else y0 end, case when go then greatest(u1, x1) else x1 end, case when go then greatest(v1, y1) else y1 end
  from (select b.*, a.pos, a.merged, a.kind as k, a.x0 as u0, a.y0 as v0, a.x1 as u1, a.y1 as v1, {_JOIN} as j, {_GOES_ON} as go from f a join g b on a.doc_id = b.doc_id and b.n = a.n + 1)
)
select doc_id, pos, max(merged) as merged, arg_max(kind, n) as block_type, sha256(arg_max(t, n)) as text_sha256 from f group by doc_id, pos""",
    "q54_ocr_noise_cluster": f"""with recursive e as (
  select user_id, event_type || ' ' || cast(floor(value) as bigint) as t, least(value, 100.0) / 100 as s, event_id % 5 * 100.0::double as x0, event_id % 40 * 25.0::double as y0 from events
), k as (
  select *, replace(t, ' ', '') as z from e
), b as (
  select user_id, row_number() over (partition by user_id order by y0, x0, t) as i, t, x0, y0, cast(x0 // 100 as int) as c from k
  where not (s < 0.65 or length(z) <= 4 and s < 0.85 or length(regexp_replace(z, '[^가-힣A-Za-z0-9]', '', 'g')) / length(z) < 0.45 and s < 0.9)
), r as (
  select user_id, i, 0 as r, y0 as y from b where i = 1
  union all
  select b.user_id, b.i, case when abs(b.y0 - r.y) <= 18 then r.r else r.r + 1 end, case when abs(b.y0 - r.y) <= 18 then (r.y + b.y0) / 2 else b.y0 end
  from r join b on b.user_id = r.user_id and b.i = r.i + 1
), w as (
  select user_id, r, contains(lower(replace(string_agg(t, ' ' order by x0, i), ' ', '')), 'view') as head, {_CELLS} from b join r using (user_id, i) group by user_id, r
), h as (
  select user_id, coalesce(min(r) filter (head), 0) as first from w group by user_id
), t as (
  select w.*, row_number() over (partition by user_id order by r) - 1 as n, {_MASK} as m from w join h using (user_id) where r >= first
), f as (
  select user_id, n, m, 1::bigint as g from t where n = 0
  union all
  select user_id, n, case when go then s | m else m end, case when go then g else g + 1 end
  from (select t.user_id, t.n, t.m, f.m as s, f.g, t.n > 1 and bit_count(t.m) = 1 and ((f.m & t.m) > 0 or t.m = 16 and (f.m & 15) > 0) as go from f join t on t.user_id = f.user_id and t.n = f.n + 1)
), o as (
  select user_id, g, {_MERGED} from t join f using (user_id, n) group by user_id, g
)
select user_id, g as row, concat(coalesce(c0, ''), ' | ', coalesce(c1, ''), ' | ', coalesce(c2, ''), ' | ', coalesce(c3, ''), ' | ', coalesce(c4, '')) as cells from o""",
    "q100_vocabulary_table": _EARLIER["q17_keyword_score"],
    "q101_vocabulary_index": r"""with v as (
  select distinct lower(w) as term from (select unnest(regexp_extract_all(text, '[A-Za-z]{9,}')) as w from conversations)
), d as (
  select doc_id, regexp_replace(lower(text), '\s+', '', 'g') as k from documents
)
select term, count(*) as n_docs from v join d on contains(k, term) group by term""",
    "q102_document_commits": """with l as (select doc_id, unnest(range(0, len(s))) as pos, unnest(s) as line from (select doc_id, string_split(text, chr(10)) as s from documents where text is not null)),
c as (select doc_id, count(*) as n, count(*) filter (pos > 0) as m, bool_or(contains(line, '***')) as junk, coalesce(bool_or(line = '') filter (pos > 0), false) as short from l group by 1),
a as (select doc_id, 1 as version, case when n is null then 'missing_source' when junk then 'failed lines: junk' else 'completed' end as status, case when not junk then n else 0 end as n_rows
      from (select doc_id from documents union all select -doc_id - 1 from documents) left join c using (doc_id) where doc_id % 3 <> 0),
b as (select doc_id, 2 as version, case when status = 'completed' then 'skipped_existing' when c.n is null then 'missing_source' when junk then 'failed lines: junk' else 'completed' end as status,
      case when status is not distinct from 'completed' or coalesce(junk, true) then 0 else n end as n_rows from documents left join c using (doc_id) left join a using (doc_id) where doc_id % 2 = 0),
e as (select doc_id, 3 as version, case when short then 'failed lines: short' when coalesce(m, 0) = 0 then 'missing_source' else 'completed' end as status, case when short then 0 else coalesce(m, 0) end as n_rows
      from documents left join c using (doc_id) where doc_id % 5 = 0),
u as (select * from a union all select * from b union all select * from e)
select * from u union all select doc_id, 0, 'now', arg_max(n_rows, version) from u where status = 'completed' group by doc_id""",
    "q103_hierarchy_rollup": """with p as (select r_regionkey, n_nationkey, c_custkey, o_orderkey, l_partkey from region left join nation on r_regionkey = n_regionkey left join customer on n_nationkey = c_nationkey
  left join orders on c_custkey = o_custkey left join lineitem on o_orderkey = l_orderkey)
select case when grouping(r_regionkey) = 1 then 0 when grouping(n_nationkey) = 1 then 1 when grouping(c_custkey) = 1 then 2 when grouping(o_orderkey) = 1 then 3 else 4 end as level,
  r_regionkey, n_nationkey, c_custkey, o_orderkey, case when grouping(r_regionkey) = 1 then count(distinct r_regionkey) end as n_r_regionkey,
  case when grouping(n_nationkey) = 1 then count(distinct n_nationkey) end as n_n_nationkey, case when grouping(c_custkey) = 1 then count(distinct c_custkey) end as n_c_custkey,
  case when grouping(o_orderkey) = 1 then count(distinct o_orderkey) end as n_o_orderkey, count(distinct l_partkey) as n_l_partkey
from p group by rollup(r_regionkey, n_nationkey, c_custkey, o_orderkey)
having (grouping(o_orderkey) = 1 or o_orderkey is not null) and (grouping(c_custkey) = 1 or c_custkey is not null) and (grouping(n_nationkey) = 1 or n_nationkey is not null)""",
    "q104_nested_export": """with o as (select o_custkey, o_orderkey, o_orderkey || ':' || coalesce(string_agg(l_linenumber || l_returnflag, '' order by l_linenumber, l_returnflag), '') as t from orders left join lineitem on o_orderkey = l_orderkey group by 1, 2),
c as (select c_nationkey, c_custkey, c_custkey || '[' || coalesce(string_agg(t, ',' order by o_orderkey), '') || ']' as t from customer left join o on c_custkey = o_custkey group by 1, 2)
select c_nationkey, count(*) as n_customers, sha256(string_agg(t, ';' order by c_custkey)) as tree_sha256 from c group by 1""",
    "q105_shapes_as_rows": """with n as (select l_orderkey as k, count(distinct l_partkey) as n from lineitem group by 1)
select 'o' || o_orderkey as subject, 'Order' as class, 'status' as path, 'minCount' as rule, 0::bigint as found from orders where o_orderkey % 9 = 0
union all select 'o' || o_orderkey, 'Order', 'date', 'datatype', 1 from orders where o_orderkey % 7 = 0
union all select 'o' || o_orderkey, 'Order', 'part', 'minCount', 0 from orders where o_orderkey not in (select k from n)
union all select 'o' || k, 'Order', 'part', 'maxCount', n from n where n > 5
union all select 'c' || c_custkey, 'Customer', 'segment', 'datatype', 1 from customer
union all select 'c' || c_custkey, 'Customer', 'placed', 'minCount', 0 from customer where c_custkey not in (select o_custkey from orders)""",
    "q106_resolved_ids": """with a as (select distinct l_orderkey as old_id, l_partkey as e from lineitem), b as (select distinct o_custkey as new_id, l_partkey as e from orders join lineitem on o_orderkey = l_orderkey),
f as (select e, count(*) as n from b group by 1 having count(*) <= 1000), g as (select e from a group by 1 having count(*) <= 1000),
p as (select old_id, new_id, cast(round(sum(1000000.0::double / n)) as bigint) as weight from a join f using (e) join g using (e) join b using (e) group by 1, 2),
r as (select *, max(weight) over (partition by old_id) as top, max(weight) over (partition by new_id) as bid from p),
s as (select *, count(*) filter (weight = top) over (partition by old_id) as nt, count(*) filter (weight = bid) over (partition by new_id) as nb from r),
t as (select *, row_number() over (partition by old_id order by new_id) as k from s where weight = top)
select o.old_id, t.new_id, t.weight, case when t.new_id is null then 'none' when nt > 1 then 'tied' when weight < bid or nb > 1 then 'outbid' else 'matched' end as outcome
from (select distinct old_id from a) o left join (select * from t where k = 1) t using (old_id)""",
    "q107_fixed_pivot": """select c_nationkey, count(*) filter (o_orderpriority = '1-URGENT') as "1-URGENT", count(*) filter (o_orderpriority = '2-HIGH') as "2-HIGH", 0::bigint as "0-NONE",
  count(*) filter (o_orderpriority = '3-MEDIUM') as "3-MEDIUM", count(*) filter (o_orderpriority = '5-LOW') as "5-LOW" from orders join customer on o_custkey = c_custkey group by 1""",
    "q108_polymorphic_links": """select l_orderkey, l_linenumber, ['part', 'supplier', 'nation', 'other'][l_linenumber % 4 + 1] as kind,
  case l_linenumber % 4 when 0 then l_partkey when 1 then l_suppkey else l_suppkey % 30 end as key, case l_linenumber % 4 when 0 then p_name when 1 then s_name when 2 then n_name end as label
from lineitem left join part on p_partkey = l_partkey left join supplier on s_suppkey = l_suppkey left join nation on n_nationkey = l_suppkey % 30""",
    "q109_drill_down": """select c_custkey, o_orderkey, l_linenumber, p_name, s_name, n_name, r_name from customer left join orders on c_custkey = o_custkey left join lineitem on o_orderkey = l_orderkey
left join part on l_partkey = p_partkey left join supplier on l_suppkey = s_suppkey left join nation on s_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""",
    "q110_collated_labels": """with w as (select distinct role, unnest(regexp_extract_all(text, '[A-Za-z]+')) as word from conversations)
select role, word, cast(row_number() over (partition by role order by lower(word), translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz', repeat('b', 26) || repeat('a', 26)), word) as int) as place from w""",
    "q111_observed_write": """with a as (select 'before' as state, * from orders where o_orderstatus <> 'P' union all select unnest(['after', 'stored']), * from orders where o_orderkey % 4 > 0)
select state, cast(count(*) as double) as n, cast(count(*) filter (o_orderstatus = 'O') as double) as n_open, max(o_totalprice) as largest from a group by 1""",
    "q113_structured_units": r"""with h as (select page_id, string_split(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\.\s', '.' || chr(1), 'g'), chr(1)) as s from pages),
w as (select page_id, [x for x in s if trim(x, ' ') <> ''] as s from h), l as (select page_id, unnest(range(0, len(s))) as i, unnest(s) as x from w),
m as (select page_id, i, case when i % 7 = 3 then '※ ' || trim(x, ' ') when i % 5 = 4 then '(’24 note)' else trim(x, ' ') end as t from l),
o as (select *, regexp_matches(t, '^(?:[-*]+|[ㅇ□▪•⦁◦➊➋➌➍➎➏➐➑➒➓☞⇒⇨])\s*|^\*{1,2}\s*\S|^※|^[①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳]\s*\S|^[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]+(?:[.)]\s*|\s+)|^\d+[.)]\s*\S') as opens from m where t <> ''),
p as (select *, sum(cast(opens as int)) over (partition by page_id order by i) as piece from o),
c as (select *, not first_value(regexp_matches(t, '^(?:※|\*{1,2}\s*\S)')) over (partition by page_id, piece order by i) and regexp_matches(t, '^\(.*[’'']?\d{2}.*\)$') as cites,
      row_number() over (partition by page_id, piece order by i) = 1 as first from p),
u as (select *, sum(cast(first or cites as int)) over (partition by page_id order by i) - 1 as pos from c)
select page_id, cast(pos as int) as pos, count(*) as lines, sha256(string_agg(t, ' ' order by i)) as text_sha256 from u group by page_id, pos""",
}

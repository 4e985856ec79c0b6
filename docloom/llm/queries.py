"""The registered queries of this subpackage, and SQL where SQL can express them."""

from __future__ import annotations


import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import byte_bpe, decontaminate, divergence, embedding_dedup, infill, license_scan, main_text, near_dedup, pii, quality, sharding, token_count, warc
from docloom.session import table



def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, huge ones by overlap resynchronisation."""
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded; hashes of ids and bytes."""
    return byte_bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences of benchmark windows in every document."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.expr("aggregate(runs, 0L, (acc, r) -> acc + r.last - r.first)")
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives, normalised to a member a record and read back by the index."""
    return warc.round_trip(table(spark, sf_dir, "pages"), least=1000)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document."""
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("matches").cast("long").alias("n_licenses"),
        F.array_join(F.transform("matches", lambda m: m["template_id"]), ",").alias("licenses"),
        F.round(F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0)), 6).alias("top_containment"),
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, with terms that disclose it."""
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    joined = "array_join(transform({}, s -> concat_ws(':', {}, s.start, s.end)), ',')"
    base = F.expr(joined.format("spans", "s.kind"))
    terms = F.expr(joined.format("terms", f"'{pii.TERM}'"))
    return found.select(
        "doc_id",
        *(F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in pii.KINDS),
        F.sha2(base, 256).alias("base_sha256"),
        F.concat_ws(",", F.when(F.size("spans") > 0, base), F.when(F.size("terms") > 0, terms)).alias("spans"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents by three-word shingles at 0.85."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), near_dedup.Setting(width=3, percent=85, rows=6, bands=32))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near-equal bytes, equal texts together."""
    placed = sharding.shard(table(spark, sf_dir, "documents"), 16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of equal label."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document arranged to fill in its middle, and its text rebuilt."""
    made = infill.arranged(table(spark, sf_dir, "documents"))
    chars = lambda c: F.char_length(c).cast("long")
    return made.select(
        "doc_id",
        "n",
        "form",
        chars("prefix").alias("prefix_chars"),
        chars("middle").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_text.extracted(table(spark, sf_dir, "pages"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language diverge, and their telling terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {
        f.__name__: f
        for f in (
            op1_token_counts,
            op2_byte_bpe,
            op3_decontamination,
            op4_warc,
            op5_license_scan,
            op6_pii,
            op7_quality,
            op8_near_dedup,
            op9_sharding,
            op10_embedding_dedup,
            op11_fill_in_middle,
            op12_html_extraction,
            op13_source_divergence,
        )
    }


_OP4 = """
with r as (
  select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as n, sha1(coalesce(html, '')) as d from pages
), g as (
  select d, max(page_id) as top from r where n >= 1000 group by d
)
select r.page_id, cast(n as bigint) as payload_bytes, r.d as payload_digest,
       case when n >= 1000 and page_id <> top then 'revisit' else 'response' end as record_type,
       case when n >= 1000 and page_id <> top then top end as refers_to
from r left join g on r.d = g.d
"""


_OP3 = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') as w from documents
), b as (
  select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') as w from benchmark
), g as (
  select distinct item, len(w[k : k + 9]) as n, array_to_string(w[k : k + 9], ' ') as window_text
  from (select item, w, unnest(range(1, greatest(2, cast(len(w) as bigint) - 8))) as k from b where len(w) > 0)
), sizes as (
  select distinct n from g
), p as (
  select doc_id, k, n, array_to_string(w[k : k + n - 1], ' ') as window_text
  from (select doc_id, w, n, unnest(range(1, cast(len(w) as bigint) - n + 2)) as k from d cross join sizes where len(w) >= n)
), hits as (
  select p.doc_id, p.k, p.n, g.item from p join g on p.window_text = g.window_text
), words as (
  select doc_id, count(distinct x) as n_hit from (select distinct doc_id, unnest(range(k, k + n)) as x from hits) group by doc_id
), items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from hits) group by doc_id
)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (doc_id) left join items using (doc_id)
"""

_OP8 = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), s as (
  select distinct doc_id, array_to_string(w[k : k + 2], ' ') as shingle
  from (select doc_id, w, unnest(range(1, greatest(2, cast(len(w) as bigint) - 1))) as k from d where len(w) > 0)
), n as (
  select doc_id, count(*) as n from s group by doc_id
), shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all
), links as (
  select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)
), reach as (
  select doc_id, doc_id as other from d
  union
  select reach.doc_id, links.b from reach join links on links.a = reach.other
), least as (
  select doc_id, min(other) as component_id from reach group by doc_id
)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, component_id, d.doc_id = component_id as kept
from d join least using (doc_id) left join n using (doc_id)
"""

_OP10 = """
with recursive v as (
  select vec_id, label, cast(embedding as double[]) as x from embeddings
), u as (
  select vec_id, label, x, list_max(list_transform(x, lambda c: abs(c))) as most from v
  where label is not null and len(x) > 0 and len(x) = len(list_filter(x, lambda c: c is not null and isfinite(c)))
), w as (
  select vec_id, label, list_transform(x, lambda c: c / most) as x from u where most > 0
), ok as (
  select *, sqrt(list_dot_product(x, x)) as norm from w
), links as (
  select a.vec_id as a, b.vec_id as b from ok a join ok b on a.label = b.label and a.vec_id <> b.vec_id and len(a.x) = len(b.x)
  where list_dot_product(a.x, b.x) / (a.norm * b.norm) >= 0.93
), n as (
  select a as vec_id, count(*) as n from links group by a
), reach as (
  select vec_id, vec_id as other from v
  union
  select reach.vec_id, links.b from reach join links on links.a = reach.other
), least as (
  select vec_id, min(other) as component_id from reach group by vec_id
)
select v.vec_id, cast(coalesce(n.n, 0) as bigint) as n_links, component_id, v.vec_id = component_id as kept
from v join least using (vec_id) left join n using (vec_id)
"""


_OP11 = r"""
with d as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u,
         sha256('42:' || coalesce(cast(doc_id as varchar), '')) as h
  from documents
), c as (
  select doc_id, text, u, len(u) as n, cast('0x' || h[1:8] as bigint) % (len(u) + 1) as x, cast('0x' || h[9:16] as bigint) % (len(u) + 1) as y,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or cast('0x' || h[17:24] as bigint) % 100 >= 50 then 'plain'
              when cast('0x' || h[25:32] as bigint) % 100 < 80 then 'spm' else 'psm' end as form
  from d
), p as (
  select doc_id, text, n, form, array_to_string(u[1 : least(x, y)], '') as prefix, array_to_string(u[least(x, y) + 1 : greatest(x, y)], '') as middle,
         array_to_string(u[greatest(x, y) + 1 : n], '') as suffix
  from c
)
select doc_id, cast(n as bigint) as n, form,
       case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
       case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from p
"""

#: For pages of the tables' form: their main text stands in one article element, without elements to leave out.
_OP12 = r"""
with a as (
  select page_id, url, regexp_extract(coalesce(html, ''), '(?is)<article>(.*)</article>', 1) as x from pages
), t as (
  select page_id, url, regexp_replace(regexp_replace(x, '(?i)</?(?:p|h1|br|li|ul|div)>', ' ', 'g'), '<[^>]*>', '', 'g') as x from a
), e as (
  select page_id, url, replace(replace(replace(replace(x, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') as x from t
), s as (
  select page_id, url, trim(regexp_replace(x, '\s+', ' ', 'g')) as text from e
)
select page_id, url, text, cast(length(text) as bigint) as n_chars from s
"""

_OP13 = r"""
with d as (
  select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{80}-\x{10FFFF}]+') as w
  from documents
), g as (
  select distinct lang, source from d
), o as (
  select lang, source, term, doc, count(*) as c from (select lang, source, doc, unnest(w) as term from d) group by all
), k as (
  select lang, term, cast(sum(c) as bigint) as c from o group by all having count(*) >= 3
), v as (
  select lang, count(*) as v, cast(sum(c) as bigint) as n from k group by lang
), s as (
  select o.lang, o.source, o.term, cast(sum(o.c) as bigint) as c from o join k using (lang, term) group by all
), m as (
  select lang, source, cast(sum(c) as bigint) as n from s group by all
), n as (
  select g.lang, g.source, v.v, coalesce(m.n, 0) as n from g join v using (lang) left join m using (lang, source)
), p as (
  select n.lang, n.source, k.term, coalesce(s.c, 0) as c, 1 + 1000000000 * (coalesce(s.c, 0) + 1) // (n.n + n.v) as p
  from n join k using (lang) left join s on s.lang = n.lang and s.source = n.source and s.term = k.term
), q as (
  select k.lang, k.term, 1 + 1000000000 * (k.c + 1) // (v.n + v.v) as q from k join v using (lang)
), pairs as (
  select a.lang, a.source, b.source as item, cast(sum((a.p - b.p) * (a.p - b.p) // b.p) as bigint) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), every as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(pairs.value, 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source left join pairs on pairs.lang = a.lang and pairs.source = a.source and pairs.item = b.source
  union all
  select p.lang, p.source, 'term', p.term, (p.p - q.q) * (p.p - q.q) // q.q from p join q using (lang, term) where p.c > 0 and p.p > q.q
), ranked as (
  select lang, source, part, item, cast(value as bigint) as value,
         cast(row_number() over (partition by lang, source, part order by value desc, encode(item)) as int) as rank
  from every
)
select * from ranked where part = 'pair' or rank <= 200
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_decontamination": _OP3,
        "op4_warc": _OP4,
        "op5_license_scan": license_scan.oracle(),
        "op8_near_dedup": _OP8,
        "op10_embedding_dedup": _OP10,
        "op11_fill_in_middle": _OP11,
        "op12_html_extraction": _OP12,
        "op13_source_divergence": _OP13,
    }

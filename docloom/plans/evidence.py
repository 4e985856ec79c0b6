"""Queries of the operators on page text, tables, mining, projection, review, files and sinks."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import align, continuation, facets, fields, graph, labels, lens, mining, pagetext, review, scoring, tables, textops, validate
from docloom.session import table
from docloom.sources import files, sinks

BASE = "http://example.org/docloom"
#: Word lists of the example queries, chosen to fit the test text.
WORDS = mining.Words(
    strong=("the", "les", "der"),
    action=("and", "des", "und", "que"),
    negative=("***", "###"),
    context=("Licensed",),
    structural=("Copyright",),
    task_headings=("a",),
    cues=("ing",),
    background=("zz",),
)
RULES = [
    mining.Rule(("blocked", "license", "high"), any_of=("license", "copyright", "permission")),
    mining.Rule(("review", "contact", "medium"), any_of=("@",), none_of=("example",)),
    mining.Rule(("keep", "prose", "low"), all_of=("the", "and")),
]


def _folder(spark: SparkSession) -> str:
    """A new folder where driver and executors can write; files of queries that write and read back."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "/tmp/docloom-files"
    return f"{base.rstrip('/')}/files/{uuid.uuid4().hex}"


def _first_line():
    return F.get(F.split("text", "\n"), F.lit(0))


def _union(parts: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [x.select(F.lit(k).alias("part"), *(F.col(c) for c in x.columns)) for k, x in parts.items()])


# page text


def q10_page_assembly(spark: SparkSession, d: str) -> DataFrame:
    pages = pagetext.page_report(table(spark, d, "documents"), "doc_id", "text")
    return pages.select("doc_id", "n_lines", "n_units", "n_footers", "n_noise", "n_chars", F.sha2("page_text", 256).alias("page_sha256"))


def q11_continuation_merge(spark: SparkSession, d: str) -> DataFrame:
    """Lines laid out on a page of 600 points, the short ones indented; a page is a row's array from the text on."""

    def block(line, p):
        y = p * 20.0
        return F.struct(
            pagetext.unit_type(line).alias("block_type"),
            line.alias("text"),
            F.when(textops.short(line), 80.0).otherwise(60.0).alias("x0"),
            y.alias("y0"),
            F.least(F.lit(540.0), F.char_length(line) * 6.0 + 80).alias("x1"),
            (y + 12).alias("y1"),
            F.lit(600.0).alias("page_width"),
        )

    pages = table(spark, d, "documents").select("doc_id", F.filter(F.transform(F.split("text", "\n"), block), lambda b: b["text"] != "").alias("blocks"))
    out = continuation.merged_pages(pages).select("doc_id", F.posexplode("blocks").alias("p", "b"))
    return out.select("doc_id", (F.col("p") + 1).cast("long").alias("pos"), "b.merged", "b.block_type", F.sha2("b.text", 256).alias("text_sha256"))


def q15_span_alignment(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs of up to three lines mapped back to the lines that they were joined from; each is found."""
    docs = table(spark, d, "documents").filter("text is not null")
    lines = docs.select("doc_id", F.lit(1).cast("long").alias("page_no"), F.posexplode(F.split("text", "\n")).alias("p", "line"))
    lines = lines.select("doc_id", "page_no", F.col("p").cast("long").alias("line_order"), labels.compare_key(F.col("line")).alias("key"))
    parts = lines.groupBy("doc_id", "page_no", F.expr("line_order div 3").alias("pos")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_order", "key"))), lambda x: x["key"]), "").alias("key"), F.count("*").alias("merged"))
    found = align.source_map(parts, lines)
    return align.coverage(found)


def q16_passage_containment(spark: SparkSession, d: str, words: int = 5) -> DataFrame:
    """(doc_id, item_id): documents that hold a benchmark text as it stands.

    Candidates share a run of ``words`` of the item's inner words, which stand
    between white space in the document too; then the whole text is looked
    for.  Items of fewer than three words aren't sought; shorter runs are used
    for short items.
    """
    items = table(spark, d, "benchmark").select("item_id", F.col("text").alias("item"), F.filter(F.split("text", r"\s+"), lambda w: w != "").alias("w")).filter("size(w) >= 3")
    items = items.withColumn("k", F.least(F.lit(words), F.size("w") - 2)).withColumn("seed", F.expr("xxhash64(array_join(slice(w, 2, k), ' '))"))
    sizes = [r["k"] for r in items.select("k").distinct().collect()]  # at most ``words`` numbers
    docs = table(spark, d, "documents").select("doc_id", "text", F.filter(F.split("text", r"\s+"), lambda w: w != "").alias("w"))
    seeds = F.array_distinct(
        F.concat(
            F.expr("cast(array() as array<bigint>)"),
            *(F.expr(f"transform(sequence(1, greatest(size(w) - {k} + 1, 1)), i -> xxhash64(array_join(slice(w, i, {k}), ' ')))") for k in sizes),
        )
    )
    wanted = items.select("seed").distinct()
    near = docs.select("doc_id", F.explode(seeds).alias("seed")).join(wanted, "seed").join(items.select("seed", "item_id"), "seed").select("doc_id", "item_id").distinct()
    held = near.join(docs.select("doc_id", "text"), "doc_id").join(items.select("item_id", "item"), "item_id").filter(F.contains("text", "item"))
    return held.select("doc_id", "item_id").distinct()


def q53_table_class(spark: SparkSession, d: str) -> DataFrame:
    """One table per order: a row a line, a column a brand, its brands as preview."""
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    shapes = lines.groupBy("l_orderkey").agg(F.count("*").alias("rows"), F.count_distinct("p_brand").alias("cols"), F.array_sort(F.collect_set("p_brand")).alias("b"))
    word = F.when(F.col("l_orderkey") % 2 == 0, "hwpx").otherwise("pdf")
    found = tables.table_class(F.col("rows"), F.col("cols"), tables.preview(F.array("b")), word, F.col("l_orderkey") % 10 == 0, ["Brand#1 1"])
    return shapes.select("l_orderkey", found.alias("c")).select("l_orderkey", "c.*", tables.keep_decision(F.col("c.table_class")).alias("keep"))


def q54_ocr_noise_cluster(spark: SparkSession, d: str) -> DataFrame:
    """Event values as recognised numbers: noise left out, rows by height, cells by edge."""
    e = table(spark, d, "events")
    boxes = e.select(
        "user_id",
        F.lit(1).cast("long").alias("page_no"),
        F.format_string("%s %d", "event_type", F.floor("value")).alias("text"),
        (F.least(F.col("value"), F.lit(100.0)) / 100).alias("score"),
        (F.col("event_id") % 5 * 100.0).alias("x0"),
        (F.col("event_id") % 40 * 25.0).alias("y0"),
        F.lit(12.0).alias("height"),
    )
    return tables.rebuilt(boxes, "user_id", [100.0, 200.0, 300.0, 400.0], ["view"]).select("user_id", "row", F.array_join("cells", " | ").alias("cells"))


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """Every line of every text, numbered from 0."""
    return table(spark, d, "documents").select("doc_id", "n_chars", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


def q59_ocr_noise(spark: SparkSession, d: str) -> DataFrame:
    score = F.col("n_chars") % 100 / 100.0
    return _lines(spark, d).select("doc_id", "pos", tables.is_noise(F.col("line"), score).alias("support"), tables.is_noise(F.col("line"), score, "reference").alias("reference"))


# mining and rules


def _mined(spark: SparkSession, d: str) -> DataFrame:
    lines = textops.carry_heading(table(spark, d, "documents"))
    category = scoring.first_max(F.col("line"), {"technology": ("the", "les"), "infrastructure_institutional": ("der", "and"), "talent": ("que",)}, [("talent", ("a",))], "technology")
    return mining.mined(lines, WORDS, category)


def q24_candidate_mine_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return _mined(spark, d)


def q25_merge_draft(spark: SparkSession, d: str) -> DataFrame:
    lines = textops.gate(table(spark, d, "documents")).withColumn("text", labels.collapsed(F.col("line"))).withColumn("block_type", pagetext.unit_type(F.col("text")))
    rows = lines.withColumn("page", F.expr("(pos - 1) div 10")).withColumn("skip", mining.skip_reason(F.col("text"), F.col("block_type"), F.lit(False), WORDS))
    return mining.merge_draft(rows).select("doc_id", "group_no", "page", "n_continuations", "n_reviews", "confidence", F.sha2("text", 256).alias("text_sha256"))


def q26_rule_cascade(spark: SparkSession, d: str) -> DataFrame:
    found = mining.cascade(F.lower("text"), RULES, ["status", "reason", "attention"], ("none", "no_rule", "none"))
    tier = fields.by_rules([(F.col("source").isNull(), "missing_source"), (F.col("n_chars") > 5000, "authoritative"), (F.col("n_chars") > 500, "supporting")], "supplementary")
    rank = fields.looked_up(F.col("c.attention"), {"high": 0, "medium": 1, "low": 2}, 9)
    return table(spark, d, "documents").select("doc_id", found.alias("c"), tier.alias("tier")).select("doc_id", "c.*", "tier", rank.alias("rank"))


def q60_skip_reasons(spark: SparkSession, d: str) -> DataFrame:
    skip = mining.skip_reason(labels.collapsed(F.col("line")), F.lit("paragraph"), F.lit(False), WORDS)
    return _lines(spark, d).select("doc_id", "pos", skip.alias("skip"))


# projection


def _terms(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return lines.select(F.col("l_orderkey").alias("o_orderkey"), "p_type", "p_brand", "l_linenumber", "l_suppkey", (F.col("l_returnflag") == "R").cast("int").alias("is_primary"))


def q41_lens_projection_assign(spark: SparkSession, d: str) -> DataFrame:
    return lens.assigned(table(spark, d, "orders").select("o_orderkey"), _terms(spark, d), "o_orderkey", "p_type")


def q61_provisional_fill(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").withColumn("n", F.char_length("p_type") % 3)
    existing = parts.groupBy("p_type", "n").agg(F.lit(2).alias("n_groups"), F.count_if(F.col("n") == 1).alias("n_auto"), F.max(F.lit(2)).alias("last_order")).filter("n > 0").drop("n")
    key = lens.provisional_key(F.col("p_size") > 40, F.col("p_size") > 20, F.lit("talent"), F.col("p_size"), F.floor("p_retailprice"), F.col("p_partkey"))
    filled = lens.provisional_fill(parts.select("p_partkey", "p_type", "p_brand", "p_name", "p_size", "p_retailprice"), existing, "p_type", ["p_brand"], key, 6)
    groups = lens.provisional_groups(filled, "p_partkey", F.col("p_name"), F.lit(""), F.col("p_brand"))
    return groups.select("group_id", "content_id", "group_label", "group_summary", "status", "display_order")


def q62_domain_rollup_maps(spark: SparkSession, d: str) -> DataFrame:
    rows = _terms(spark, d).join(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), "o_orderkey")
    rows = rows.withColumn("seq", F.col("o_orderkey") * 10 + F.col("l_linenumber"))
    up = lens.domain_rollup(rows, "p_type", "o_orderkey", "seq", "o_custkey", "is_primary", "o_orderpriority", "seq")
    stage = lens.curation_stage(F.col("n_groups"), F.coalesce(F.try_element_at("categories", F.lit(1)), F.lit(0)))
    return up.select(
        F.col("p_type").alias("domain"), "n_groups", "n_contents", "n_policies", F.coalesce(F.try_element_at("categories", F.lit(1)), F.lit(0)).alias("n_primary"),
        F.try_element_at("strategies", F.lit("1-URGENT")).alias("last_urgent"), stage.alias("stage"),
    )


def q63_draft_pack(spark: SparkSession, d: str) -> DataFrame:
    """All rows of a pack's six sets, an order a group, as JSON."""
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("at"), F.col(c).alias("of")))), lambda x: x["of"])
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(ordered("l_linenumber").alias("items"), ordered("l_partkey").alias("contents"))
    pack = lens.draft_pack(lines, "l_orderkey", "items", "contents")
    return _union({k: x.select(F.to_json(F.struct(*sorted(x.columns))).alias("row")) for k, x in pack.items()})


# review


def q64_apply_outputs(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter("lang = 'en'").select("doc_id", F.concat(F.lit("D-"), F.col("doc_id").cast("string")).alias("item"))
    choice = F.when((F.col("quality") == 0) & (F.col("toxic") == 1), "wrong").when(F.col("toxic") == 1, "no_strategy").otherwise("approved")
    marks = table(spark, d, "labels").select("doc_id", (F.col("doc_id") % 2 == 0).alias("active"), choice.alias("choice"), F.array(F.lit("S-1"), F.lit("S-2")).alias("terms"))
    out = review.applied(marks, docs, "doc_id", "item", ["approved", "revised"])
    rows = {
        "outcomes": out["outcomes"].select(F.col("doc_id").cast("string").alias("id"), F.col("outcome").alias("value")),
        "mappings": out["mappings"].select(F.col("item").alias("id"), F.concat_ws(":", "term", F.col("is_primary").cast("string"), "review_status").alias("value")),
        "assertions": out["assertions"].select(F.col("item").alias("id"), F.col("assertion").alias("value")),
    }
    return _union(rows)


def q65_merged_batches(spark: SparkSession, d: str) -> DataFrame:
    ledger = table(spark, d, "documents").filter("doc_id % 3 <> 0").select("doc_id", F.col("lang").alias("note"))
    edits = table(spark, d, "labels").select("doc_id", F.explode(F.array(F.lit(2), F.lit(1))).alias("line"), "quality").filter("line = 1 or quality = 1")
    edits = edits.withColumn("note", F.concat(F.lit("edit "), F.col("line").cast("string")))
    merged, problems = review.merged_batches(ledger, edits, "doc_id", ["line"], ["note"])
    return merged.select("doc_id", "note").unionByName(problems.select("doc_id", F.col("problem").alias("note")))


def q66_finalised(spark: SparkSession, d: str) -> DataFrame:
    ledger = table(spark, d, "documents").filter("doc_id % 4 <> 0").select("doc_id", F.when(F.col("lang") == "en", "done").alias("status"))
    decided = table(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "done").alias("status"))
    return review.finalised(ledger, decided.dropDuplicates(["doc_id"]), "doc_id", ["status"])


def q67_packet_index(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return review.packet_index(rows, "c_mktsegment", "o_orderstatus", ["F", "O", "P"])


def q68_rejections(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").withColumn("status", F.when(F.col("o_orderstatus") == "F", "rejected").otherwise("open"))
    return review.rejection_report(rows, "o_orderpriority", "status", F.substring("o_orderpriority", 3, 10))


def q69_merge_graph(spark: SparkSession, d: str) -> DataFrame:
    """Orders that follow the one of a tenth of their number; an order's parts are its evidence."""
    parts = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set(F.col("l_partkey").cast("string"))).alias("evidence"))
    key = F.col("o_orderkey")
    rows = table(spark, d, "orders").join(parts, key == F.col("l_orderkey"), "left").select(
        key.alias("item"),
        F.when(key % 5 == 0, F.expr("o_orderkey div 10")).alias("into"),
        F.coalesce("evidence", F.expr("cast(array() as array<string>)")).alias("evidence"),
        F.when(key % 11 == 0, "drop").otherwise("keep").alias("decision"),
    )
    leads, issues = review.merged_items(rows)
    return leads.select(F.col("leader").alias("item"), F.array_join("evidence", ",").alias("value")).unionByName(issues.select("item", F.col("issue").alias("value")))


def q70_content_signature(spark: SparkSession, d: str) -> DataFrame:
    """Reviewed rows found again by a signature of their content, of which some has changed."""
    rows = table(spark, d, "documents").filter("doc_id % 10 <> 0").select("doc_id", "lang", "n_chars", F.lit("").alias("role"))
    sign = F.sha2(F.concat_ws("\u0001", "lang", F.when(F.col("doc_id") % 4 == 0, "0").otherwise(F.col("n_chars").cast("string"))), 256)
    given = table(spark, d, "documents").filter("doc_id % 3 <> 0").select("doc_id", sign.alias("signature"), F.when(F.col("doc_id") % 5 == 0, " ").otherwise("lead").alias("role"))
    return review.reviewed_rows(rows, given, "doc_id", ["lang", "n_chars"], ["role"]).select("doc_id", "role", "match")


def q71_review_tasks(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "O", "pending").otherwise("done").alias("status"), F.col("o_orderpriority").alias("domain"), F.lit("P").alias("policy"), F.concat_ws("  ", "o_orderpriority", F.col("o_custkey").cast("string")).alias("title"))
    return fields.review_tasks(rows, ["title", "policy"], domain="1-URGENT", query="  1-Urgent   1").select("o_orderkey", "title")


# columns and read models


def q72_column_rules(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    url = F.col("url")
    return pages.select(
        "page_id",
        fields.first_filled(F.lit(""), F.lit(None), url).alias("first"),
        fields.is_set(F.col("page_id") % 2).alias("flag"),
        fields.preview_kind(F.concat(url, F.lit(".PNG::inner"))).alias("preview"),
        fields.media_type(F.concat(url, F.lit(".pdf"))).alias("media"),
        fields.number_key(F.col("page_id").cast("string")).alias("number"),
        fields.number_key(url).alias("no_number"),
        F.bround(F.col("page_id") / 6).cast("long").alias("band"),
        F.sha2(labels.html_escaped(F.col("html")), 256).alias("escaped_sha256"),
        fields.has_override(F.lit(None).cast("string"), F.when(F.col("page_id") % 3 == 0, " x ").otherwise(" ")).alias("touched"),
        fields.shown_number(F.col("page_id") * 1000).alias("shown"),
    )


def q73_value_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").withColumn("s", F.when(F.col("doc_id") % 3 == 0, " ").when(F.col("doc_id") % 7 != 0, F.concat(F.lit(" "), F.col("lang"), F.lit(" "))))
    return fields.counted(rows, "s")


def q74_search_filters(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left")
    rows = rows.groupBy("c_custkey", "c_name", "c_mktsegment").agg(F.array_sort(F.collect_set("o_orderpriority")).alias("terms")).withColumn("search_text", F.lower(F.concat_ws(" ", "c_name", "c_mktsegment")))
    segment = fields.valid_choice("NO SUCH SEGMENT", ["BUILDING", "AUTOMOBILE"])
    rows = rows.filter(fields.matches_search(F.col("search_text"), " Customer#00000001 ") | fields.matches_search(F.col("search_text"), "BUILDING"))
    rows = rows.filter(fields.mapping_state(F.col("terms"), "mapped") & fields.has_term(F.col("terms"), "1-URGENT") & fields.has_term(F.col("terms"), segment))
    return rows.select("c_custkey", F.array_join("terms", ",").alias("terms"), fields.first_where(F.col("terms"), lambda t: t > "2").alias("later"))


def q75_facet_options(spark: SparkSession, d: str) -> DataFrame:
    """All segments as options with their counts; those without rows only where they are chosen."""
    counts = table(spark, d, "customer").filter("c_acctbal > 9990").groupBy(F.col("c_mktsegment").alias("value")).agg(F.count("*").alias("n"))
    dims = table(spark, d, "customer").select(F.col("c_mktsegment").alias("value")).distinct()
    return facets.options(dims, counts, "value", "BUILDING")


def q76_unmapped_lists(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").join(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct(), "o_orderkey", "left_anti")
    return rows.groupBy("o_custkey").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("o_orderkey")), ",").alias("orders"))


def q77_asset_insight(spark: SparkSession, d: str) -> DataFrame:
    """Parts inverted from the orders that name them: distinct orders, statuses, and their order by preview and evidence."""
    lines = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    kind = fields.preview_kind(F.concat(F.lit("x."), F.when(F.col("l_partkey") % 3 == 0, "png").when(F.col("l_partkey") % 3 == 1, "pdf").otherwise("hwp")))
    return facets.asset_insight(lines.withColumn("kind", kind), "l_partkey", "l_orderkey", "o_orderstatus", "kind")


def q78_scalars(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        F.try_element_at(F.from_json("props", "map<string,int>"), F.lit("k")).alias("k_map"),
        F.to_json(F.struct("event_type", F.when(F.col("value") > 50, F.col("event_type")).alias("high")), {"ignoreNullFields": "false"}).alias("json"),
        F.expr("try_cast(event_type as int)").alias("number"),
        F.expr("forall(array(value, 1.0D), v -> v > 0)").alias("positive"),
        F.exists(F.array("value"), lambda v: v > 90).alias("large"),
        F.width_bucket("value", F.lit(0.0), F.lit(100.0), F.lit(10)).alias("bucket"),
        F.base64(F.encode("event_type", "UTF-8")).alias("encoded"),
    )


# graph and validation


def q79_turtle(spark: SparkSession, d: str) -> DataFrame:
    facts = graph.triples(
        table(spark, d, "nation"), graph.iri(BASE, "nation", F.concat(F.lit("a/b c*"), F.col("n_nationkey").cast("string"))), {"label": F.concat(F.col("n_name"), F.lit(' "x"\n')), "inRegion": graph.iri(BASE, "region", F.col("n_regionkey"))}
    )
    return graph.turtle(facts, "ex")


def q80_json_ld(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "nation")
    return graph.json_ld(rows, "Nation", graph.iri(BASE, "nation", F.col("n_nationkey")), {"label": F.col("n_name"), "inRegion": F.when(F.col("n_nationkey") % 2 == 0, graph.iri(BASE, "region", F.col("n_regionkey")))})


def q81_adjacency(spark: SparkSession, d: str) -> DataFrame:
    both = graph.adjacency(table(spark, d, "nation"), "n_regionkey", "n_nationkey")
    return both.select("n_regionkey", F.array_join("neighbours", ",").alias("neighbours"))


def q82_coverage_checks(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").join(table(spark, d, "labels").select("doc_id", F.lit(True).alias("there")).distinct(), "doc_id", "left")
    have = F.coalesce(F.col("there"), F.lit(False))
    rows = validate.findings(docs, [("error", "no_source", F.col("source").isNull()), ("warning", "short_text", F.col("n_chars") < 50), ("error", "no_text", F.col("text").isNull())])
    cover = validate.coverage(docs, have, 0.9, "warning", "label_coverage")
    five = validate.group_cardinality(table(spark, d, "nation"), "n_regionkey", "n_nationkey", 5, "error", "nations_of_region")
    found = [rows, five, validate.cardinality(table(spark, d, "region"), 5, "error", "regions")]
    return validate.report([cover, *(x.withColumn("ratio", F.lit(None).cast("double")) for x in found)])


def q83_contract(spark: SparkSession, d: str) -> DataFrame:
    rules = {"status": F.col("o_orderstatus").isin("F", "O"), "price": F.col("o_totalprice") > 1000, "priority": F.col("o_orderpriority").rlike("^[1-3]-")}
    return validate.row_errors(table(spark, d, "orders"), "o_orderkey", rules)


def q84_ordered_lists(spark: SparkSession, d: str) -> DataFrame:
    """Orders whose lines, by number and by quantity, aren't in the same order."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.struct("l_quantity", "l_linenumber").alias("q"), F.struct("l_linenumber").alias("n"))
    return validate.same_lists(lines.withColumnRenamed("n", "o").drop("q"), lines.withColumnRenamed("q", "o").drop("n"), "l_orderkey", "l_linenumber", "o")


# files and stored tables


def q85_csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Texts with line ends, quotes and commas written as CSV and read back."""
    folder = _folder(spark)
    rows = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), F.concat(F.lit('a "q", '), F.col("text")).alias("text"))
    sinks.write_csv(rows, folder, ["id", "text"])
    return files.csv_rows(spark, folder, ["id", "text"]).select("id", F.sha2("text", 256).alias("sha256"))


def q86_json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """All lines in files that are a list, or an object that holds one, each of a thousand orders."""
    folder = _folder(spark)
    element = F.struct(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_returnflag").alias("flag"))
    blocks = table(spark, d, "lineitem").groupBy(F.expr("l_orderkey div 1000").alias("part")).agg(F.collect_list(element).alias("blocks"))
    whole = blocks.select("part", F.when(F.col("part") % 2 == 0, F.to_json("blocks")).otherwise(F.to_json(F.struct("blocks"))).alias("value"))
    # one object a file, as the reader takes whole files
    whole.write.partitionBy("part").text(folder)
    return files.json_rows(spark, f"{folder}/*/*", "k long, n int, flag string").select("k", "n", "flag")


def q87_named_files(spark: SparkSession, d: str) -> DataFrame:
    """Files of orders in one folder for each customer segment; the segment is in each file's path, and only known ones are read."""
    folder = _folder(spark)
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderpriority", "c_mktsegment")
    rows.write.partitionBy("c_mktsegment").option("header", True).csv(folder)
    known = spark.createDataFrame([("BUILDING",), ("MACHINERY",), ("NONE",)], "segment string")
    return files.named_rows(spark, f"{folder}/*/*.csv", ["o_orderkey", "o_orderpriority"], r"c_mktsegment=([A-Z]+)/", "segment", known, "file_path")


def q88_partitioned_sink(spark: SparkSession, d: str) -> DataFrame:
    """A partitioned set written twice: groups that are no more have gone."""
    folder = _folder(spark)
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    sinks.write_partitioned(rows, folder, ["o_orderstatus"])
    sinks.write_partitioned(rows.filter("o_orderstatus <> 'P'"), folder, ["o_orderstatus"])
    return spark.read.parquet(folder).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


def q89_upsert_unique(spark: SparkSession, d: str) -> DataFrame:
    """Rows put in one by one by a primary and a second unique key, of which some clash with each other on either."""
    base = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    name = lambda k: F.concat(F.lit("Customer#"), F.lpad((F.col("c_custkey") + k).cast("string"), 9, "0"))
    rows = [F.struct(F.lit(1).alias("j"), name(0).alias("c_name")), F.struct(F.lit(2).alias("j"), name(3).alias("c_name")), F.struct(F.lit(3).alias("j"), name(1).alias("c_name"))]
    of = F.when(F.col("c_custkey") % 2 == 0, F.array(*rows)).otherwise(F.array(*rows[:2]))
    fresh = base.filter("c_custkey % 3 = 0").select("c_custkey", F.explode(of).alias("r"))
    fresh = fresh.select("c_custkey", "r.c_name", F.col("r.j").cast("double").alias("c_acctbal"), (F.col("c_custkey") * 10 + F.col("r.j")).alias("seq"))
    return sinks.replaced(base, fresh, [["c_custkey"], ["c_name"]], "seq")


def q90_cascade_counts(spark: SparkSession, d: str) -> DataFrame:
    """Orders deleted with their lines; orders that a customer's pick refers to abort the deletion of those beside them."""
    orders = table(spark, d, "orders")
    guard = orders.filter("o_orderstatus = 'P'").groupBy("o_custkey").agg(F.min("o_orderkey").alias("o_orderkey"))
    stored = {"orders": (orders, "o_orderkey"), "lineitem": (table(spark, d, "lineitem"), "l_orderkey")}
    try:
        left, counts = sinks.cascade(stored, orders.filter("o_orderstatus = 'P'").select("o_orderkey"), "o_orderkey", guard)
        aborted = 0
    except ValueError:
        free = orders.filter("o_orderstatus = 'P'").join(guard.select("o_orderkey"), "o_orderkey", "left_anti").select("o_orderkey")
        left, counts = sinks.cascade(stored, free, "o_orderkey", guard)
        aborted = 1
    rest = _union({k: x.agg(F.count("*").alias("n")) for k, x in left.items()})
    out = counts.select(F.concat(F.lit("deleted "), "name").alias("name"), "n").unionByName(rest.select(F.concat(F.lit("left "), "part").alias("name"), "n"))
    return out.unionByName(spark.createDataFrame([("aborted", aborted)], "name string, n long"))


def q91_update_blank_keeps(spark: SparkSession, d: str) -> DataFrame:
    base = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    decided = base.filter("c_custkey % 2 = 0").select("c_custkey", F.when(F.col("c_custkey") % 4 == 0, "  ").otherwise(" NEW").alias("c_mktsegment"))
    return sinks.updated(base, decided, "c_custkey", ["c_mktsegment"])


def q92_load_pack(spark: SparkSession, d: str) -> DataFrame:
    """A pack loaded into stored tables in a fixed order; rows before and after."""
    folder = _folder(spark)
    region, nation = table(spark, d, "region"), table(spark, d, "nation")
    region.filter("r_regionkey < 3").write.parquet(f"{folder}/region")
    nation.filter("n_regionkey < 3").write.parquet(f"{folder}/nation")
    rows = {"region": region.withColumn("seq", F.lit(1)), "nation": nation.filter("n_regionkey > 1").withColumn("seq", F.lit(1))}
    done = sinks.load_pack(spark, folder, [("region", ["r_regionkey"]), ("nation", ["n_nationkey"])], rows)
    return spark.createDataFrame(done, "name string, n_before long, n_after long")


def q93_manifest_files(spark: SparkSession, d: str) -> DataFrame:
    names = ["region", "nation"]
    return sinks.manifest(spark, [f"{d}/{n}.parquet" for n in names])


def q94_page_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Pages without enough text take their blocks' text."""
    docs = table(spark, d, "documents")
    pages = docs.select("doc_id", F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, F.substring("text", 1, 20)).otherwise(F.col("text")).alias("text"))
    blocks = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "block_text"))
    return files.page_or_blocks(pages, blocks, ["doc_id"]).select("doc_id", "reason", F.sha2("text", 256).alias("sha256"))


def q95_ocr_pages(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", (F.col("event_id") % 7 * 1.0).alias("y0"), (F.col("event_id") * 1.0).alias("x0"), F.col("event_type").alias("text"), F.round("value").alias("score"))
    pages = files.ocr_pages(e, ["user_id"])
    return pages.select("user_id", F.sha2("text", 256).alias("sha256"), F.round("confidence", 6).alias("confidence"))


def q96_taxonomy_ids(spark: SparkSession, d: str) -> DataFrame:
    """Domains and subdomains numbered as they were first seen."""
    rows = table(spark, d, "part").select(F.col("p_brand").alias("domain"), F.col("p_type").alias("subdomain"), F.col("p_partkey").alias("seq"))
    return facets.taxonomy_ids(rows)


def q97_source_assets(spark: SparkSession, d: str) -> DataFrame:
    """One asset per source and language, numbered over all as first seen."""
    rows = table(spark, d, "documents").select("source", "lang", F.col("doc_id").alias("seq"))
    return facets.first_seen_ids(rows, ["source", "lang"], "seq", "AST", 5)


def q98_matrix_detail(spark: SparkSession, d: str) -> DataFrame:
    """Cells of nation and part type: groups, contents, how many are reviewed, the most frequent brand."""
    places = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = table(spark, d, "orders").join(places, F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(_terms(spark, d), "o_orderkey", "left").withColumn("reviewed", F.col("o_orderstatus") == "F")
    return facets.matrix_detail(rows, "n_name", "p_type", "o_custkey", "o_orderkey", "reviewed", "p_brand")


def q99_network_nodes(spark: SparkSession, d: str) -> DataFrame:
    cells = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("l_returnflag").alias("policy"), F.col("p_type").alias("domain")).agg(F.count("*").alias("n_contents"))
    return facets.nodes(cells)

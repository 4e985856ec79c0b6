"""The registered queries of the reference's operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import facets, graph, labels, layout, ranking, review, scoring, textops, validate
from docloom.plans import oracles
from docloom.session import table

Query = Callable[[SparkSession, str], DataFrame]

BASE = "http://example.org/docloom"
#: Parameters of the example queries, chosen to fit the test text.
LANGUAGE_TERMS = [
    scoring.Term("the", ("and", "with", "of"), ("ing",), "en"),
    scoring.Term("les", ("des", "que", "dans"), ("eau",), "fr"),
    scoring.Term("nicht", ("der", "sch", "und"), ("ung",), "de"),
    scoring.Term("los", ("una", "por", "del"), ("ción",), "es"),
    scoring.Term("license", ("copyright", "permission")),
]
PART_TERMS = [scoring.Term("small ring"), scoring.Term("red widget"), scoring.Term("blue bolt"), scoring.Term("hot gear")]
#: Points of a subdomain's label and of each of its words.
SUBDOMAIN = scoring.Weights(label=6, word=2, most_words=None)
#: Labels that, as a document's best, keep it out.
EXCEPTED = ("license",)
RESOURCES = {"legal": ("license", "copyright"), "personal": ("@", "+"), "junk": ("***", "###", "%%%")}


def order_terms(spark: SparkSession, d: str) -> DataFrame:
    """A row per order and distinct part type, with its lines; an order without lines has a null type."""
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    terms = lines.groupBy("l_orderkey", "p_type").agg(F.count("*").alias("n_lines"))
    places = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    orders = table(spark, d, "orders").join(places, F.col("o_custkey") == F.col("c_custkey"))
    return orders.join(terms, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("r_name", "o_custkey", "o_orderkey", "p_type", "n_lines")


def q01_matrix_policy_domain(spark: SparkSession, d: str) -> DataFrame:
    return facets.matrix(order_terms(spark, d), "r_name", "p_type", "o_custkey", "o_orderkey", "n_lines")


def q02_facets_leave_one_out(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    types = lines.groupBy("l_orderkey").agg(F.collect_set("p_type").alias("types"))
    rows = (
        table(spark, d, "orders")
        .join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(types, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select("c_mktsegment", "o_orderstatus", F.coalesce("types", F.expr("cast(array() as array<string>)")).alias("types"))
    )
    chosen = {"segment": "BUILDING", "status": "F", "type": "PROMO"}
    return facets.leave_one_out(rows, {"segment": "c_mktsegment", "status": "o_orderstatus"}, {"type": "types"}, chosen)


def q03_filter_sorted_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    chosen = rows.filter((F.col("o_orderstatus") == "F") & (F.col("c_mktsegment") == "BUILDING") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return chosen.select("o_orderkey", "c_name", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(12)


def q04_overview_ratio(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    urgent = F.count_if(F.col("o_orderpriority") == "1-URGENT")
    by = rows.groupBy(F.col("c_mktsegment").alias("category")).agg(F.count("*").alias("n"), urgent.alias("n_urgent"))
    return by.withColumn("percent", facets.half_up_percent(F.col("n_urgent"), F.col("n")))


def q05_status_rollup(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("r"))
    rows = table(spark, d, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    n, r = F.coalesce("n", F.lit(0)), F.coalesce("r", F.lit(0))
    return rows.select("c_custkey", n.alias("n_contents"), r.alias("n_reviewed"), facets.status_rollup(n, r).alias("status"))


def q06_network_edges(spark: SparkSession, d: str) -> DataFrame:
    return facets.edges(q01_matrix_policy_domain(spark, d))


def q09_unit_split_islands(spark: SparkSession, d: str) -> DataFrame:
    return textops.short_runs(table(spark, d, "documents"), 2)


def q12_dedup_repeated_lines(spark: SparkSession, d: str) -> DataFrame:
    lines = F.split("text", "\n")
    kept = F.array_distinct(lines)  # keeps the first of equal lines, in order
    return table(spark, d, "documents").select(
        "doc_id", F.size(lines).cast("long").alias("n_lines"), F.size(kept).cast("long").alias("n_kept"), F.sha2(F.array_join(kept, "\n"), 256).alias("kept_sha256")
    )


def q13_label_summary(spark: SparkSession, d: str) -> DataFrame:
    first = F.get(F.split("text", "\n"), F.lit(0))
    return table(spark, d, "documents").select(
        "doc_id",
        labels.label(first).alias("label"),
        labels.label(first, 60, 57, retry=False).alias("merge_label"),
        *(labels.summary(F.col("text"), k).alias(f"summary_{k}") for k in labels.SUMMARIES),
        labels.slug(first).alias("slug"),
    )


def q14_matchkey(spark: SparkSession, d: str) -> DataFrame:
    key, compare = textops.match_key(F.col("text")), labels.compare_key(F.col("text"))
    words = labels.keywords(F.split("text", "\n"))
    return table(spark, d, "documents").select(
        "doc_id",
        F.char_length(key).cast("long").alias("key_chars"),
        F.sha2(key, 256).alias("key_sha256"),
        F.char_length(compare).cast("long").alias("compare_chars"),
        F.size(F.filter(words, lambda w: w.rlike("^[a-z0-9]+$"))).cast("long").alias("n_keywords"),
    )


def _scored(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, terms): the scored terms of each document; the first line is title and focus, the language the prior."""
    docs = table(spark, d, "documents").withColumn("key", textops.match_key(F.col("text"))).withColumn("title", textops.match_key(F.get(F.split("text", "\n"), F.lit(0))))
    how = {"title": F.col("title"), "focus": F.col("title"), "prior": F.col("lang")}
    return docs.select("doc_id", scoring.scored(F.col("key"), LANGUAGE_TERMS, **how).alias("terms"))


def q17_keyword_score(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("doc_id", F.explode_outer("terms").alias("s")).filter("s is not null").select("doc_id", "s.label", "s.display_order", (-F.col("s.minus")).alias("score"))


def q18_top2_margin(spark: SparkSession, d: str) -> DataFrame:
    top = _scored(spark, d).select("doc_id", F.posexplode(scoring.within_margin(F.col("terms"))).alias("p", "s"))
    rows = top.select("doc_id", "s.label", "s.display_order", (-F.col("s.minus")).alias("score"), (F.col("p") + 1).alias("rank"))
    return rows.withColumn("is_primary", (F.col("rank") == 1).cast("int")).withColumn("confidence", scoring.confidence(F.col("score"), scoring.ITEM_STEPS, "medium")).withColumn(
        "paragraph_confidence", scoring.confidence(F.col("score"), scoring.PARAGRAPH_STEPS, None)
    )


def q19_top3_suggest(spark: SparkSession, d: str) -> DataFrame:
    rows = _scored(spark, d).filter(F.size("terms") > 0)
    return rows.select("doc_id", *(F.get("terms", F.lit(i))["label"].alias(n) for i, n in enumerate(("suggested", "alternate_1", "alternate_2"))))


def q20_subdomain_infer(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part")
    best = F.get(scoring.scored(textops.match_key(F.col("p_name")), PART_TERMS, weights=SUBDOMAIN, least_word=1), F.lit(0))
    return parts.select("p_partkey", best.alias("b")).filter("b is not null").select("p_partkey", "b.label", (-F.col("b.minus")).alias("score"))


def q21_resource_unique_max(spark: SparkSession, d: str) -> DataFrame:
    name, hits = scoring.unique_max(F.lower("text"), RESOURCES)
    return table(spark, d, "documents").select("doc_id", name.alias("resource"), hits.alias("hits")).withColumn(
        "confidence", F.when(F.col("resource").isNull(), "none").when(F.col("hits") >= 2, "high").otherwise("medium")
    )


def q22_candidate_gate_lag(spark: SparkSession, d: str) -> DataFrame:
    return textops.gate(table(spark, d, "documents")).select("doc_id", "pos", "candidate")


def q23_heading_carry_forward(spark: SparkSession, d: str) -> DataFrame:
    return textops.carry_heading(table(spark, d, "documents")).select("doc_id", "pos", "heading")


def q28_decision_key(spark: SparkSession, d: str) -> DataFrame:
    name = textops.match_key(labels.label(F.get(F.split("text", "\n"), F.lit(0))))
    lens = review.lens_key(F.col("lang"), F.col("source"), F.lit(None), F.concat_ws(", ", F.lit("b"), F.col("doc_id").cast("string"), F.lit("b | a")))
    return table(spark, d, "documents").select("doc_id", review.decision_key("SRD", F.col("source"), F.col("lang"), F.col("doc_id"), name).alias("decision_key"), lens.alias("lens_key"))


def q29_review_queue_double_anti(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels")
    docs = table(spark, d, "documents").select("doc_id", "source")
    return docs.join(labels.filter("quality = 1").select("doc_id"), "doc_id", "left_anti").join(labels.filter("toxic = 1").select("doc_id"), "doc_id", "left_anti")


def q30_ledger_reconcile(spark: SparkSession, d: str) -> DataFrame:
    queue = table(spark, d, "documents").filter("n_chars > 500").select("doc_id", "n_chars")
    ledger = table(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "approved").otherwise("pending").alias("status"))
    return review.reconcile(queue, ledger, "doc_id", F.col("n_chars") > 5000, F.coalesce(F.col("status") == "approved", F.lit(False))).select("doc_id", "n_chars", "active", "status")


def q31_apply_decisions(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "documents").filter("lang = 'en'").select("doc_id", F.lit(True).alias("known"))
    invalid = (F.col("quality") == 0) & (F.col("toxic") == 1)
    return table(spark, d, "labels").join(items, "doc_id", "left").select(
        "doc_id", F.when(invalid, "invalid_decision").when(F.col("known").isNull(), "missing_target").otherwise("applied").alias("outcome")
    )


def q32_batch_edit_first_wins(spark: SparkSession, d: str) -> DataFrame:
    return review.first_wins(table(spark, d, "conversations"), ["conv_id", "role"], "turn")


def q33_packet_chunks(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).withColumn("lead", -F.col("o_totalprice"))
    rows = ranking.ranked(rows.select("c_mktsegment", "o_orderkey", "o_orderstatus", "lead"), "lead", [F.col("lead"), F.col("o_orderkey")], ["c_mktsegment"])
    batch = F.expr("(rank - 1) div 40 + 1")
    return rows.groupBy(F.col("c_mktsegment").alias("packet"), batch.alias("batch")).agg(
        F.count("*").alias("n"), *(F.count_if(F.col("o_orderstatus") == s).alias(f"n_{s.lower()}") for s in "FOP")
    )


def q34_brief_topk(spark: SparkSession, d: str) -> DataFrame:
    return ranking.most_common(table(spark, d, "part"), "p_type", "p_brand", "p_partkey", 5)


def q35_priority_rank(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", (-F.col("o_totalprice")).alias("lead"))
    return ranking.ranked(rows, "lead", [F.col("lead"), F.col("o_orderkey")], name="priority_rank").select("o_orderkey", "priority_rank")


def q36_upsert_replace(spark: SparkSession, d: str) -> DataFrame:
    base = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    incoming = base.filter("c_acctbal < 0").select("c_custkey", F.lit("REVIEW").alias("c_mktsegment"), F.lit(0.0).alias("c_acctbal"))
    return review.upsert(base, incoming, "c_custkey")


def q37_slice_delete_guard(spark: SparkSession, d: str) -> DataFrame:
    protected = table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return review.guarded_delete(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", F.col("o_orderstatus") == "P", protected)


def q38_backlog_lattice(spark: SparkSession, d: str) -> DataFrame:
    marks = table(spark, d, "labels").groupBy("doc_id").agg(F.max(F.struct("toxic", "quality")).alias("m")).select("doc_id", "m.toxic", "m.quality")
    rows = table(spark, d, "documents").join(marks, "doc_id", "left")
    status = F.when(F.col("quality").isNull(), "unreviewed").when(F.col("toxic") == 1, "blocked").when(F.col("quality") == 1, "done").otherwise("rework")
    priority = F.when(status == "blocked", 0).when(status == "rework", 1).when(status == "unreviewed", 2).otherwise(3)
    return rows.groupBy("source", status.alias("status"), priority.alias("priority")).agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


def q39_source_assets(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("source", "lang").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("n_docs"), F.count_distinct(F.sha2("text", 256)).alias("n_texts"))


def q40_flat_export_nested(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("k"))
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(items, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.select("n_name", "c_custkey", F.coalesce(F.array_join("k", ","), F.lit("")).alias("order_keys"))


def q42_lens_provisional_fill(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_type", "p_brand", "p_size", "p_partkey", "p_retailprice")
    return ranking.diverse_top(rows, "p_type", ["p_brand", "p_size"], [F.desc("p_retailprice"), F.col("p_partkey")], 20).select("p_type", "p_partkey", "place")


def q43_lens_domain_rollup(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy(F.col("p_type").alias("domain")).agg(
        F.count_distinct("l_suppkey").alias("n_groups"), F.count("*").alias("n_contents"), F.count_distinct("p_brand").alias("n_terms"), F.count_if(F.col("l_returnflag") == "R").alias("n_returned")
    )


def q44_draft_pack_quota(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_brand", "p_partkey", "p_size")
    return ranking.quota(rows, "p_brand", [F.desc("p_size"), F.col("p_partkey")], "p_partkey", 3, 6).select("p_brand", "p_partkey", "place")


def q46_best_evidence(spark: SparkSession, d: str) -> DataFrame:
    best = F.max(F.struct((F.col("l_returnflag") == "R").cast("int").alias("r"), "l_quantity", "l_extendedprice", (-F.col("l_linenumber")).alias("l"), (-F.col("l_partkey")).alias("p")))
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(best.alias("b")).select("l_orderkey", (-F.col("b.p")).alias("l_partkey"), F.col("b.l_quantity").alias("l_quantity"))


def q47_briefing_tone(spark: SparkSession, d: str) -> DataFrame:
    cells = q01_matrix_policy_domain(spark, d)
    mean = cells.groupBy("domain").agg((F.sum("n_contents") / F.count("*")).alias("mean"))
    return cells.join(mean, "domain").select("policy", "domain", facets.tone(F.col("n_contents") / F.col("mean")).alias("tone"))


def q48_triples(spark: SparkSession, d: str) -> DataFrame:
    def iri(kind: str, column: str):
        return graph.iri(BASE, kind, F.col(column))

    region = graph.triples(table(spark, d, "region"), iri("region", "r_regionkey"), {"label": F.col("r_name")})
    nation = graph.triples(table(spark, d, "nation"), iri("nation", "n_nationkey"), {"label": F.col("n_name"), "inRegion": iri("region", "n_regionkey")})
    customer = graph.triples(table(spark, d, "customer"), iri("customer", "c_custkey"), {"label": F.col("c_name"), "inNation": iri("nation", "c_nationkey"), "segment": iri("segment", "c_mktsegment")})
    return region.unionByName(nation).unionByName(customer)


def q49_induced_closure(spark: SparkSession, d: str) -> DataFrame:
    start = table(spark, d, "region").filter("r_regionkey in (1, 3)").select("r_regionkey")
    steps = [
        ("nation", table(spark, d, "nation"), "n_regionkey", "n_nationkey"),
        ("customer", table(spark, d, "customer"), "c_nationkey", "c_custkey"),
        ("order", table(spark, d, "orders"), "o_custkey", "o_orderkey"),
    ]
    parts = [x.select(F.lit(k).alias("kind"), F.col(x.columns[0]).cast("long").alias("id")) for k, x in graph.closure(start, steps).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q50_shape_check(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    lines = table(spark, d, "lineitem")
    subjects = orders.select(graph.iri(BASE, "order", F.col("o_orderkey")).alias("subject"))
    facts = graph.triples(lines, graph.iri(BASE, "order", F.col("l_orderkey")), {"hasPart": graph.iri(BASE, "part", F.col("l_partkey"))})
    return graph.shape_violations(subjects, facts, "hasPart", 1, 7)


def q51_store_validate(spark: SparkSession, d: str) -> DataFrame:
    t = {n: table(spark, d, n) for n in ("orders", "lineitem", "customer", "part", "supplier", "nation", "documents", "labels")}
    missing = [
        ("warning", "order_without_line", "orders", "o_orderkey", "lineitem", "l_orderkey"),
        ("error", "line_without_order", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("error", "line_without_part", "lineitem", "l_partkey", "part", "p_partkey"),
        ("error", "line_without_supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
        ("error", "customer_without_nation", "customer", "c_nationkey", "nation", "n_nationkey"),
        ("warning", "document_without_label", "documents", "doc_id", "labels", "label_doc"),
    ]
    t["labels"] = t["labels"].withColumnRenamed("doc_id", "label_doc")
    return validate.report(
        [validate.finding(t[a].select(ka).join(t[b].select(kb), F.col(ka) == F.col(kb), "left_anti"), level, code) for level, code, a, ka, b, kb in missing]
        + [validate.finding(t["orders"].groupBy("o_orderkey").count().filter("count > 1"), "error", "order_key_repeated")]
    )


def q55_unpivot_taxonomy(spark: SparkSession, d: str) -> DataFrame:
    long = table(spark, d, "part").unpivot(["p_partkey"], ["p_brand", "p_type"], "taxonomy", "term")
    return long.groupBy("taxonomy", "term").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first_part"))


def q57_overlay_decisions(spark: SparkSession, d: str) -> DataFrame:
    decided = table(spark, d, "labels").select("doc_id", F.when(F.col("toxic") == 1, "toxic").alias("source"))
    return review.overlaid(table(spark, d, "documents").select("doc_id", "source"), decided, "doc_id", ["source"])


def q58_manifest_sha256(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha256"))


def q07_line_blocks(spark: SparkSession, d: str) -> DataFrame:
    return layout.ordered_lines(table(spark, d, "documents"), "doc_id", "text")


def q08_block_classify(spark: SparkSession, d: str) -> DataFrame:
    return layout.html_blocks(table(spark, d, "pages"), "page_id", "html")


def q27_exception_block(spark: SparkSession, d: str) -> DataFrame:
    top = _scored(spark, d).select("doc_id", F.get("terms", F.lit(0)).alias("t"), F.size("terms").cast("long").alias("n_terms")).filter("t is not null")
    return top.filter(~F.col("t.label").isin(*EXCEPTED)).select("doc_id", F.col("t.label").alias("label"), (-F.col("t.minus")).alias("score"), "n_terms")


def q45_adapter_rows(spark: SparkSession, d: str) -> DataFrame:
    number = F.col("l_linenumber")
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.every(F.col("l_linestatus") == "F").alias("done"),
        F.coalesce(F.min(F.when(F.col("l_returnflag") == "R", number)), F.min(F.when(F.col("l_returnflag") == "A", number)), F.min(number)).alias("preferred_line"),
    )
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return rows.select(
        "o_orderkey",
        F.lower(F.concat_ws(" ", "c_name", "c_mktsegment", "o_orderpriority", "o_orderstatus")).alias("search_text"),
        F.when(F.col("done"), "reviewed").otherwise("needs_review").alias("review_status"),
        "preferred_line",
    )


def q52_projection_validate(spark: SparkSession, d: str) -> DataFrame:
    orders, lines = table(spark, d, "orders").select("o_orderkey"), table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    per_order = lines.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.countDistinct("l_linenumber").alias("k"), F.min("l_linenumber").alias("lo"), F.max("l_linenumber").alias("hi"))
    same = orders.o_orderkey == per_order.l_orderkey
    assigned, unassigned = orders.join(per_order, same, "left_semi"), orders.join(per_order, same, "left_anti")
    return validate.report(
        [
            validate.finding(assigned.intersect(unassigned), "error", "assigned_and_unassigned"),
            validate.finding(unassigned, "warning", "unassigned"),
            validate.finding(per_order.filter("n <> k"), "error", "line_key_repeated"),
            validate.finding(per_order.filter("lo <> 1 or hi <> n"), "error", "lines_out_of_order"),
        ]
    )


def q56_bbox_overlap(spark: SparkSession, d: str) -> DataFrame:
    boxes = table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        F.col("l_quantity").alias("x0"),
        (F.col("l_linenumber") * 10.0).alias("y0"),
        (F.col("l_quantity") + 10.0).alias("x1"),
        (F.col("l_linenumber") * 10.0 + 8.0).alias("y1"),
    )
    tables = layout.box_union(boxes.filter("l_returnflag = 'R'"), "l_orderkey")
    met = boxes.alias("a").join(tables.alias("b"), "l_orderkey").filter(layout.covered_share("a", "b") >= 0.35)
    return met.select("l_orderkey", "l_linenumber", *(F.col(f"b.{c}").alias(f"table_{c}") for c in ("x0", "y0", "x1", "y1")))


def queries() -> dict[str, Query]:
    from docloom.plans import corpus, evidence, readmodel

    every = {**globals(), **vars(evidence), **vars(corpus), **vars(readmodel)}
    return {name: every[name] for name in sorted(every) if name[0] == "q" and name[1:3].isdigit()}


def oracle_sql() -> dict[str, str]:
    from docloom.plans import corpus_oracles, evidence_oracles, readmodel_oracles

    return {**oracles.SQL, **evidence_oracles.SQL, **corpus_oracles.SQL, **readmodel_oracles.SQL}

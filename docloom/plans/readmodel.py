"""Queries of labels, page rules, figures, review extras, policy views and what else a reader of the model asks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import facets, labels, lens, mining, overview, pagetext, review, tables, textops
from docloom.plans.evidence import _folder
from docloom.session import table
from docloom.sources import sinks
from docloom.streaming import ledger


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


def _dealt(values: list, n: Column) -> Column:
    """One of the values, or columns, by a number."""
    return F.get(F.array(*(v if isinstance(v, Column) else F.lit(v) for v in values)), (n % len(values)).cast("int"))


# labels and page rules


def q114_label_forms(spark: SparkSession, d: str) -> DataFrame:
    """Each line with a mark before and Hangul behind it: spaced, without its marks, with particles, as a place, as a caption."""
    n = F.col("doc_id") + F.col("pos")
    v = F.concat(_dealt(["", "①② ", "- ", "○ - "], n), "line", _dealt(["", "가", "각", "정책2"], F.floor(n / 4)))
    place = _dealt(["", F.col("pos").cast("string"), F.concat(F.lit("section"), "pos"), F.concat(F.lit("Page "), "pos"), F.col("line")], n)
    caption = _dealt(["image 3", "", "figure", "Image_12", F.col("line")], n)
    return _lines(spark, d).select(
        "doc_id", "pos", F.sha2(labels.spaced(v), 256).alias("spaced_sha256"), F.sha2(labels.without_lead(v), 256).alias("plain_sha256"), labels.looks_raw(v).alias("raw"),
        labels.topic_particle(v).alias("topic"), labels.object_particle(v).alias("object"), F.sha2(labels.location(place), 256).alias("place_sha256"), labels.is_generic_caption(caption).alias("generic"),
    )


def q115_line_rules(spark: SparkSession, d: str) -> DataFrame:
    """Each line, some made page numbers, marks or sections: why it is skipped, in how many sections it falls, private-use signs as dashes."""
    n = F.col("doc_id") + F.col("pos")
    marked = F.concat("line", F.lit(" ① ("), "line", F.lit(")"))
    v = _dealt(["12", "① ", "-", "p. 7", marked, F.replace("line", F.lit("*"), F.lit("")), F.col("line"), F.lit("- 3 -")], n)
    reason = pagetext.skip_reason(v, F.col("pos") % 20 * 50, F.lit(1000), n % 10 * 0.05)
    return _lines(spark, d).select("doc_id", "pos", F.coalesce(reason, F.lit("")).alias("skip"), F.size(pagetext.split_sections(v)).cast("long").alias("n_sections"), F.sha2(labels.without_private_use(v), 256).alias("text_sha256"))


def q116_markdown_runs(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose lines are partly table lines and partly blank, as runs of one kind."""

    def made(x: Column, i: Column) -> Column:
        n = F.col("doc_id") + i
        return F.when(n % 5 < 2, F.concat(F.lit("| a | "), x, F.lit(" |"))).when(n % 7 == 3, "").otherwise(x)

    docs = table(spark, d, "documents").select("doc_id", F.array_join(F.transform(F.split("text", "\n"), made), "\n").alias("text"))
    return pagetext.markdown_blocks(docs, "doc_id", "text").select("doc_id", "pos", "kind", F.sha2("text", 256).alias("text_sha256"))


# tables and figures


def q117_figures(spark: SparkSession, d: str) -> DataFrame:
    """Events as figures: suggested class and quality; users with reviewed rows have these instead of the raw ones."""
    n = F.col("event_id")
    kind = tables.figure_class(_dealt(["logo", "chart", "photo", "map", "icon"], n), _dealt(["evidence", "context"], n), _dealt(["excluded", "included", "included"], n))
    quality = tables.figure_quality(_dealt(["", " high ", F.lit(None).cast("string")], n), _dealt(["accepted", "rejected", "pending"], F.floor(n / 3)))
    raw = table(spark, d, "events").select("user_id", "event_id", kind.alias("figure_class"), quality.alias("quality"))
    return tables.reviewed_first(raw, raw.filter("event_id % 50 = 0").withColumn("quality", F.lit("checked")), "user_id")


def q118_seeded_tables(spark: SparkSession, d: str) -> DataFrame:
    """Order lines as tables: shape of their Markdown, seeded decision, canonical id by place in their order."""
    flag = F.col("l_returnflag")
    kind = F.when(flag == "R", "layout_false_positive").when(flag == "A", "structured_table").otherwise("review_required")
    table_id = F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey")
    text = F.concat(F.when(F.col("l_linenumber") % 3 == 0, "note\n").otherwise(""), F.repeat(F.concat(F.lit("| a | "), flag, F.lit(" |\n")), F.col("l_linenumber").cast("int")))
    shape = tables.markdown_shape(text)
    queue = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), table_id.alias("table_id"), kind.alias("table_class"), shape["rows"].cast("long").alias("n_rows"), shape["cols"].cast("long").alias("n_cols")).distinct()
    return tables.seeded_decisions(queue, "table_id")


# mining and review


def q119_statement_roles(spark: SparkSession, d: str) -> DataFrame:
    """Lines by role and note, with common words of the tables' languages in place of the lists."""
    words = mining.RoleWords(
        change=("the",), change_acts=("whst",), frame=("nicht", "eau"), short_frame=("of", "de"), case_pattern="(?i)on", direction="Is", background=("and",), hard_problem=("ttion", "sch"), soft_problem=("un", "re"), need_pattern="[Ee]n", strong=("that",), acts=("for", "is")
    )
    x = F.when(F.col("pos") % 6 == 1, F.concat(F.lit("“"), "line", F.lit("”"))).otherwise(F.col("line"))
    return _lines(spark, d).select(mining.statement_role(x, words).alias("r")).groupBy("r.role", "r.note").agg(F.count("*").alias("n"))


def q120_rolled_up(spark: SparkSession, d: str) -> DataFrame:
    """Orders with the distinct marks of their lines in order of appearance, and their flags joined."""
    marks = F.array("l_returnflag", F.concat(F.lit("P"), (F.col("l_partkey") % 3).cast("string")), F.concat(F.lit("S"), (F.col("l_suppkey") % 2).cast("string")))
    at = F.col("l_linenumber") * 1_000_000 + F.col("l_partkey")
    out = mining.rolled_up(table(spark, d, "lineitem").select("l_orderkey", at.alias("at"), marks.alias("marks"), F.col("l_returnflag").alias("flag")), ["l_orderkey"], "at", ["marks"], "flag")
    return out.select("l_orderkey", F.array_join("marks", ",").alias("marks"), F.col("flag").alias("flags"))


def q121_lens_sync(spark: SparkSession, d: str) -> DataFrame:
    """Open orders as a queue against an old ledger: what stays for its status or an edited note, what is new, what goes; priority and action by role."""
    orders = table(spark, d, "orders")
    k = F.col("o_orderkey")
    ledger = orders.filter("o_orderkey % 3 = 0").select("o_orderkey", _dealt(["approved", "pending", "revised"], F.floor(k / 3)).alias("status"), _dealt(["", "seen", " "], F.floor(k / 9)).alias("notes"))
    out = review.lens_synced(orders.filter("o_orderstatus = 'O'").select("o_orderkey", "o_custkey"), ledger, "o_orderkey", F.col("status").isin("approved", "revised"), "notes")
    role = _dealt(["policy_action", "case_example", "background_context", "other"], k)
    ids = review.exception_ids(_dealt(["", "E1| E2", F.lit(None).cast("string")], k), _dealt(["E7 and E9", "E9"], k), ["E7", "E8", "E9"])
    return out.select(
        "o_orderkey", "active", "status", "notes", "o_custkey", review.workbench_priority(role, k % 3, _dealt(["low", "high"], F.floor(k / 4))).alias("priority"), review.suggested_action(role).alias("action"), F.array_join(ids, ",").alias("exceptions")
    )


def q122_regrouped_pack(spark: SparkSession, d: str) -> DataFrame:
    """Domain-rooted groups below their policy, each once, where it was seen first."""
    rows = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("policy"), F.col("l_returnflag").alias("domain"), (F.col("l_partkey") % 20).alias("grp"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"))
    return lens.regrouped(rows, "policy", "domain", "grp", "at").select("policy", F.posexplode("groups").alias("place", "g")).select("policy", "place", "g.seq", "g.group", "g.domain")


def q123_written_texts(spark: SparkSession, d: str) -> DataFrame:
    """Documents written as JSON, nulls kept, and as HTML lines, both read back."""
    docs = table(spark, d, "documents").select("doc_id", "text", F.when(F.col("doc_id") % 4 > 0, F.col("lang")).alias("lang"))
    one, two = _folder(spark), _folder(spark)
    sinks.write_json(docs, one)
    sinks.write_lines(docs, two, F.concat(F.lit("<li>"), F.col("doc_id").cast("string"), F.lit("|"), labels.html_escaped(F.replace("text", F.lit("\n"), F.lit(" "))), F.lit("</li>")))
    a = spark.read.schema("doc_id long, text string, lang string").json(one).select(F.lit("json").alias("form"), "doc_id", F.sha2(F.concat_ws("|", "text", F.coalesce("lang", F.lit("-"))), 256).alias("sha256"))
    lines = spark.read.text(two).select("value", F.regexp_extract("value", r"^<li>(\d+)\|", 1).cast("long").alias("doc_id"))
    return a.unionByName(lines.select(F.lit("html").alias("form"), "doc_id", F.sha2("value", 256).alias("sha256")))


# views


def _content(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_partkey")
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))


def q124_policy_views(spark: SparkSession, d: str) -> DataFrame:
    """Customers as policies: groups, contents, those shown, curated or provisional or both."""
    return overview.policy_views(_content(spark, d).filter("l_quantity > 10"), "o_custkey", "o_orderkey", "l_linenumber", F.col("l_returnflag") == "N", 25)


def q125_bucket_signals(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's buckets by priority: all groups and contents beside the matched ones."""
    return overview.bucket_signals(_content(spark, d), F.col("l_quantity") > 40, ["o_custkey", "o_orderpriority"], "o_orderkey", "l_linenumber")


def q126_selection(spark: SparkSession, d: str) -> DataFrame:
    """The wanted order of each customer, its latest by key, or the dearest one where none or an unknown one is wanted; the view's state as text and read back."""
    orders = table(spark, d, "orders")
    wanted = orders.groupBy("o_custkey").agg(F.when(F.col("o_custkey") % 3 == 0, F.max("o_orderkey")).when(F.col("o_custkey") % 3 == 1, F.lit(-1)).alias("o_orderkey"))
    out = overview.selected_or_first(orders, "o_custkey", wanted, "o_orderkey", [-F.col("o_totalprice"), F.col("o_orderkey")])
    view = _dealt(["list", "grid & more", "bad"], F.col("o_custkey"))
    state = overview.state_text({"view": view, "order": F.col("o_orderkey").cast("string"), "page": F.lit("1")}, {"view": "list", "page": "1"})
    back = overview.state_fields(F.col("state"), {"view": "list", "order": "", "page": "1"}, {"view": ["list", "grid & more"]})
    return out.withColumn("state", state).select("o_custkey", "o_orderkey", "found", "state", back["view"].alias("view"), back["order"].alias("read_order"), back["page"].alias("page"))


def q127_supporting_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The two lines of each document that hold most of the benchmark's longer words; the first line is the title."""
    words = table(spark, d, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{5,}"), F.lit(0))).alias("w")).select(textops.match_key(F.col("w")).alias("key"))
    lines = _lines(spark, d).select("doc_id", F.col("pos").alias("block_id"), textops.match_key(F.col("line")).alias("text"))
    titles = table(spark, d, "documents").select("doc_id", textops.match_key(F.regexp_extract("text", "[A-Za-z]{5,}", 0)).alias("title"))
    return overview.supporting_blocks(lines, words, titles)


def q128_backlog(spark: SparkSession, d: str) -> DataFrame:
    """The twenty orders at the head of a backlog by priority, status and number of lines."""
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_lines"))
    rows = table(spark, d, "orders").join(lines, "o_orderkey").select("o_orderkey", "o_orderstatus", "n_lines", _dealt(["low", "none", "high", "medium", "odd"], F.col("o_orderkey")).alias("priority"))
    return rows.orderBy(*overview.backlog_order(F.col("priority"), F.col("o_orderstatus"), F.col("n_lines"), F.col("o_orderkey"))).limit(20)


def q129_catalogue_grid(spark: SparkSession, d: str) -> DataFrame:
    """Each customer with the three resource categories, numbered through, and the bounds of the orders of each, by priority's first digit."""
    grid = overview.catalogue_grid(table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") + 1).alias("seq")), "seq", list(lens.CATEGORY_ORDER))
    orders = table(spark, d, "orders").select("o_custkey", (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("at"), F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderkey")).alias("key"))
    bounds = overview.chunk_bounds(orders, ["o_custkey", "at"], "key")
    at = (F.col("number") - 1) % 3
    return grid.join(bounds, (F.col("c_custkey") == F.col("o_custkey")) & (at == F.col("at")), "left").select("c_custkey", "category", "number", "n", "least", "most")


def q130_rebuilt_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Packets of customers' orders by status, one kind without a reviewer, joined with the latest drafts."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    packets = [orders.filter("o_orderstatus = 'O'").drop("o_orderpriority"), orders.filter("o_orderstatus = 'F'")]
    drafts = table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", (F.col("l_linenumber") * 1_000_000 + F.col("l_partkey")).alias("seq"))
    return overview.rebuilt_ledger(packets, drafts, "o_orderkey", ["o_orderstatus", "o_orderpriority"], ["l_partkey", "note"])


def q131_located_assets(spark: SparkSession, d: str) -> DataFrame:
    """An asset for each place of twenty lines in each document, numbered over all as first seen."""
    rows = _lines(spark, d).select("doc_id", F.floor(F.col("pos") / 20).alias("place"), (F.col("doc_id") * 1_000_000 + F.col("pos")).alias("seq"))
    return facets.first_seen_ids(rows, ["doc_id", "place"], "seq", "AST", 2)


def q132_last_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Orders with the flag of their last line by number and part as the decision laid over their status."""
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("o_orderstatus"), (F.col("l_linenumber") * 1_000_000 + F.col("l_partkey")).alias("seq"))
    return review.overlaid(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), lines.filter("o_orderstatus <> 'N'"), "o_orderkey", ["o_orderstatus"], seq="seq")


def q133_streamed_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Order lines as a stream of decisions on parts, folded into a ledger by keyed state and read back."""
    path, checkpoint = _folder(spark), _folder(spark)
    schema = spark.read.parquet(f"{d}/lineitem.parquet").schema
    # by a glob, as a stream takes a plain path for a folder, and the table may be one file
    stream = spark.readStream.schema(schema).parquet(f"{d}/lineitem.parque[t]")
    decided = stream.select("l_partkey", "l_returnflag", "l_suppkey", (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("seq"))
    ledger.keep(decided, "l_partkey", ["l_returnflag", "l_suppkey"], "seq", path, checkpoint)
    return ledger.ledger(spark, path, "l_partkey", "l_partkey long, l_returnflag string, l_suppkey long, seq long, n long")

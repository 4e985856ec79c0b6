"""Queries of the operators that take vocabularies, shapes, hierarchies, commits and sections as data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import facets, hierarchy, lens, pagetext, resolve, sections, shapes, textops, vocabulary
from docloom.plans.evidence import _folder
from docloom.session import table
from docloom.sources import commits, sinks

# vocabularies


def q100_vocabulary_table(spark: SparkSession, d: str) -> DataFrame:
    """The scores of q17 with the vocabulary as a table."""
    from docloom.plans.catalogue import LANGUAGE_TERMS

    docs = table(spark, d, "documents").select("doc_id", "lang", textops.match_key(F.col("text")).alias("key"), textops.match_key(F.get(F.split("text", "\n"), F.lit(0))).alias("title"))
    return vocabulary.scores(docs, "doc_id", vocabulary.vocabulary_rows(spark, LANGUAGE_TERMS), "key", "title", "lang")


def q101_vocabulary_index(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold each longer word of the conversations, wherever it begins."""
    words = table(spark, d, "conversations").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{9,}"), F.lit(0))).alias("w"))
    docs = table(spark, d, "documents").select("doc_id", textops.match_key(F.col("text")).alias("key"))
    found = vocabulary.held(docs, ["doc_id"], "key", words.select(textops.match_key(F.col("w")).alias("key")))
    return found.groupBy(F.col("key").alias("term")).agg(F.count("*").alias("n_docs"))


# stored tables


def q102_document_commits(spark: SparkSession, d: str) -> DataFrame:
    """Lines loaded by document, twice: junk fails, what has been loaded is skipped or run again, and what is committed is read back."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    store = commits.Store(spark, _folder(spark))
    checks = {"lines": {"junk": F.contains("line", F.lit("***"))}}
    named = docs.select("doc_id").unionByName(docs.select((-F.col("doc_id") - 1).alias("doc_id")))
    first = store.load(named.filter("doc_id % 3 <> 0"), {"lines": lines}, checks, "lines")
    second = store.load(docs.filter("doc_id % 2 = 0"), {"lines": lines}, checks)
    third = store.load(docs.filter("doc_id % 5 = 0"), {"lines": lines.filter("pos > 0")}, {"lines": {"short": F.col("line") == ""}}, "lines", rerun=True)
    every = first.unionByName(second).unionByName(third).select("doc_id", "version", F.concat_ws(" ", "run_status", "notes").alias("status"), "n_rows")
    now = store.table("lines").groupBy("doc_id").agg(F.lit(0).alias("version"), F.lit("now").alias("status"), F.count("*").alias("n_rows"))
    return every.unionByName(now)


def q103_hierarchy_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Different nations, customers, orders and parts below each node of five levels."""
    places = table(spark, d, "region").join(table(spark, d, "nation"), F.col("r_regionkey") == F.col("n_regionkey"), "left").join(table(spark, d, "customer"), F.col("n_nationkey") == F.col("c_nationkey"), "left")
    paths = places.join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return hierarchy.rollup(paths, ["r_regionkey", "n_nationkey", "c_custkey", "o_orderkey", "l_partkey"])


def q104_nested_export(spark: SparkSession, d: str) -> DataFrame:
    """Nations with their customers, their orders, and their lines, nested level by level."""
    rows = table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    tree = hierarchy.nested(rows, [("customers", ["c_nationkey"]), ("orders", ["c_custkey"]), ("lines", ["o_orderkey"])], ["l_linenumber", "l_returnflag"])
    lines = lambda o: F.concat(o["o_orderkey"].cast("string"), F.lit(":"), F.array_join(F.transform(o["lines"], lambda x: F.concat(x["l_linenumber"].cast("string"), x["l_returnflag"])), ""))
    flat = F.transform("customers", lambda c: F.concat(c["c_custkey"].cast("string"), F.lit("["), F.array_join(F.transform(c["orders"], lines), ","), F.lit("]")))
    return tree.select("c_nationkey", F.size("customers").cast("long").alias("n_customers"), F.sha2(F.array_join(flat, ";"), 256).alias("tree_sha256"))


def q105_shapes_as_rows(spark: SparkSession, d: str) -> DataFrame:
    """Orders and customers against shapes that are rows: too few or many values, values of a wrong type."""
    orders, customers = table(spark, d, "orders"), table(spark, d, "customer")
    order, customer = F.concat(F.lit("o"), F.col("o_orderkey").cast("string")), F.concat(F.lit("c"), F.col("c_custkey").cast("string"))
    nodes = orders.select(order.alias("subject"), F.lit("Order").alias("class")).unionByName(customers.select(customer.alias("subject"), F.lit("Customer").alias("class")))
    fact = lambda df, subject, path, value: df.select(subject.alias("subject"), F.lit(path).alias("path"), value.cast("string").alias("value"))
    facts = fact(orders, order, "status", F.when(F.col("o_orderkey") % 9 > 0, F.col("o_orderstatus")))
    facts = facts.unionByName(fact(orders, order, "date", F.when(F.col("o_orderkey") % 7 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))))
    facts = facts.unionByName(fact(customers, customer, "segment", F.col("c_mktsegment"))).unionByName(fact(orders, F.concat(F.lit("c"), F.col("o_custkey").cast("string")), "placed", order))
    lines = table(spark, d, "lineitem")
    facts = facts.unionByName(fact(lines, F.concat(F.lit("o"), F.col("l_orderkey").cast("string")), "part", F.col("l_partkey")))
    rules = [("Order", "status", 1, 1, "string"), ("Order", "date", 1, 1, "date"), ("Order", "part", 1, 5, "integer"), ("Customer", "segment", 1, 1, "boolean"), ("Customer", "placed", 1, None, None), ("Customer", "name", None, 1, None)]
    return shapes.violations(nodes, facts, spark.createDataFrame(rules, shapes.SHAPES))


def q106_resolved_ids(spark: SparkSession, d: str) -> DataFrame:
    """Orders as old ids and customers as new ones, by the parts that both name."""
    lines = table(spark, d, "lineitem").select("l_orderkey", F.col("l_partkey").alias("evidence"))
    new = table(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("new_id"), "evidence")
    return resolve.resolved(lines.select(F.col("l_orderkey").alias("old_id"), "evidence"), new)


# read models


def q107_fixed_pivot(spark: SparkSession, d: str) -> DataFrame:
    """Orders by nation and priority, columns from a catalogue that has one priority too many and lacks one."""
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).withColumn("n", F.lit(1))
    return facets.pivoted(rows, "c_nationkey", "o_orderpriority", "n", ["1-URGENT", "2-HIGH", "0-NONE", "3-MEDIUM", "5-LOW"])


def q108_polymorphic_links(spark: SparkSession, d: str) -> DataFrame:
    """Links to parts, suppliers and nations by kind and key, labelled by one join."""
    lines = table(spark, d, "lineitem")
    kind = F.element_at(F.array(F.lit("part"), F.lit("supplier"), F.lit("nation"), F.lit("other")), (F.col("l_linenumber") % 4 + 1).cast("int"))
    key = F.when(F.col("l_linenumber") % 4 == 0, F.col("l_partkey")).when(F.col("l_linenumber") % 4 == 1, F.col("l_suppkey")).otherwise(F.col("l_suppkey") % 30)
    of = {"part": ("p_partkey", "p_name"), "supplier": ("s_suppkey", "s_name"), "nation": ("n_nationkey", "n_name")}
    dims = {n: table(spark, d, n).select(F.col(k).alias("key"), F.col(v).alias("label")) for n, (k, v) in of.items()}
    return lens.polymorphic(lines.select("l_orderkey", "l_linenumber", kind.alias("kind"), key.alias("key")), dims)


def q109_drill_down(spark: SparkSession, d: str) -> DataFrame:
    """Customers down to the nations of their suppliers by six left joins: a row for each path."""
    steps = [("orders", "c_custkey", "o_custkey"), ("lineitem", "o_orderkey", "l_orderkey"), ("part", "l_partkey", "p_partkey"), ("supplier", "l_suppkey", "s_suppkey"), ("nation", "s_nationkey", "n_nationkey"), ("region", "n_regionkey", "r_regionkey")]
    out = lens.drill_down(table(spark, d, "customer"), [(table(spark, d, t), [(a, b)]) for t, a, b in steps])
    return out.select("c_custkey", "o_orderkey", "l_linenumber", "p_name", "s_name", "n_name", "r_name")


def q110_collated_labels(spark: SparkSession, d: str) -> DataFrame:
    """Words of the conversations by role in a locale's order."""
    words = table(spark, d, "conversations").select("role", F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("word"))
    return facets.collated(words, "role", "word")


def q111_observed_write(spark: SparkSession, d: str) -> DataFrame:
    """A stored table replaced, with counts and sums of what was there and of what was written, taken as it was written."""
    path = _folder(spark)
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    rows.filter("o_orderstatus <> 'P'").write.parquet(path)
    metrics = {"n": F.count("*"), "n_open": F.count_if(F.col("o_orderstatus") == "O"), "largest": F.max("o_totalprice")}
    before, after = sinks.replaced_with(spark, rows.filter("o_orderkey % 4 > 0"), path, metrics)
    stored = spark.read.parquet(path).agg(*(c.alias(n) for n, c in metrics.items())).first().asDict()
    return spark.createDataFrame([(k, *(float(x[m]) for m in metrics)) for k, x in (("before", before), ("after", after), ("stored", stored))], "state string, n double, n_open double, largest double")


# sections


def q112_section_cleanup(spark: SparkSession, d: str) -> DataFrame:
    """Each document as a section of line blocks, cleaned; words that fit the test text."""
    words = sections.Words(main_heading="(?i)the|les|der|los", label="(?i)^licensed.*$")
    block = lambda x: F.struct(pagetext.unit_type(x).alias("block_type"), x.alias("text"), F.lit(1).cast("long").alias("lines"), F.lit(1).cast("long").alias("merged"), F.expr("cast(array() as array<string>)").alias("actions"))
    docs = table(spark, d, "documents").select("doc_id", F.transform(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""), block).alias("blocks"))
    rows = docs.select("doc_id", F.posexplode(sections.cleaned(F.col("blocks"), words)).alias("pos", "b"))
    return rows.select("doc_id", "pos", "b.block_type", "b.merged", F.array_join("b.actions", "|").alias("actions"), F.sha2("b.text", 256).alias("text_sha256"))


def q113_structured_units(spark: SparkSession, d: str) -> DataFrame:
    """The sentences of each page's text, every seventh made a note, every fifth a citation, as units."""
    words = F.filter(F.split(F.regexp_replace("html", "<[^>]*>", " "), r"(?<=[.])\s"), lambda x: F.trim(x) != "")
    marked = F.transform(words, lambda x, i: F.when(i % 7 == 3, F.concat(F.lit("※ "), F.trim(x))).when(i % 5 == 4, F.lit("(’24 note)")).otherwise(F.concat(F.lit(" "), x)))
    rows = table(spark, d, "pages").select("page_id", F.posexplode(sections.structured_units(marked)).alias("pos", "u"))
    return rows.select("page_id", "pos", "u.lines", F.sha2("u.text", 256).alias("text_sha256"))

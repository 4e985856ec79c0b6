"""Triples, closures and shape checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def iri(base: str, kind: str, key: Column) -> Column:
    """base/resource/kind/percent-encoded key; a slash, a tilde and an asterisk's code as RFC 3986 has them."""
    encoded = F.url_encode(key.cast("string"))
    for old, new in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        encoded = F.replace(encoded, F.lit(old), F.lit(new))
    return F.concat(F.lit(f"{base}/resource/{kind}/"), encoded)


def literal(text: Column) -> Column:
    """A quoted literal with backslashes, quotes and line ends escaped."""
    out = text
    for sign, name in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(sign), F.lit(name))
    return F.concat(F.lit('"'), out, F.lit('"'))


def term(value: Column) -> Column:
    """An IRI in angle brackets, anything else as a literal."""
    return F.when(value.rlike("^https?://"), F.concat(F.lit("<"), value, F.lit(">"))).otherwise(literal(value))


def turtle(facts: DataFrame, prefix: str) -> DataFrame:
    """(subject, block): each subject's facts as one Turtle block, predicates and objects in order, repeated objects once."""
    facts = facts.select("subject", "predicate", term(F.col("object")).alias("o")).distinct()
    lists = facts.groupBy("subject", "predicate").agg(F.array_join(F.array_sort(F.collect_list("o")), ", ").alias("objects"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("predicate", "objects"))), lambda x: F.concat(F.lit(f"  {prefix}:"), x["predicate"], F.lit(" "), x["objects"]))
    return lists.groupBy("subject").agg(F.concat(F.lit("<"), F.first("subject"), F.lit(">\n"), F.array_join(lines, " ;\n"), F.lit(" .")).alias("block"))


def json_ld(df: DataFrame, kind: str, subject: Column, properties: dict[str, Column]) -> DataFrame:
    """(subject, node): a JSON-LD node a row; null properties are left out."""
    node = F.to_json(F.struct(subject.alias("@id"), F.lit(kind).alias("@type"), *(v.alias(k) for k, v in properties.items())))
    return df.select(subject.alias("subject"), node.alias("node"))


def adjacency(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(a, neighbours): the sorted distinct neighbours of each node."""
    return edges.groupBy(a).agg(F.array_sort(F.collect_set(b)).alias("neighbours"))


def triples(df: DataFrame, subject: Column, objects: dict[str, Column]) -> DataFrame:
    """(subject, predicate, object) in one pass; null objects give none."""
    parts = F.array(*(F.struct(F.lit(p).alias("predicate"), o.cast("string").alias("object")) for p, o in objects.items()))
    return df.select(subject.alias("subject"), F.explode(parts).alias("t")).select("subject", "t.*").filter("object is not null")


def closure(start: DataFrame, steps: list[tuple[str, DataFrame, str, str]]) -> dict[str, DataFrame]:
    """The nodes reached from ``start`` step by step; a step is (name, table, parent key, own key)."""
    out, at = {}, start
    for name, table, parent, own in steps:
        key = at.columns[0]
        at = table.join(at.withColumnRenamed(key, parent), parent, "left_semi").select(own)
        out[name] = at
    return out


def datatype_violations(facts: DataFrame, path: str, pattern: str) -> DataFrame:
    """(subject, path, object): values of a path that don't have the form of its datatype."""
    return facts.filter((F.col("predicate") == path) & ~F.col("object").rlike(pattern)).select("subject", F.lit(path).alias("path"), "object")


def shape_violations(subjects: DataFrame, facts: DataFrame, path: str, least: int, most: int) -> DataFrame:
    """(subject, path, n) of the subjects with too few or too many values."""
    n = facts.filter(F.col("predicate") == path).groupBy("subject").agg(F.count("*").alias("n"))
    found = subjects.join(n, "subject", "left").select("subject", F.lit(path).alias("path"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    return found.filter((F.col("n") < least) | (F.col("n") > most))

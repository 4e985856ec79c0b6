"""Shapes of a graph's nodes as rows: how many values a path has, and of what kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHAPES = "class string, path string, min_count int, max_count int, datatype string"
#: The data types of a shape by the SQL type that their values can be cast to; string takes all.
DATATYPES = {"integer": "decimal(38,0)", "decimal": "decimal(38,18)", "double": "double", "boolean": "boolean", "date": "date", "dateTime": "timestamp"}
#: Facts, or wanted values, that a task holds on average.
ROWS = 500_000


def fits(value: Column, datatype: Column) -> Column:
    """Whether a text is a value of the data type; of an unknown or no type it is."""
    out = F.lit(True)
    for name, kind in DATATYPES.items():
        cast = value.try_cast(kind).isNotNull()
        if name == "integer":
            cast = cast & value.rlike(r"^\s*[+-]?\d+\s*$")
        out = F.when(datatype == name, cast).otherwise(out)
    return out


def violations(nodes: DataFrame, facts: DataFrame, shapes: DataFrame) -> DataFrame:
    """(subject, class, path, rule, found): rules that nodes break, all shapes in one aggregation over the facts.

    ``nodes``: subject and class; ``facts``: subject, path and value as text;
    ``shapes``: rows of ``SHAPES``.  ``found``: the number of values, or of
    those of a wrong type.  A fact that is stated twice counts once.

    Shapes are a schema and are broadcast: a class, a path and a type have few
    values, and a join dealt by one of them would hold all nodes of a class or
    all facts of a path in one task.  The number of tasks follows the number of
    facts and wanted values, so what a task holds doesn't grow with them; the
    values of one subject and path are spread before they are counted.
    """
    shapes = F.broadcast(shapes)
    rows = max(facts.count(), nodes.join(shapes, "class").count())
    tasks = max(rows // ROWS + 1, int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    wanted = nodes.select("subject", "class").repartition(tasks, "subject", "class").distinct().join(shapes, "class").repartition(tasks, "subject", "path")
    # a path may have several types in several classes: wrong values are counted by type
    kinds = [r["datatype"] for r in shapes.filter(F.col("datatype").isin(list(DATATYPES))).select("datatype").distinct().collect()]
    asked = F.broadcast(shapes.groupBy("path").agg(F.collect_set("datatype").alias("types")))
    wrong = {k: F.array_contains("types", k) & ~fits(F.col("value"), F.lit(k)) for k in kinds}
    stated = facts.select("subject", "path", "value", F.pmod(F.hash("value"), F.lit(tasks)).alias("part")).filter("value is not null")
    stated = stated.repartition(tasks, "subject", "path", "part").distinct().join(asked, "path")
    per = stated.groupBy("subject", "path", "part").agg(F.count("*").alias("n"), *(F.count_if(w).alias(f"n_{k}") for k, w in wrong.items()))
    per = per.drop("part").repartition(tasks, "subject", "path").groupBy("subject", "path").agg(*(F.sum(c).alias(c) for c in ["n", *(f"n_{k}" for k in kinds)]))
    rows = wanted.join(per, ["subject", "path"], "left")
    n, n_wrong = F.coalesce("n", F.lit(0)), F.coalesce(*(F.when(F.col("datatype") == k, F.col(f"n_{k}")) for k in kinds), F.lit(0))
    broken = F.array(
        F.struct(F.lit("minCount").alias("rule"), n.alias("found"), (n < F.col("min_count")).alias("bad")),
        F.struct(F.lit("maxCount").alias("rule"), n.alias("found"), (n > F.col("max_count")).alias("bad")),
        F.struct(F.lit("datatype").alias("rule"), n_wrong.alias("found"), (n_wrong > 0).alias("bad")),
    )
    return rows.select("subject", "class", "path", F.explode(F.filter(broken, lambda b: F.coalesce(b["bad"], F.lit(False)))).alias("b")).select("subject", "class", "path", "b.rule", "b.found")

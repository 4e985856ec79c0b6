"""Counts over, and nesting of, rows that name a path of ids from the top level down."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rollup(rows: DataFrame, levels: list[str]) -> DataFrame:
    """For the whole and each node of each level but the last: how many different ids of each deeper level lie below it, exactly.

    (level, levels[:-1]..., n_<level>...): level 0 is the whole; columns that
    don't name the node are null, as are the counts of its own and higher
    levels.  A null id isn't there, and neither is what hangs below it.  An id
    may lie below several nodes, and each counts it once.

    Step by step: the ids of a level are made distinct below their parents,
    then below the next nodes up, so each step reads what the last one left and
    the whole, which holds all ids, is no hot group.
    """
    # a path ends before its first null
    paths = rows.select(*(F.when(reduce(and_, (F.col(c).isNotNull() for c in levels[: k + 1])), F.col(name)).alias(name) for k, name in enumerate(levels)), F.lit(1).cast("long").alias("_m"))
    # the rows behind each are carried along: without use of them Spark would take every step from the first rows again
    distinct = lambda df, *by: df.groupBy(*by).agg(F.sum("_m").alias("_m"))
    upper = levels[:-1]
    counted = []
    for below in range(len(levels) - 1, -1, -1):
        at = paths = distinct(paths, *levels[: below + 1])
        for up in range(below, -1, -1):
            at = at if up == below else distinct(at, *levels[:up], levels[below])
            node = [(F.col(c) if k < up else F.lit(None).cast(rows.schema[c].dataType)).alias(c) for k, c in enumerate(upper)]
            n = F.count(F.when(F.col("_m") > 0, F.col(levels[below]))).alias("_n")
            is_there = F.col(levels[up - 1]).isNotNull() if up else F.lit(True)
            counted.append(at.groupBy(*levels[:up]).agg(n, F.count("*").alias("_k")).select(F.lit(up).alias("level"), *node, F.lit(below).alias("_below"), "_n", ((F.col("_k") > 0) & is_there).alias("_is")))
    of = lambda k: F.coalesce(F.sum(F.when(F.col("_below") == k, F.col("_n"))), F.lit(0))
    counts = [F.when(F.col("level") <= k, of(k)).alias(f"n_{c}") for k, c in enumerate(levels)]
    out = reduce(DataFrame.unionByName, counted).groupBy("level", *upper).agg(*counts, F.bool_or("_is").alias("_is"))
    return out.filter("_is").drop("_is")


def nested(rows: DataFrame, levels: list[tuple[str, list[str]]], leaf: list[str]) -> DataFrame:
    """Rows nested level by level, from the deepest up: no row holds more than its own children, and no step more than one level.

    ``levels``: a list's name with the columns that tell its elements apart, by
    which they are sorted; ``leaf``: the columns of the innermost elements.
    The first level's rows are the result's.  Null children aren't listed.
    """
    at = rows
    inner: list[str] = leaf
    for k in range(len(levels) - 1, -1, -1):
        upper = [c for _, cols in levels[: k + 1] for c in cols]
        child = F.struct(*inner)
        real = F.col(inner[0]).isNotNull()
        listed = F.array_sort(F.collect_list(F.when(real, child)))
        name = levels[k][0]
        at = at.groupBy(*upper).agg(listed.alias(name))
        inner = [*levels[k][1], name]
    return at.select(*levels[0][1], levels[0][0])

"""Connected components of a large graph, without bringing links or labels to the driver.

Alternating large-star and small-star steps: each links the neighbours of a
vertex to its smallest one, the larger or the smaller neighbours in turn, until
every component is a star around its smallest vertex.  The number of rounds
grows with the logarithm of the graph's size; stars and chains of copies take
two or three.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import materialise

ROUNDS = 100


def _large_star(edges: DataFrame) -> DataFrame:
    """For each vertex, its larger neighbours go to the smallest of it and its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a < b")


def _small_star(edges: DataFrame) -> DataFrame:
    """For each vertex, it and its smaller neighbours go to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    near = edges.join(least, "b").select(F.col("m").alias("x"), F.col("a").alias("y"))
    return near.unionByName(least.select(F.col("m").alias("x"), F.col("b").alias("y"))).filter("x < y").select(F.col("x").alias("a"), F.col("y").alias("b"))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every vertex of an undirected graph that isn't the smallest of its component.

    Loops and repeated edges do no harm; an edge with a null end is left out;
    no edges give an empty table.
    """
    pairs = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a < b").distinct()
    edges = materialise(pairs)
    mark = _mark(edges)
    for _ in range(ROUNDS):
        if not mark[0]:
            break
        edges = materialise(_small_star(_large_star(edges).distinct()).distinct())
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("connected components didn't settle")
    return edges.select(F.col("b").alias("id"), F.col("a").alias("component"))

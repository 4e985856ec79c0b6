"""Ranks, quotas and top lists with total orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Stretches of the leading sort column that are numbered on their own.
STRETCHES = 64


def ranked(df: DataFrame, lead: str, order: list[Column], by: list[str] | None = None, name: str = "rank", stretches: int = STRETCHES) -> DataFrame:
    """Number rows from 1 in the order of ``order``, whose first key is the numeric column ``lead`` ascending.

    No task numbers a whole table: ``lead`` is cut at approximate quantiles
    (so many numbers come to the driver, whatever the table's size), each
    stretch is numbered on its own, and the sizes of earlier stretches are
    added.  Rows of equal ``lead`` share a stretch.
    """
    by = by or []
    cuts = sorted(set(df.approxQuantile(lead, [i / stretches for i in range(1, stretches)], 0.001))) if stretches > 1 else []
    part = F.lit(0)
    for c in cuts:
        part = part + F.when(F.col(lead) > c, 1).otherwise(0)
    rows = df.withColumn("__part", part)
    sizes = rows.groupBy(*by, "__part").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*(by or [F.lit(1)])).orderBy("__part")  # at most ``stretches`` rows a partition
    offsets = sizes.select(*by, "__part", (F.sum("__n").over(before) - F.col("__n")).alias("__before"))
    place = F.row_number().over(Window.partitionBy(*by, "__part").orderBy(*order))
    return rows.withColumn("__place", place).join(offsets, [*by, "__part"]).withColumn(name, (F.col("__place") + F.col("__before")).cast("long")).drop("__part", "__place", "__before")


def within_margin(scores: DataFrame, key: str, floor: int = 4, margin: int = 2, most: int = 2) -> DataFrame:
    """Per key the scores of at least max(floor, top - margin), the first ``most`` by score, then display order."""
    top = F.max("score").over(Window.partitionBy(key))
    order = Window.partitionBy(key).orderBy(F.desc("score"), "display_order")
    return (
        scores.withColumn("__top", top)
        .filter(F.col("score") >= F.greatest(F.lit(floor), F.col("__top") - margin))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= most)
        .drop("__top")
    )


def diverse_top(df: DataFrame, by: str, pair: list[str], order: list[Column], n: int) -> DataFrame:
    """The top ``n`` of each ``by``: the first of every pair before any second one."""
    first = F.row_number().over(Window.partitionBy(by, *pair).orderBy(*order)) > 1
    place = F.row_number().over(Window.partitionBy(by).orderBy("__later", *order))
    return df.withColumn("__later", first).withColumn("place", place).filter(F.col("place") <= n).drop("__later")


def quota(df: DataFrame, domain: str, order: list[Column], seq: str, per_domain: int, domains: int) -> DataFrame:
    """The first ``per_domain`` rows of each of the first ``domains`` domains in order of arrival."""
    arrival = df.groupBy(domain).agg(F.min(seq).alias("__first")).orderBy("__first", domain).limit(domains)
    place = F.row_number().over(Window.partitionBy(domain).orderBy(*order))
    return df.join(arrival, domain, "left_semi").withColumn("place", place).filter(F.col("place") <= per_domain)


def most_common(df: DataFrame, by: str, value: str, seq: str, k: int) -> DataFrame:
    """Per ``by`` the ``k`` most frequent values; the one seen first among equals."""
    counts = df.groupBy(by, value).agg(F.count("*").alias("n"), F.min(seq).alias("__seen"))
    place = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("n"), "__seen", value))
    return counts.withColumn("place", place).filter(F.col("place") <= k).drop("__seen")

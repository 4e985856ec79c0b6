"""Integrity checks as one table of findings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finding(rows: DataFrame, level: str, code: str) -> DataFrame:
    """(level, code, n): how many rows break a rule."""
    return rows.agg(F.count("*").alias("n")).select(F.lit(level).alias("level"), F.lit(code).alias("code"), "n")


def findings(df: DataFrame, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """(level, code, n) of several rules over one table, in one scan; a rule holds for the rows that break it."""
    one = df.agg(*(F.count_if(broken).alias(f"n{i}") for i, (_, _, broken) in enumerate(rules)))
    rows = F.array(*(F.struct(F.lit(level).alias("level"), F.lit(code).alias("code"), F.col(f"n{i}").alias("n")) for i, (level, code, _) in enumerate(rules)))
    return one.select(F.explode(rows).alias("f")).select("f.*")


def cardinality(df: DataFrame, expected: int, level: str, code: str) -> DataFrame:
    """A finding of how many rows a table has too many or too few."""
    return df.agg(F.abs(F.count("*") - expected).cast("long").alias("n")).select(F.lit(level).alias("level"), F.lit(code).alias("code"), "n")


def group_cardinality(df: DataFrame, by: str, of: str, expected: int, level: str, code: str) -> DataFrame:
    """A finding of the groups that don't have the expected number of values; groups without any count too."""
    return finding(df.groupBy(by).agg(F.count(of).alias("n")).filter(F.col("n") != expected), level, code)


def coverage(df: DataFrame, covered: Column, least: float, level: str, code: str) -> DataFrame:
    """A finding of one if fewer than ``least`` of the rows are covered, with the ratio to four digits (0 of no rows)."""
    ratio = F.when(F.count("*") > 0, F.round(F.count_if(covered) / F.count("*"), 4)).otherwise(0.0)
    return df.agg(ratio.alias("r")).select(F.lit(level).alias("level"), F.lit(code).alias("code"), (F.col("r") < least).cast("long").alias("n"), F.col("r").alias("ratio"))


def row_errors(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, code): each row with each rule of a contract that it breaks; a rule that gives null is broken."""
    codes = F.filter(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(code)) for code, ok in rules.items())), lambda c: c.isNotNull())
    return df.select(key, F.explode(codes).alias("code"))


def same_lists(expected: DataFrame, actual: DataFrame, key: str, item: str, order: str) -> DataFrame:
    """Keys whose ordered lists of items differ, or that only one side has."""

    def listed(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, item))), lambda x: x[item]).alias(name))

    both = listed(expected, "a").join(listed(actual, "b"), key, "full_outer")
    return both.filter(~F.col("a").eqNullSafe(F.col("b"))).select(key)


def report(findings: list[DataFrame]) -> DataFrame:
    """All findings, and the status that they give: fail where an error has rows, warn, or pass."""
    every = reduce(DataFrame.unionByName, findings)
    return every.withColumn("status", F.when(F.col("n") == 0, "pass").when(F.col("level") == "error", "fail").otherwise("warn"))

"""Blocks of pages: normalised lines, block types, boxes and their overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalised_line(line: Column) -> Column:
    """No-break spaces as spaces, the private-use bullet as a dash, runs of blanks as one."""
    plain = F.replace(F.replace(line, F.lit("\u00a0"), F.lit(" ")), F.lit("\uf000"), F.lit("- "))
    return F.trim(F.regexp_replace(plain, r"[ \t]+", " "))


def is_table_line(line: Column) -> Column:
    return line.startswith("|") & line.rlike(r"^[^|]*\|[^|]*\|")


def is_footer(line: Column) -> Column:
    """A page number between dashes."""
    return line.rlike(r"^- ?[0-9]+ ?-$")


def ordered_lines(df: DataFrame, id_col: str, text_col: str, block_order: int = 1) -> DataFrame:
    """(id, line_order, line, is_table, is_footer): a block's lines that aren't empty, numbered below the block's order."""
    lines = F.filter(F.transform(F.split(text_col, "\n"), normalised_line), lambda x: x != "")
    rows = df.select(id_col, F.posexplode(lines).alias("i", "line"))
    return rows.select(
        id_col,
        (F.lit(block_order * 100) + F.col("i")).cast("long").alias("line_order"),
        "line",
        is_table_line(F.col("line")).alias("is_table"),
        is_footer(F.col("line")).alias("is_footer"),
    )


def block_type(tag: Column, text: Column) -> Column:
    """The first rule that fits: heading, citation, note, bullet, else paragraph."""
    return (
        F.when((tag == "h1") | (F.char_length(text) <= 12), "heading")
        .when(text.rlike(r"^\[[0-9]+\]"), "citation")
        .when(F.lower(text).startswith("note") | text.startswith("*"), "note")
        .when((tag == "li") | text.rlike(r"^[-•]"), "bullet")
        .otherwise("paragraph")
    )


def html_blocks(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(id, pos, text, block_type) of the h1, li and p elements, in order from 1."""
    found = F.regexp_extract_all(F.col(html_col), F.lit(r"<(?:h1|li|p)(?: [^>]*)?>[^<]*"), F.lit(0))
    rows = df.select(id_col, F.posexplode(found).alias("p", "element"))
    text = F.trim(F.regexp_replace("element", r"^<[^>]*>", ""))
    rows = rows.select(id_col, (F.col("p") + 1).cast("long").alias("pos"), text.alias("text"), F.regexp_extract("element", r"^<([a-z0-9]+)", 1).alias("tag"))
    return rows.withColumn("block_type", block_type(F.col("tag"), F.col("text"))).drop("tag")


def box_union(df: DataFrame, key: str) -> DataFrame:
    """(key, x0, y0, x1, y1): the box around all boxes of a key."""
    return df.groupBy(key).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def covered_share(a: str, b: str) -> Column:
    """The part of box ``a`` that box ``b`` covers; an area counts as 1 at least."""

    def c(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    wide = F.greatest(F.least(c(a, "x1"), c(b, "x1")) - F.greatest(c(a, "x0"), c(b, "x0")), F.lit(0.0))
    high = F.greatest(F.least(c(a, "y1"), c(b, "y1")) - F.greatest(c(a, "y0"), c(b, "y0")), F.lit(0.0))
    return wide * high / F.greatest((c(a, "x1") - c(a, "x0")) * (c(a, "y1") - c(a, "y0")), F.lit(1.0))

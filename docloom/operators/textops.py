"""Line blocks of texts, their keys and their context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHORT = 25


#: A text of these characters alone is in NFKC already: ASCII, Latin letters, dashes, quotes, the euro, CJK and whole Hangul syllables.
_NORMAL = "\\x00-\\x7F\u00a1-\u00a7\u00a9\u00ab-\u00ae\u00b0\u00b1\u00b6\u00b7\u00bb\u00bf-\u0131\u0152\u0153\u2012-\u2015\u2018-\u2022\u20ac\u4e00-\u9fff\uac00-\ud7a3"


def nfkc(text: Column) -> Column:
    """The text in NFKC, by the normaliser that Spark's own collations use; only where a character may need it."""
    form = F.call_function("reflect", F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(True))
    # a text of ASCII alone has as many bytes as characters; a whole match is looked for, as it is one tight loop
    other = (F.octet_length(text) != F.char_length(text)) & ~text.rlike(rf"\A[{_NORMAL}]*\z")
    return F.when(other, form).otherwise(text)


def match_key(text: Column) -> Column:
    """NFKC in lower case without white space."""
    return F.regexp_replace(F.lower(nfkc(text)), r"(?U)\s+", "")


def short(line: Column) -> Column:
    return F.char_length(line) <= SHORT


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value made once, however often it is used, inside lambdas too."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def runs(items: Column, opens) -> Column:
    """Consecutive elements of an array as arrays: a new one begins at each element for which ``opens(element, previous)`` holds.

    The time is linear in the array.
    """

    def cut(xs: Column) -> Column:
        n = F.size(xs)
        begins = lambda x, i: (i == 0) | F.coalesce(opens(x, F.get(xs, i - 1)), F.lit(False))
        at = F.filter(F.transform(xs, lambda x, i: F.when(begins(x, i), i)), lambda i: i.isNotNull())
        return F.when(n > 0, bound(at, lambda a: F.transform(a, lambda k, j: F.slice(xs, k + 1, F.coalesce(F.get(a, j + 1), n) - k))))

    return bound(items, cut)


def _numbered(text: Column) -> Column:
    """The lines of a text as (pos, line), from 1."""
    return F.transform(F.split(text, "\n"), lambda x, i: F.struct((i + 1).cast("long").alias("pos"), x.alias("line")))


def _exploded(df: DataFrame, id_col: str, rows: Column, name: str) -> DataFrame:
    return df.select(id_col, F.explode(rows).alias(name))


def carry_heading(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, pos, line, heading): each longer line with the last short one before it.  A text's lines stay in one row: no shuffle."""
    sections = _exploded(df, id_col, runs(_numbered(F.col(text_col)), lambda x, _: short(x["line"])), "r")
    head = F.get("r", F.lit(0))["line"]
    heading = F.when(short(head), head)
    body = F.filter("r", lambda x: ~short(x["line"]))
    return sections.select(id_col, heading.alias("heading"), F.explode(body).alias("x")).select(id_col, "x.pos", "x.line", "heading")


def short_runs(df: DataFrame, least: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, first, n): runs of at least ``least`` short lines.  A text's lines stay in one row: no shuffle."""
    groups = runs(_numbered(F.col(text_col)), lambda x, p: short(x["line"]) != short(p["line"]))
    rows = _exploded(df, id_col, F.filter(groups, lambda r: short(r[0]["line"]) & (F.size(r) >= least)), "r")
    return rows.select(id_col, F.get("r", F.lit(0))["pos"].alias("first"), F.size("r").cast("long").alias("n"))


def gate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, pos, line, candidate): yes, review or no for each line, from ordered rules that look one line back.  No shuffle."""
    lines = F.split(text_col, "\n")
    pairs = F.zip_with(lines, F.concat(F.array(F.lit(None).cast("string")), lines), lambda x, p: F.struct(x.alias("line"), p.alias("before")))
    rows = df.select(id_col, F.posexplode(F.slice(pairs, F.lit(1), F.size(lines))).alias("p", "x"))
    rows = rows.select(id_col, (F.col("p") + 1).cast("long").alias("pos"), "x.line", "x.before")
    line = F.col("line")
    rules = (
        F.when(line.rlike(r"[*#%$]{3}"), "no")
        .when(F.lower(line).contains("licen"), "review")
        .when(F.char_length(line) < 10, "review")
        .when(short(line) & short(F.coalesce(F.col("before"), F.lit(""))), "no")
        .otherwise("yes")
    )
    return rows.withColumn("candidate", rules).drop("before")

"""Column rules: filled values, flags, ordered rules, choices, filters, sort keys and picks from arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL = "all"
#: A row limit of at least so many rows means no limit; a sort key for what isn't a number.
UNLIMITED, NO_NUMBER = 9_999, 1_000_000_000


def text_of(column: Column | str) -> Column:
    """The value as text, a null as the empty text."""
    return F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"), F.lit(""))


def first_filled(*columns: Column | str) -> Column:
    """The first value that is neither null nor empty; the empty text if there is none."""
    return F.coalesce(*(F.nullif(text_of(c), F.lit("")) for c in columns), F.lit(""))


def is_set(flag: Column) -> Column:
    """An integer flag as a boolean; null stays null."""
    return flag.cast("boolean")


def by_rules(rules: list[tuple[Column, str]], default: str | None) -> Column:
    """The value of the first rule that holds; a rule that gives null doesn't hold."""
    out = F.lit(default)
    for holds, value in reversed(rules):
        out = F.when(F.coalesce(holds, F.lit(False)), F.lit(value)).otherwise(out)
    return out


def looked_up(column: Column, table: dict, default) -> Column:
    """The constant that a value stands for, else ``default``."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), column), F.lit(default))


def valid_choice(value: str | None, allowed: list[str]) -> str:
    """A filter's value; what isn't among the allowed ones means ``all``."""
    return value if value in allowed else ALL


def matches_search(search_text: Column, query: str | None) -> Column:
    """Whether a text that is in lower case holds the trimmed query; an empty query matches all."""
    q = (query or "").strip().lower()
    return F.contains(search_text, F.lit(q)) if q else F.lit(True)


def has_term(terms: Column, wanted: str) -> Column:
    """Whether an array holds a term; ``all`` matches every row."""
    return F.lit(True) if wanted == ALL else F.coalesce(F.array_contains(terms, wanted), F.lit(False))


def mapping_state(terms: Column, state: str) -> Column:
    """all, mapped (some term) or unmapped (none); anything else is all."""
    n = F.coalesce(F.size(terms), F.lit(0))
    return {"mapped": n > 0, "unmapped": n <= 0}.get(state, F.lit(True))


def has_override(status: Column, *editable: Column | str) -> Column:
    """Whether a person has touched a row: its status isn't pending, or an editable field isn't blank."""
    touched = F.coalesce(F.nullif(F.trim(status), F.lit("")), F.lit("pending")) != "pending"
    for c in editable:
        touched = touched | (F.trim(text_of(c)) != "")
    return touched


def review_tasks(df: DataFrame, fields: list[str], status: str | None = "pending", domain: str | None = None, policy: str | None = None, query: str | None = None) -> DataFrame:
    """The tasks of a status, domain and policy whose ``fields`` hold the query, white space and case aside."""
    for column, value in (("status", status), ("domain", domain), ("policy", policy)):
        if value:
            df = df.filter(F.col(column) == value)
    wanted = " ".join((query or "").lower().split())
    if wanted:
        joined = F.trim(F.regexp_replace(F.lower(F.concat_ws(" ", *(text_of(f) for f in fields))), r"(?U)\s+", " "))
        df = df.filter(F.contains(joined, F.lit(wanted)))
    return df


def limited(df: DataFrame, n: int) -> DataFrame:
    """At most ``n`` rows of an ordered table; 9,999 or more means all."""
    return df if n >= UNLIMITED else df.limit(n)


def number_key(column: Column) -> Column:
    """A sort key: the number that the digits make, else one behind all numbers."""
    return F.coalesce(F.when(column.rlike(r"^[0-9]+$"), F.try_to_number(column, F.lit("9" * 18)).cast("long")), F.lit(NO_NUMBER).cast("long"))


def reading_order(y: Column, x1: Column, x0: Column) -> list[Column]:
    """Sort keys of boxes in reading order: bands of 6 units (halves to even), then right edge, then left edge."""
    return [F.bround(y / 6), x1, x0]


def first_where(items: Column, holds: Callable[[Column], Column]) -> Column:
    """The first element for which a rule holds, else null."""
    return F.get(F.filter(items, holds), F.lit(0))


def preferred_asset(assets: Column, previewable: str = "previewable", figure: str = "is_figure") -> Column:
    """The first figure with a preview, else the first asset with a preview, else the first one."""
    return F.coalesce(
        first_where(assets, lambda a: a[previewable] & a[figure]),
        first_where(assets, lambda a: a[previewable]),
        F.get(assets, F.lit(0)),
    )


#: File extensions by kind of preview, and media types.
IMAGES = ["png", "jpg", "jpeg", "gif", "webp", "svg", "bmp"]
MEDIA = {
    "pdf": "application/pdf",
    "png": "image/png",
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "gif": "image/gif",
    "bmp": "image/bmp",
    "svg": "image/svg+xml",
    "webp": "image/webp",
    "csv": "text/csv",
    "json": "application/json",
    "txt": "text/plain",
    "md": "text/markdown",
    "html": "text/html",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "zip": "application/zip",
}


def extension(path: Column) -> Column:
    """A path's extension in lower case, without the part after ``::``; empty if it has none."""
    own = F.regexp_replace(F.split(text_of(path), "::")[0], r"[?#].*$", "")
    return F.lower(F.regexp_extract(own, r"\.([A-Za-z0-9]+)$", 1))


def preview_kind(path: Column) -> Column:
    """none, image, pdf or unsupported."""
    e = extension(path)
    return F.when(F.trim(text_of(path)) == "", "none").when(e.isin(IMAGES), "image").when(e == "pdf", "pdf").otherwise("unsupported")


def media_type(path: Column) -> Column:
    return looked_up(extension(path), MEDIA, "application/octet-stream")


def asset_type(path: Column) -> Column:
    """document, image, table or other, by extension."""
    e = extension(path)
    return by_rules([(e.isin(IMAGES), "image"), (e.isin("csv", "xlsx"), "table"), (e.isin("pdf", "docx", "txt", "md", "html"), "document")], "other")


def shown_number(column: Column) -> Column:
    """A whole number with thousands separated."""
    return F.format_number(column, 0)


def shown_date(column: Column) -> Column:
    """A time as year.month.day; what is no time stays as it is."""
    return F.coalesce(F.date_format(F.try_to_timestamp(column), "yyyy.MM.dd"), column)


def counted(df: DataFrame, column: str, blank: str = "pending") -> DataFrame:
    """(value, n): how often each trimmed value occurs; blanks and nulls count as ``blank``."""
    value = F.coalesce(F.nullif(F.trim(text_of(column)), F.lit("")), F.lit(blank))
    return df.groupBy(value.alias("value")).agg(F.count("*").alias("n"))


def selected(df: DataFrame, wanted: dict[str, list]) -> DataFrame:
    """Rows whose columns are among the wanted values; an empty list restricts nothing."""
    for column, values in wanted.items():
        if values:
            df = df.filter(F.col(column).isin(values))
    return df

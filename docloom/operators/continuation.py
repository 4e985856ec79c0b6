"""Blocks of a page that go on with the block before them.

What a pair of blocks looks like is a row of numbers; which of its signals are
on is read off a table of intervals; and the first decision all of whose
signals are on holds.  The block before may be merged already, so a page is
passed over in order, with its box, length and ending as state.
"""

from __future__ import annotations

from itertools import product
from math import inf, isnan

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators.folds import scanned
from docloom.operators.pagetext import CLOSERS, OPENERS, joined_lines
from docloom.operators.textops import bound, runs

KINDS = ("paragraph", "heading", "bullet", "note", "citation", "table_markdown")
_PARAGRAPH, _HEADING, _BULLET, _NOTE, _CITATION, _TABLE = range(len(KINDS))

#: Distances in points, parts of the page's width, numbers of characters.
SIGNALS = {
    "table": [("tables", 1, inf)],
    "titles": [("title_kinds", 1, 1)],
    "title_length": [("longest", 0, 80)],
    "title_gap": [("gap", -inf, 36)],
    "centred": [("off_centre", 0, 70)],
    "citation": [("citations", 1, inf)],
    "after_heading": [("kind", _HEADING, _HEADING)],
    "opens": [("next_kind", _HEADING, _NOTE)],
    "in_reach": [("gap", -inf, 40)],
    "same_line": [("drop", 0, 8)],
    "not_above": [("gap", -8, inf)],
    "closed": [("closed", 1, 1)],
    "open_end": [("open_end", 1, 1)],
    "list_end": [("list_end", 1, 1)],
    "list_gap": [("gap", -inf, 24)],
    "paragraph": [("next_kind", _PARAGRAPH, _PARAGRAPH)],
    "near": [("gap", -inf, 12)],
    "short": [("next_chars", 0, 120)],
    "indented": [("shift", 8, inf)],
    "body_gap": [("gap", -inf, 26)],
    "body": [("next_width", 0.42, inf), ("next_right", 0.60, inf)],
    "aligned": [("shift", -32, 56), ("edge", 0, 56)],
    "full": [("width", 0.65, inf), ("right", 0.78, inf)],
}
#: In this order: what must be on, what must be off, and whether the block goes on.
DECISIONS = [
    (("table",), (), False),
    (("titles", "title_length", "title_gap", "centred"), (), True),
    (("citation",), (), False),
    (("after_heading",), (), False),
    (("opens",), (), False),
    ((), ("in_reach",), False),
    (("same_line",), (), True),
    ((), ("not_above",), False),
    (("closed",), (), False),
    (("open_end",), (), True),
    (("list_end", "list_gap"), (), True),
    ((), ("paragraph",), False),
    (("near",), (), True),
    (("list_gap", "short"), (), True),
    (("indented",), (), True),
    (("body_gap", "body", "aligned"), (), True),
    (("body_gap", "body", "full"), (), True),
]
#: Numbers of a block: its kind, box, page's width, characters, and how its text begins and ends.
NUMBERS = ["kind", "x0", "y0", "x1", "y1", "page_width", "chars", "closed", "open_end", "list_end", "opener", "closer"]


def block_numbers(b: Column) -> Column:
    """The numbers of a block with block_type, text, box and page_width."""
    text = F.coalesce(b["text"], F.lit(""))
    ends = {"closed": r"[.!?:;|]$", "open_end": r"[｢(\[·]$", "list_end": r"(?:[,:→⇨]|및|등)$", "opener": rf"[{chr(92)}{chr(92).join(OPENERS)}]$", "closer": rf"^[{chr(92)}{chr(92).join(CLOSERS)}]"}
    kind = F.array_position(F.array(*map(F.lit, KINDS)), b["block_type"]) - 1
    return F.struct(
        kind.alias("kind"),
        *(b[c].cast("double").alias(c) for c in ("x0", "y0", "x1", "y1", "page_width")),
        F.char_length(text).alias("chars"),
        *(text.rlike(p).cast("int").alias(n) for n, p in ends.items()),
    )


def look(a: dict, b: dict) -> dict[str, float]:
    """What a pair of blocks looks like, the first of which may be merged already."""
    page = a["page_width"]

    def off(x: dict) -> float:
        return abs((x["x0"] + x["x1"]) / 2 - page / 2) if 0 < x["x1"] - x["x0"] < page * 0.82 else inf

    part = page if page > 0 else 1.0
    kinds = (a["kind"], b["kind"])
    return {
        "tables": kinds.count(_TABLE),
        "citations": kinds.count(_CITATION),
        "title_kinds": float(max(kinds) <= _HEADING and min(kinds) >= 0),
        "longest": max(a["chars"], b["chars"]),
        "off_centre": max(off(a), off(b)),
        "gap": b["y0"] - a["y1"],
        "drop": abs(b["y0"] - a["y0"]),
        "shift": b["x0"] - a["x0"],
        "edge": abs(b["x1"] - a["x1"]),
        "width": (a["x1"] - a["x0"]) / part,
        "right": a["x1"] / part,
        "next_width": (b["x1"] - b["x0"]) / part,
        "next_right": b["x1"] / part,
        "kind": a["kind"],
        "next_kind": b["kind"],
        "next_chars": b["chars"],
        **{k: a[k] for k in ("closed", "open_end", "list_end")},
    }


def decided(seen: dict[str, float]) -> bool:
    """Whether the second of a pair goes on, by the first decision whose signals are as it wants them."""
    on = {s for s, ways in SIGNALS.items() if any(low <= seen[f] <= high for f, low, high in ways)}
    return next((goes_on for wanted, unwanted, goes_on in DECISIONS if on.issuperset(wanted) and on.isdisjoint(unwanted)), False)


def step(state: dict | None, values: tuple) -> tuple[dict, int]:
    """The block merged so far, and 1 where the next one goes on with it."""
    b = dict(zip(NUMBERS, values, strict=True))
    if state is None or any(isnan(x[k]) for x, k in product((state, b), ("x0", "y0", "x1", "y1"))) or not decided(look(state, b)):
        return b, 0
    spaces = int(bool(state["chars"] and b["chars"]) and not state["opener"] and not b["closer"])
    last = b if b["chars"] else state
    return {
        **state,
        **{k: min(state[k], b[k]) for k in ("x0", "y0")},
        **{k: max(state[k], b[k]) for k in ("x1", "y1")},
        **{k: last[k] for k in ("closed", "open_end", "list_end", "opener")},
        "chars": state["chars"] + b["chars"] + spaces,
    }, 1


def merged_pages(pages: DataFrame, blocks: str = "blocks") -> DataFrame:
    """``pages`` with the blocks of each page, in order in one array, merged where one goes on with the one before.

    A block is a struct of block_type, text, x0, y0, x1, y1 and page_width; a
    merged one has, without the width, ``merged`` besides: of how many it is.
    A block without a box stays alone.  A page's array stays in its row.
    """
    rows = pages.withColumn("__numbers", F.transform(blocks, block_numbers))
    rows = scanned(rows, "__numbers", NUMBERS, step, "__on")
    pairs = F.zip_with(blocks, "__on", lambda b, on: F.struct(b.alias("b"), on.alias("on")))
    edge = lambda r, c: F.transform(r, lambda x: x["b"][c].cast("double"))

    def merged(r: Column) -> Column:
        return F.struct(
            joined_lines(F.transform(r, lambda x: F.coalesce(x["b"]["text"], F.lit("")))).alias("text"),
            r[0]["b"]["block_type"].alias("block_type"),
            F.size(r).cast("long").alias("merged"),
            *(F.array_min(edge(r, c)).alias(c) for c in ("x0", "y0")),
            *(F.array_max(edge(r, c)).alias(c) for c in ("x1", "y1")),
        )

    groups = runs(pairs, lambda x, _: x["on"] == 0)
    return rows.withColumn(blocks, F.transform(groups, lambda r: bound(r, merged))).drop("__numbers", "__on")


def continuations_merged(blocks: DataFrame, id_col: str = "doc_id", page_col: str = "page_no", order: str = "pos") -> DataFrame:
    """(id, page, pos, text, block_type, merged, x0, y0, x1, y1) of blocks that come as rows; a page's blocks meet in one row."""
    block = F.struct(order, "block_type", "text", "x0", "y0", "x1", "y1", "page_width")
    pages = blocks.groupBy(id_col, page_col).agg(F.array_sort(F.collect_list(block)).alias("blocks"))
    out = merged_pages(pages).select(id_col, page_col, F.posexplode("blocks").alias("__p", "b"))
    return out.select(id_col, page_col, (F.col("__p") + 1).cast("long").alias("pos"), *(F.col(f"b.{c}") for c in ("text", "block_type", "merged", "x0", "y0", "x1", "y1")))

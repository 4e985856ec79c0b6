"""Where paragraphs come from: spans of raw lines whose comparison keys make a paragraph's."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Lines that may be skipped before a span, lines beyond the expected number, the least longest span, and that of a whole-page search.
SKIP, BEYOND, LONGEST, PAGE_LONGEST = 8, 4, 8, 40


def _span(target: str, keys: list[str], starts: range, longest: int) -> tuple[int, int] | None:
    """The first span whose keys put together are the target."""
    for a in starts:
        built = ""
        for b in range(a, min(a + longest, len(keys))):
            built += keys[b]
            if len(built) > len(target) or not target.startswith(built):
                break
            if built == target:
                return a, b + 1
    return None


def align(targets: list[tuple[str, int]], keys: list[str], is_page: bool = True) -> list[tuple[int, int, str] | None]:
    """For each paragraph (key, lines that it was merged from) the span [first, last) of lines and how it was found.

    A span is sought from where the last one ended; then a single line that
    holds the paragraph or lies in it; on numbered pages then the whole page.
    """
    out: list[tuple[int, int, str] | None] = []
    at = 0
    for target, merged in targets:
        found = None
        near = range(at, min(len(keys), at + SKIP + 1))
        tries = [(near, max(merged + BEYOND, LONGEST), "")]
        if is_page:
            tries.append((range(len(keys)), max(merged + BEYOND, PAGE_LONGEST), "_page_fallback"))
        for starts, longest, note in tries if target else []:
            if span := _span(target, keys, starts, longest):
                found = (*span, ("exact_match" if span[1] - span[0] == merged else "exact_variable_span") + note)
            else:
                line = next((a for a in starts if keys[a] and (keys[a] in target or target in keys[a])), None)
                found = None if line is None else (line, line + 1, "fuzzy_single_block" + note)
            if found:
                break
        if found:
            at = found[1]
        out.append(found)
    return out


def source_map(paragraphs: DataFrame, lines: DataFrame, id_col: str = "doc_id", page_col: str = "page_no") -> DataFrame:
    """(id, page, pos, first, last, note): each paragraph's span of lines, from 0, the end exclusive; null and ``unmapped`` if none.

    ``paragraphs`` has id, page, pos, key, merged; ``lines`` id, page, line_order, key: keys
    made by ``labels.compare_key``.  A row holds one
    page of both, and a batch of rows goes to Python at once.
    """
    listed = lambda df, row, name: df.groupBy(id_col, page_col).agg(F.array_sort(F.collect_list(row)).alias(name))
    key = F.coalesce("key", F.lit("")).alias("key")
    p = listed(paragraphs, F.struct(F.col("pos").cast("long").alias("pos"), key, F.col("merged").cast("long").alias("merged")), "targets")
    x = listed(lines, F.struct("line_order", key), "keys").select(id_col, page_col, F.col("keys.key").alias("keys"))
    pages = p.join(x, [id_col, page_col], "left")
    found = T.StructType([pages.schema[id_col], pages.schema[page_col], *(T.StructField(c, T.LongType()) for c in ("pos", "first", "last")), T.StructField("note", T.StringType())])

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows, out = [], []
            for k, (targets, keys) in enumerate(zip(batch.column("targets").to_pylist(), batch.column("keys").to_pylist(), strict=True)):
                spans = align([(t["key"], t["merged"]) for t in targets], keys or [])
                out += [(t["pos"], *(f or (None, None, "unmapped"))) for t, f in zip(targets, spans, strict=True)]
                rows += [k] * len(targets)
            at = pa.array(rows, pa.int64())
            made = [pa.array(c, pa.string() if i == 3 else pa.int64()) for i, c in enumerate(zip(*out, strict=True))] if out else [pa.array([], pa.int64())] * 3 + [pa.array([], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(id_col).take(at), batch.column(page_col).take(at), *made], found.names)

    return pages.mapInArrow(run, found)


def coverage(mapped: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_paragraphs, n_mapped, n_unmapped)."""
    have = F.count_if(F.col("note") != "unmapped")
    return mapped.groupBy(id_col).agg(F.count("*").alias("n_paragraphs"), have.alias("n_mapped"), (F.count("*") - have).alias("n_unmapped"))

"""Text, table and office files as DataFrames.

Office files are archives of XML parts; they are read as binary files and
parsed in Arrow batches with the standard library, a file at a time in a task.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob names a file, in whatever file system it lies."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def csv_rows(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV file with a header, all columns as texts; a missing file has no rows.

    Quoted fields may hold commas, line ends and doubled quotes; a byte order
    mark is skipped; missing cells are empty texts; rows of empty cells go.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', schema=schema, enforceSchema=True, nullValue="\u0000").na.fill("")
    return raw.filter(" or ".join(f"trim(`{c}`) <> ''" for c in columns))


def json_rows(spark: SparkSession, path: str, element: str, key: str = "blocks") -> DataFrame:
    """The objects of a JSON file that is a list, or an object that holds the list under ``key``; ``element`` is their DDL schema."""
    if not exists(spark, path):
        return spark.createDataFrame([], element)
    text = F.col("value")
    lists = F.when(F.ltrim(text).startswith("["), F.from_json(text, f"array<struct<{element}>>")).otherwise(F.from_json(text, f"struct<{key}:array<struct<{element}>>>")[key])
    return spark.read.text(path, wholetext=True).select(F.explode(lists).alias("x")).select("x.*")


def named_rows(spark: SparkSession, glob: str, columns: list[str], pattern: str, id_col: str, known: DataFrame | None = None, of: str = "file_name") -> DataFrame:
    """CSV files of a glob with the id that ``pattern``'s first group finds in their names, or in their paths where ``of`` is ``file_path``; only known ids where they are given."""
    if not exists(spark, glob):
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in [*columns, id_col]]))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = spark.read.csv(glob, header=True, multiLine=True, quote='"', escape='"', schema=schema)
    rows = rows.select(*columns, F.regexp_extract(f"_metadata.{of}", pattern, 1).alias(id_col))
    return rows if known is None else rows.join(known.select(id_col).distinct(), id_col, "left_semi")


def unpivoted(matrix: DataFrame, row: str = "row", cells: str = "cells", skip: int = 2) -> DataFrame:
    """(domain, subdomain, seq) of a sheet's rows after ``skip`` header rows: the first cell is the domain, filled others are subdomains."""
    text = lambda c: F.trim(F.coalesce(c, F.lit("")))
    rows = matrix.filter(F.col(row) > skip).select(row, text(F.get(cells, F.lit(0))).alias("domain"), F.posexplode(cells).alias("p", "c"))
    return rows.filter((F.col("p") > 0) & (text(F.col("c")) != "") & (F.col("domain") != "")).select("domain", text(F.col("c")).alias("subdomain"), (F.col(row) * 10_000 + F.col("p")).cast("long").alias("seq"))


# archives


def binary_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content)."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _parsed(files: DataFrame, schema: str, fields: list[pa.DataType], parse) -> DataFrame:
    """``parse(content)`` gives the rows of a file; an unreadable file gives none."""
    names = [x.split()[0] for x in re.split(r",(?![^<]*>)\s*", schema)]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                try:
                    rows = list(parse(content.as_py()))
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, TypeError):
                    rows = []
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(rows), pa.string()), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(fields))], ["path", *names])

    return files.select("path", "content").mapInArrow(run, f"path string, {schema}")


def zip_member(content: bytes, name: str) -> bytes:
    """A member of an archive; ``a.zip::b`` reaches into an archive within."""
    for part in name.split("::"):
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            content = z.read(part)
    return content


def zip_members(files: DataFrame) -> DataFrame:
    """(path, member, content) of all members that aren't folders."""

    def parse(content: bytes):
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for n in z.namelist():
                if not n.endswith("/"):
                    yield n, z.read(n)

    return _parsed(files, "member string, bytes binary", [pa.string(), pa.binary()], parse).withColumnRenamed("bytes", "content")


def _name(e) -> str:
    return e.tag.rpartition("}")[2]


def _attr(e, name: str) -> str | None:
    return next((v for k, v in e.attrib.items() if k.rpartition("}")[2] == name), None)


def _text(e, leaf: str, outside: tuple[str, ...] = ()) -> str:
    """The text of all ``leaf`` elements below, but for those in nested elements ``outside``."""
    out = []

    def walk(x) -> None:
        for c in x:
            if _name(c) in outside:
                continue
            if _name(c) == leaf:
                out.append(c.text or "")
            walk(c)

    walk(e)
    return "".join(out).strip()


def _padded(rows: list[list[str]]) -> list[list[str]]:
    wide = max(map(len, rows), default=0)
    return [r + [""] * (wide - len(r)) for r in rows]


_BLOCKS = "pos long, kind string, text string, cells array<array<string>>"
_BLOCK_TYPES = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.list_(pa.string()))]


def docx_blocks(files: DataFrame) -> DataFrame:
    """(path, pos, kind, text, cells): a Word file's paragraphs and tables in order; short rows are filled with empty cells."""

    def parse(content: bytes):
        body = next(e for e in ElementTree.fromstring(zip_member(content, "word/document.xml")) if _name(e) == "body")
        pos = 0
        for e in body:
            if _name(e) == "p" and (text := _text(e, "t")):
                pos += 1
                yield pos, "paragraph", text, None
            elif _name(e) == "tbl":
                rows = [[_text(c, "t") for c in r if _name(c) == "tc"] for r in e if _name(r) == "tr"]
                pos += 1
                yield pos, "table", None, _padded(rows)

    return _parsed(files, _BLOCKS, _BLOCK_TYPES, parse)


def hwpx_blocks(files: DataFrame) -> DataFrame:
    """(path, pos, kind, text, cells): paragraphs, texts in shapes, tables and pictures of a HWPX file in order.

    A paragraph's own text leaves out what lies in tables, pictures and shapes
    within it; these follow it as blocks of their own.
    """

    def blocks(e):
        for x in e:
            kind = _name(x)
            if kind == "tbl":
                yield "table", None, _padded([[_text(c, "t") for c in r if _name(c) == "tc"] for r in x.iter() if _name(r) == "tr"])
            elif kind == "pic":
                yield "picture", _attr(next((i for i in x.iter() if _name(i) == "img"), x), "binaryItemIDRef"), None
            elif kind == "rect":
                if text := _text(x, "t"):
                    yield "shape_text", text, None
            else:
                yield from blocks(x)

    def parse(content: bytes):
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            names = sorted((n for n in z.namelist() if re.fullmatch(r"Contents/section\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
            sections = [ElementTree.fromstring(z.read(n)) for n in names]
        pos = 0
        for section in sections:
            for p in (e for e in section if _name(e) == "p"):
                if text := _text(p, "t", ("tbl", "pic", "rect")):
                    pos += 1
                    yield pos, "paragraph", text, None
                for kind, text, cells in blocks(p):
                    pos += 1
                    yield pos, kind, text, cells

    return _parsed(files, _BLOCKS, _BLOCK_TYPES, parse)


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def xlsx_rows(files: DataFrame) -> DataFrame:
    """(path, sheet, row, cells, merged): each sheet as a dense matrix, rows from 1; ``merged`` has the sheet's merged ranges."""

    def parse(content: bytes):
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            names = z.namelist()
            shared = [_text(s, "t") for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
            for sheet in sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"(\d+)\.xml", n)[1])):
                root = ElementTree.fromstring(z.read(sheet))
                merged = [m.attrib["ref"] for m in root.iter() if _name(m) == "mergeCell"]
                found: dict[int, dict[int, str]] = {}
                for r in (e for e in root.iter() if _name(e) == "row"):
                    row = found.setdefault(int(r.attrib["r"]), {})
                    for c in r:
                        value = next((v.text or "" for v in c if _name(v) == "v"), _text(c, "t"))
                        row[_column(c.attrib["r"])] = shared[int(value)] if c.attrib.get("t") == "s" and value else value
                wide = max((max(r, default=-1) for r in found.values()), default=-1) + 1
                for k in range(1, max(found, default=0) + 1):
                    yield re.search(r"sheet\d+", sheet)[0], k, [found.get(k, {}).get(i, "") for i in range(wide)], merged

    return _parsed(files, "sheet string, row long, cells array<string>, merged array<string>", [pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string())], parse)


def route(formats, has_words):
    """How a document is read: text where a PDF has words, else recognition; other formats by name."""
    return F.when((formats == "pdf") & has_words, "pdf_text").when(formats == "pdf", "pdf_ocr").when(formats.isin("hwpx", "docx", "xlsx", "csv", "json"), formats).otherwise("not_runnable")


def page_or_blocks(pages: DataFrame, blocks: DataFrame, keys: list[str], least: int = 80, share: float = 0.25) -> DataFrame:
    """Pages whose text is empty or much shorter than their blocks' with the blocks' text, and why: ``text``, ``reason``."""
    other = blocks.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "block_text"))), lambda x: x["block_text"]), "\n").alias("__other"))
    own, text = F.coalesce("text", F.lit("")), F.coalesce("__other", F.lit(""))
    short = F.char_length(own) < F.greatest(F.lit(least), F.floor(F.char_length(text) * share))
    reason = F.when(text == "", None).when(F.trim(own) == "", "empty_page_text").when(short, "short_page_text")
    return pages.join(other, keys, "left").withColumn("reason", reason).withColumn("text", F.when(F.col("reason").isNotNull(), text).otherwise(own)).drop("__other")


def ocr_pages(lines: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, text, confidence): recognised lines by height, then left edge; the mean score, null where there is none."""
    rows = F.array_sort(F.collect_list(F.struct("y0", "x0", "text")))
    return lines.groupBy(*keys).agg(F.array_join(F.transform(rows, lambda x: x["text"]), "\n").alias("text"), F.avg("score").alias("confidence"))

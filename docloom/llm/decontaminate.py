"""Benchmark decontamination with one Aho-Corasick automaton.

Words are maximal runs of ASCII letters and digits and of characters beyond
ASCII, with A-Z in lower case.  Every window of ten consecutive words of an
item, or the whole of a shorter item, is a pattern of the automaton.  A
document is normalised to its words with single spaces between and scanned
once; an occurrence's place gives the words that it covers, and the words give
the characters of the original text.
"""

from __future__ import annotations


import re
from bisect import bisect_right
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import id_and_text, small_batches, texts

WINDOW = 10
#: Bytes of normalised items in one automaton, which is sent to every task; larger sets are scanned in several passes.
AUTOMATON_BYTES = 4 << 20

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
#: UTF-8 bytes: A-Z in lower case, what is in no word as a space.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: str) -> list[bytes]:
    """The normalised words, as UTF-8."""
    return text.encode().translate(_TABLE).split()


def word_offsets(text: str) -> list[tuple[int, int]]:
    """Where the words lie in the original text, in characters."""
    return [m.span() for m in _WORD.finditer(text.translate(_LOWER))]


def windows_of(text: str | None, window: int = WINDOW) -> list[str]:
    """The patterns of one item, with a space at either end."""
    words = [w.decode() for w in words_of(text or "")]
    if not words:
        return []
    return [f" {' '.join(words[i : i + window])} " for i in range(max(1, len(words) - window + 1))]


class Automaton:
    """One automaton over the windows of many items; made once a worker."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        patterns: dict[str, tuple[int, set]] = {}
        for item_id, text in items:
            for p in windows_of(text, window):
                patterns.setdefault(p, (p.count(" ") - 1, set()))[1].add(item_id)
        self.found = ahocorasick.Automaton()
        for p, (n, ids) in patterns.items():
            self.found.add_word(p, (n, frozenset(ids)))
        self.empty = not patterns
        if patterns:
            self.found.make_automaton()

    def scan(self, text: str) -> tuple[int, list[tuple[int, int]], set]:
        """The number of words, the disjoint runs [first, last) of words that are hit, and the items' ids."""
        words = words_of(text)
        if self.empty or not words:
            return len(words), [], set()
        normal = f" {b' '.join(words).decode()} "
        hits = list(self.found.iter(normal))
        if not hits:
            return len(words), [], set()
        starts, at = [], 1
        for w in words:
            starts.append(at)
            at += len(w.decode()) + 1
        ids: set = set()
        runs: list[tuple[int, int]] = []
        spans = []
        for end, (n, of) in hits:
            ids |= of
            last = bisect_right(starts, end - 1)  # the word that ends before the pattern's last space
            spans.append((last - n, last))
        for a, b in sorted(spans):
            if runs and a < runs[-1][1]:
                runs[-1] = (runs[-1][0], max(b, runs[-1][1]))
            else:
                runs.append((a, b))
        return len(words), runs, ids


def _batches(items: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list]:
    """The items in lists of a bounded size; an item of several times the bound makes a list of its own."""
    held, size = [], 0
    for row in items.select(F.col(id_col), F.col(text_col).cast("string")).toLocalIterator():
        n = len((row[1] or "").encode())
        if held and size + n > most:
            yield held
            held, size = [], 0
        held.append((row[0], row[1]))
        size += n
    yield held


_SCHEMA = "doc_id {}, text_hash long, n_words long, runs array<struct<first:long,last:long>>, item_ids array<string>, spans array<struct<start:long,end:long>>"


def _scan(docs: DataFrame, kind: str, items: list, window: int) -> DataFrame:
    """One pass of one automaton over the documents."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = None
        for batch in it:
            auto = auto or Automaton(items, window)
            n, hit, ids, spans = [], [], [], []
            for text in texts(batch):
                words, runs, of = auto.scan(text)
                where = word_offsets(text) if runs else []
                n.append(words)
                hit.append([{"first": a, "last": b} for a, b in runs])
                ids.append(sorted(map(str, of)))
                spans.append([{"start": where[a][0], "end": where[b - 1][1]} for a, b in runs])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(n, pa.int64()),
                    pa.array(hit, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                    pa.array(ids, pa.list_(pa.string())),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                ["doc_id", "text_hash", "n_words", "runs", "item_ids", "spans"],
            )

    return docs.mapInArrow(run, _SCHEMA.format(kind))


def _joined(name: str, first: str, last: str):
    """The runs or spans of several passes, with those that overlap made one."""
    step = f"""
        case when size(acc) > 0 and x.{first} < element_at(acc, -1).{last}
        then concat(slice(acc, 1, size(acc) - 1), array(named_struct('{first}', element_at(acc, -1).{first}, '{last}', greatest(element_at(acc, -1).{last}, x.{last}))))
        else concat(acc, array(x)) end"""
    return F.expr(f"aggregate(array_sort({name}), cast(array() as array<struct<{first}:long,{last}:long>>), (acc, x) -> {step})")


def contamination(
    df: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """Rows (doc_id, n_words, runs, item_ids, spans), one per row of ``df``.

    ``runs`` are the disjoint runs of hit words [first, last), ``spans`` the
    same in characters of the original text, ``item_ids`` the items with an
    occurring window, as sorted strings.  A null or empty text has no words; an
    item without words has no window; null ids stay null (a null item id is
    the string ``None``); repeated rows are each scanned, repeated items count
    once; an empty table of documents gives an empty table, an empty table of
    items no hits; other columns are ignored.

    Items of up to ``automaton_bytes`` make one automaton, which goes to every
    task, and the documents are scanned once, without a shuffle.  A larger set
    is taken in lists of that size, so that no task holds more than one such
    automaton: each list scans the documents, and the results of a row are put
    together by its id and a hash of its text.
    """
    kind = df.schema[id_col].dataType.simpleString()
    docs = id_and_text(df, id_col, text_col, F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"))
    lists = _batches(items, item_id_col, item_text_col, automaton_bytes)
    passes = [_scan(docs, kind, x, window) for x in lists]
    if len(passes) == 1:
        return passes[0].drop("text_hash")
    every = passes[0].withColumn("row", F.lit(1))
    for more in passes[1:]:
        every = every.unionByName(more.filter("size(runs) > 0").withColumn("row", F.lit(0)))
    return (
        every.groupBy("doc_id", "text_hash")
        .agg(
            F.max("n_words").alias("n_words"),
            F.array_distinct(F.flatten(F.collect_list("runs"))).alias("runs"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
            F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.sum("row").alias("rows"),
        )
        .select(
            "doc_id",
            "n_words",
            _joined("runs", "first", "last").alias("runs"),
            "item_ids",
            _joined("spans", "start", "end").alias("spans"),
            F.explode(F.expr("sequence(1L, rows)")).alias("copy"),
        )
        .drop("copy")
    )




def drop_contaminated(
    df: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, automaton_bytes: int = AUTOMATON_BYTES
) -> DataFrame:
    """The rows of ``df`` whose text holds no window of any item, with all their columns; one scan a list of items, no shuffle.

    A null or empty text holds none and stays; equal rows stay or go together;
    without items all rows stay; an empty table gives an empty table.
    """
    small_batches(df.sparkSession)
    for part in _batches(items, item_id_col, item_text_col, automaton_bytes):

        def run(it: Iterator[pa.RecordBatch], part: list = part) -> Iterator[pa.RecordBatch]:
            auto = None
            for batch in it:
                auto = auto or Automaton(part, window)
                yield batch.filter(pa.array([not auto.scan(t)[1] for t in texts(batch, text_col)], pa.bool_()))

        df = df.mapInArrow(run, df.schema)
    return df

"""Texts against a vocabulary that is a table: which terms a text holds, and points for them.

Terms and texts are match keys, without white space, so a term may begin
anywhere in a text.  The plan doesn't grow with the vocabulary, and no text is
compared with all terms: a broadcast automaton passes over each text once, and
a vocabulary that is too large for that is an index of the terms' beginnings,
in which an equi-join looks up the places where a filter of them finds one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.operators.scoring import Term, Weights, is_telling, plain_key, words_of_label

#: Characters of a term's beginning in the index: as many of these as the term has.
GRAMS = (1, 2, 4, 8, 16)
#: Terms of up to so many bytes, counting so many for each beside its key, go into an automaton.
BROADCAST_BYTES, KEY_BYTES = 32 << 20, 64
#: Texts are looked at together up to so many characters; most bits of the filter of beginnings (32 MB), and bits a beginning.
PART, MOST_BITS, KEY_BITS = 1 << 18, 1 << 28, 24

_ROWS = "label string, display_order int, kind string, key string, prior_of string"


def vocabulary_rows(spark: SparkSession, terms: list[Term], generic: frozenset[str] = frozenset(), least_word: int = 2) -> DataFrame:
    """Terms as rows (label, display_order, kind, key, prior_of): a row for each label, word of it, alias and policy alias."""
    rows = []
    for i, t in enumerate(terms, 1):
        keys = [("label", plain_key(t.label))]
        keys += [("word", w) for w in words_of_label(t.label, generic, least_word)]
        keys += [("telling" if is_telling(a) else "alias", plain_key(a)) for a in t.aliases]
        keys += [("policy", plain_key(a)) for a in t.policy_aliases]
        rows += [(t.label, i, kind, key, None) for kind, key in keys if key]
        rows.append((t.label, i, "term", None, t.prior_of))
    return spark.createDataFrame(rows, _ROWS)


def held(texts: DataFrame, id_cols: list[str], key_col: str, keys: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(id..., key): the keys, of ``keys`` (key), that each text holds; empty keys are in none.

    Keys of up to ``broadcast_bytes`` go to all executors as one automaton, and
    each text is passed over once where it stands.  Beyond, places of texts
    where a key may begin meet an index of the keys' beginnings in a shuffle.
    """
    terms, texts, small = _terms_and_texts(texts, id_cols, key_col, keys, broadcast_bytes)
    if not small:
        return _held_by_index(texts, id_cols, terms)
    return _held_by_automaton(texts, id_cols, terms).withColumn("key", F.explode("keys")).drop("keys")


def held_lists(texts: DataFrame, id_cols: list[str], key_col: str, keys: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(id..., keys): what ``held`` finds as a list a row, of the rows of texts that hold any; only an index gathers the lists in a shuffle."""
    terms, texts, small = _terms_and_texts(texts, id_cols, key_col, keys, broadcast_bytes)
    if small:
        return _held_by_automaton(texts, id_cols, terms)
    return _held_by_index(texts, id_cols, terms).groupBy(*id_cols).agg(F.collect_list("key").alias("keys"))


def _terms_and_texts(texts: DataFrame, id_cols: list[str], key_col: str, keys: DataFrame, broadcast_bytes: int) -> tuple[DataFrame, DataFrame, bool]:
    """Different keys, texts by their id, and whether the keys fit an automaton."""
    terms = keys.select(F.col("key").alias("__key")).filter("__key <> ''").distinct()
    size = terms.agg(F.coalesce(F.sum(F.octet_length("__key") + KEY_BYTES), F.lit(0)).alias("bytes")).first()["bytes"]
    return terms, texts.select(*id_cols, F.col(key_col).alias("__text")), size <= broadcast_bytes


def _held_by_automaton(texts: DataFrame, id_cols: list[str], terms: DataFrame) -> DataFrame:
    words = texts.sparkSession.sparkContext.broadcast([r["__key"] for r in terms.collect()])
    found = T.StructType([*texts.select(*id_cols).schema.fields, T.StructField("keys", T.ArrayType(T.StringType()))])

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(words.value)
        for batch in it:
            rows, hits = [], []
            for k, text in enumerate(batch.column("__text").to_pylist()):
                here = {word for _, word in automaton.iter(text)} if text and words.value else ()
                if here:
                    rows.append(k)
                    hits.append(list(here))
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in id_cols), pa.array(hits, pa.list_(pa.string()))], [*id_cols, "keys"])

    return texts.mapInArrow(run, found)


def _automaton(words: list[str]):
    """The automaton of the words; a worker process makes it once."""
    import ahocorasick

    if _made.get("words") is not words:
        automaton = ahocorasick.Automaton()
        for w in words:
            automaton.add_word(w, w)
        automaton.make_automaton()
        _made.update(words=words, automaton=automaton)
    return _made["automaton"]


_made: dict = {}


def _hashes(codes: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(size, 64-bit hashes of the ``size`` characters from each place on); sizes are powers of two, ascending."""
    h, width = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 1
    while sizes and width <= sizes[-1] and len(h):
        if width in sizes:
            x = (h + np.uint64(width)) * np.uint64(0xC2B2AE3D27D4EB4F)
            x ^= x >> np.uint64(29)
            x *= np.uint64(0x165667B19E3779F9)
            yield width, x ^ (x >> np.uint64(32))
        h = h[:-width] * np.uint64(0xFF51AFD7ED558CCD + 2 * width) + h[width:]
        width *= 2


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _probes(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of each hash in a filter of ``bits``, a power of two."""
    return h & np.uint64(bits - 1), (h >> np.uint64(32)) & np.uint64(bits - 1)


def _beginnings(grams: DataFrame) -> np.ndarray:
    """A filter of the terms' beginnings, put together by the executors: so many bytes come to the driver at most, however many terms there are."""
    bits = 1 << 20
    n = grams.count()
    while bits < MOST_BITS and bits < KEY_BITS * n:
        bits *= 2

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            found = [h for g in batch.column("__gram").to_pylist() for _, h in _hashes(_codes(g), [len(g)])]
            at = np.concatenate(_probes(np.concatenate(found), bits)) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64))], ["bit"])

    words = grams.mapInArrow(run, "bit long").groupBy(F.expr("shiftright(bit, 6)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("mask"))
    got = words.toPandas()
    out = np.zeros(bits // 64, np.uint64)
    out[got["word"].to_numpy(np.int64)] = got["mask"].to_numpy(np.int64).view(np.uint64)
    return out


def _held_by_index(texts: DataFrame, id_cols: list[str], terms: DataFrame) -> DataFrame:
    """Only places where a term's beginning stands are shuffled: executors look places up in a filter of them first, the join tells the rest."""
    n = F.char_length("__key")
    size = F.lit(1)
    for k in GRAMS[1:]:
        size = F.when(n >= k, k).otherwise(size)
    index = terms.withColumn("__size", size).withColumn("__gram", F.expr("substring(__key, 1, __size)"))
    longest = {r["__size"]: r["n"] for r in index.groupBy("__size").agg(F.max(n).alias("n")).collect()}  # a row for each of GRAMS
    sizes = sorted(longest)
    words = texts.sparkSession.sparkContext.broadcast(_beginnings(index.select("__gram").distinct()))
    found = T.StructType([*texts.select(*id_cols).schema.fields, T.StructField("__gram", T.StringType()), T.StructField("__place", T.StringType())])

    def places(part: list[str]) -> Iterator[tuple[int, str, str]]:
        """(text, beginning, what stands there), each once, of texts put together."""
        table, joined = words.value, "".join(part)
        lengths = np.array([len(t) for t in part], np.int64)
        row, ends = np.repeat(np.arange(len(part)), lengths), np.repeat(np.cumsum(lengths), lengths)
        for size, h in _hashes(_codes(joined), sizes):
            at = np.flatnonzero(np.arange(size, len(h) + size) <= ends[: len(h)])
            for b in _probes(h, len(table) * 64):
                b = b[at]
                at = at[(table[b >> np.uint64(6)] >> (b & np.uint64(63))) & np.uint64(1) == 1]
            stops = np.minimum(at + longest[size], ends[at])
            yield from {(r, joined[i : i + size], joined[i:j]): None for r, i, j in zip(row[at].tolist(), at.tolist(), stops.tolist(), strict=True)}

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            column, start = [t or "" for t in batch.column("__text").to_pylist()], 0
            while start < len(column):
                stop, chars = start, 0
                while stop < len(column) and (chars < PART or stop == start):
                    chars, stop = chars + len(column[stop]), stop + 1
                rows = list(places(column[start:stop]))
                at = pa.array([start + r for r, _, _ in rows], pa.int64())
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in id_cols), *(pa.array([x[k] for x in rows], pa.string()) for k in (1, 2))], found.names)
                start = stop

    rows = texts.mapInArrow(run, found)
    return rows.join(index.select("__gram", "__key").hint("shuffle_merge"), "__gram").filter(F.startswith("__place", "__key")).select(*id_cols, F.col("__key").alias("key")).distinct()


def scores(
    docs: DataFrame, id_col: str, rows: DataFrame, key_col: str, title_col: str | None = None, prior_col: str | None = None, weights: Weights = Weights(), title_only: bool = False, focus: bool = True
) -> DataFrame:
    """(id, label, display_order, score) for every term with points, as ``scoring.points`` gives them.

    ``rows`` is a table as ``vocabulary_rows`` makes one; ``key_col`` and
    ``title_col`` hold match keys, ``prior_col`` the domain that a row speaks for.
    """
    fields = F.array(*(F.struct(F.lit(n).alias("field"), F.col(c).alias("text")) for n, c in (("text", key_col), ("title", title_col)) if c))
    texts = docs.select(id_col, F.explode(fields).alias("f")).select(id_col, "f.field", F.coalesce("f.text", F.lit("")).alias("text"))
    words = rows.filter("key is not null").groupBy("label", "display_order", "kind", "key").agg(F.count("*").alias("n"))
    there = held(texts, [id_col, "field"], "text", words.select("key")).groupBy(id_col, "key").agg(F.bool_or(F.col("field") == "text").alias("in_text"), F.bool_or(F.col("field") == "title").alias("in_title"))
    hits = there.join(words, "key")
    n, in_text, in_title = F.col("n"), F.col("in_text"), F.col("in_title")
    alias = F.col("kind").isin("alias", "telling")
    where = in_title if title_only else in_title | in_text
    single = (
        F.when((F.col("kind") == "label") & in_text, n * weights.label)
        .when(alias & in_text, n * weights.alias + F.when((F.col("kind") == "telling") & in_title & F.lit(focus), n * weights.focus).otherwise(0))
        .when((F.col("kind") == "policy") & where, n * weights.policy)
        .otherwise(0)
    )
    n_words = F.sum(F.when((F.col("kind") == "word") & in_text, n).otherwise(0))
    points = hits.groupBy(id_col, "label", "display_order").agg(F.sum(single).alias("single"), n_words.alias("words"))
    capped = F.least("words", F.lit(weights.most_words)) if weights.most_words is not None else F.col("words")
    out = points.select(id_col, "label", "display_order", (F.col("single") + capped * weights.word).alias("points"))
    if prior_col:
        priors = rows.filter("kind = 'term' and prior_of is not null").select("label", "display_order", F.col("prior_of").alias("__prior"))
        spoken = docs.select(id_col, F.col(prior_col).alias("__prior")).join(priors, "__prior").select(id_col, "label", "display_order", F.lit(weights.prior).cast("long").alias("points"))
        out = out.unionByName(spoken)
    return out.groupBy(id_col, "label", "display_order").agg(F.sum("points").cast("int").alias("score")).filter("score > 0")

"""Personal data and information-theoretic sanitisation.

Base spans (email, ip, card, phone) are found by rule.  Their values are the
protected entities.  A term discloses an entity as far as seeing the term tells
that the entity is there: over all documents, with N documents, df(t) that hold
the term, df(e) that hold the entity and df(t, e) that hold both anywhere,

    PMI(t; e) = log2(P(e | t) / P(e)),   P(e | t) = df(t, e) / df(t),   IC(e) = log2(1 / P(e)),   P(e) = df(e) / N.

Few documents say little: one that a rare word shares with an entity seen once
may be chance.  So P(e | t) is not the ratio itself but the lower end of its
confidence interval (Wilson's, of ``CONFIDENCE`` standard deviations): 1 of 1
counts as 0.5, 1 of 10 as 0.04.  A term that stands near the entity somewhere
and whose PMI reaches ``share`` of the entity's whole information IC so is
above the disclosure threshold.  An entity that is seen once is revealed by
terms that hardly any other document has; the more often both are seen
together, the more frequent the term may be.  Each place of the term in every
document that holds the entity becomes a span of kind ``term``.  Documents
without the entity stay as they are.  Sanitising replaces base spans by their
kind and generalises or removes such terms.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import bloom_has, bloom_of, id_and_text, materialise, texts

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: Words, and characters at most, on either side of an entity that count as near it.
REACH, REACH_CHARS = 8, 160
#: The share of an entity's information that a term may not reach, and the standard deviations by which chance is allowed for.
SHARE, CONFIDENCE = 0.7, 1.0

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A run of digits that fails from its first digit fails from every later one: only run starts are tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
#: A term: any word or number, however short.
_TERM = re.compile(r"[^\W_]+")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each @ outwards: the local part has no @, so all starts left of one @ fail or match together."""
    out, pos, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > pos and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            pos = m.end()
        at = text.find("@", max(at + 1, pos))
    return out


def ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    if "+" not in text:
        return []
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_DIGITS.findall(m[0])) <= 15]


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The rule-based spans by kind, in code points, the end exclusive."""
    return {"email": emails(text), "ip": ips(text), "card": cards(text), "phone": phones(text)}


def entity_of(kind: str, value: str) -> str:
    """The protected entity of a span's text: how it is written doesn't matter."""
    return f"{kind}:{value.lower() if kind == 'email' else value if kind == 'ip' else ''.join(_DIGITS.findall(value))}"


def _free(text: str, masked: list[tuple[int, int]], lo: int = 0, hi: int | None = None) -> Iterator[tuple[str, int, int]]:
    """The terms between two places that no base span touches; ``masked`` is sorted, its ends made to grow."""
    ends = [y for _, y in masked]
    for m in _TERM.finditer(text, lo, len(text) if hi is None else hi):
        s, e = m.span()
        k = bisect_right(ends, s)
        if k == len(masked) or masked[k][0] >= e:
            yield m[0].lower(), s, e


def _masks(spans: dict[str, list[tuple[int, int]]]) -> list[tuple[int, int]]:
    """The base spans as sorted stretches that don't overlap."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(x for found in spans.values() for x in found):
        if out and s < out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


def neighbourhoods(text: str, spans: dict[str, list[tuple[int, int]]], reach: int = REACH) -> set[tuple[str, str]]:
    """The pairs of an entity and a term near it."""
    masked = _masks(spans)
    out = set()
    for kind, found in spans.items():
        for a, b in found:
            lo, hi = a, b
            least, most = max(0, a - REACH_CHARS), min(len(text), b + REACH_CHARS)
            for _ in range(reach):
                lo = _word_start(text, lo, least)
                hi = _word_end(text, hi, most)
            while 0 < lo < a and _TERM.match(text[lo]) and _TERM.match(text[lo - 1]):  # whole words only
                lo -= 1
            while b < hi < len(text) and _TERM.match(text[hi]) and _TERM.match(text[hi - 1]):
                hi += 1
            entity = entity_of(kind, text[a:b])
            out.update((entity, term) for term, _, _ in _free(text, masked, lo, hi))
    return out


def _hash(term: str) -> int:
    h = xxhash.xxh3_64_intdigest(term)
    return h - (1 << 64) if h >> 63 else h


def _word_start(text: str, at: int, least: int) -> int:
    while at > least and text[at - 1].isspace():
        at -= 1
    while at > least and not text[at - 1].isspace():
        at -= 1
    return at


def _word_end(text: str, at: int, most: int) -> int:
    while at < most and text[at].isspace():
        at += 1
    while at < most and not text[at].isspace():
        at += 1
    return at


_NEAR_SCHEMA = "array<struct<entity:string,term:string,entity_hash:long,term_hash:long>>"
_NEAR_TYPE = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string()), ("entity_hash", pa.int64()), ("term_hash", pa.int64())]))
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_PAIR_TYPE = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string())]))
_PLACE_TYPE = pa.list_(pa.struct([("term", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _entities(text: str, spans: dict[str, list[tuple[int, int]]]) -> list[str]:
    return sorted({entity_of(k, text[a:b]) for k, found in spans.items() for a, b in found})


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """Rows (doc_id, text_hash, spans, entities, near), one per row: base spans, the distinct entities, and the terms near each."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            spans, entities, near = [], [], []
            for text in texts(batch):
                found = base_spans(text)
                spans.append([{"kind": k, "start": a, "end": b} for k in KINDS for a, b in found[k]])
                entities.append(_entities(text, found))
                pairs = neighbourhoods(text, found, reach) if spans[-1] else ()
                near.append([{"entity": e, "term": t, "entity_hash": _hash(e), "term_hash": _hash(t)} for e, t in pairs])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(spans, _SPAN_TYPE), pa.array(entities, pa.list_(pa.string())), pa.array(near, _NEAR_TYPE)],
                ["doc_id", "text_hash", "spans", "entities", "near"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    return id_and_text(df, id_col, text_col, F.xxhash64(F.col(text_col).cast("string")).alias("text_hash")).mapInArrow(
        run, f"doc_id {kind}, text_hash long, spans array<struct<kind:string,start:long,end:long>>, entities array<string>, near {_NEAR_SCHEMA}"
    )


def mentions(df: DataFrame, terms: np.ndarray, pairs: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, text_hash, pairs, places) of the documents with entities.

    ``pairs`` are those of an entity and a term anywhere in its document that
    the filters ``terms`` and ``pairs`` may hold, ``places`` all of their terms'.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows, both, places = [], [], []
            for k, text in enumerate(texts(batch)):
                found = base_spans(text)
                if not any(found.values()):
                    continue
                at: dict[str, list[tuple[int, int]]] = {}
                for term, s, e in _free(text, _masks(found)):
                    at.setdefault(term, []).append((s, e))
                words = np.array(list(at), dtype=object)
                hashes = np.fromiter(map(_hash, words), np.int64, len(words))
                ok = bloom_has(terms, hashes)
                words, hashes = words[ok], hashes[ok]
                got = [{"entity": x, "term": w} for x in _entities(text, found) for w in words[bloom_has(pairs, hashes ^ _hash(x))]]
                if got:
                    rows.append(k)
                    both.append(got)
                    places.append([{"term": w, "start": s, "end": e} for w in {x["term"] for x in got} for s, e in at[w]])
            held = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(held), batch.column("text_hash").take(held), pa.array(both, _PAIR_TYPE), pa.array(places, _PLACE_TYPE)],
                ["doc_id", "text_hash", "pairs", "places"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    return id_and_text(df, id_col, text_col, F.xxhash64(F.col(text_col).cast("string")).alias("text_hash")).mapInArrow(
        run,
        f"doc_id {kind}, text_hash long, pairs array<struct<entity:string,term:string>>, places array<struct<term:string,start:long,end:long>>",
    )


def term_counts(df: DataFrame, wanted: np.ndarray, text_col: str = "text", flush: int = 200_000) -> DataFrame:
    """(term, df): over all documents, how many hold each term that the filter ``wanted`` may hold."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        known: dict[str, str] = {}

        def out() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])
            counts.clear()
            return got

        for batch in it:
            for text in texts(batch):
                found = set(_TERM.findall(text))
                if new := [w for w in found if w not in known]:
                    if len(known) > flush:
                        known.clear()
                        new = list(found)
                    low = [w.lower() for w in new]
                    ok = bloom_has(wanted, np.fromiter(map(_hash, low), np.int64, len(low)))
                    for w, x, y in zip(new, low, ok, strict=True):
                        known[w] = x if y else ""
                for term in {known[w] for w in found} - {""}:
                    counts[term] += 1
            if len(counts) > flush:
                yield out()
        if counts:
            yield out()

    return (
        df.select(F.col(text_col).cast("string").alias("text"))
        .mapInArrow(run, "term string, n long")
        .groupBy("term")
        .agg(F.sum("n").alias("df_term"))
    )


def sure_part(k: Column, n: Column, z: float = CONFIDENCE) -> Column:
    """The lower end of Wilson's interval of the ratio ``k / n``; it grows with ``k``."""
    p, zz = k / n, z * z
    return (p + zz / (2 * n) - z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n))) / (1 + zz / n)


def disclosing_terms(
    df: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE
) -> tuple[DataFrame, DataFrame]:
    """(entity, term): the pairs above the disclosure threshold; and what ``mentions`` gave, stored.  ``found``: what ``find`` gave, stored."""
    docs = float(found.count())
    near = materialise(found.select(F.explode("near").alias("x")).select("x.*").distinct())
    of_entity = materialise(found.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("df_entity")))
    of_term = term_counts(df, bloom_of(near.select("term_hash").distinct(), "term_hash"), text_col)
    # P(e | t) is to reach P(e) ** (1 - share); an entity of all documents tells nothing
    threshold = F.pow(F.col("df_entity") / docs, F.lit(1 - share))
    # neither filter loses a pair: no more documents hold both than hold either, and a frequent term can't pass with any entity
    most = of_entity.agg(F.max("df_entity")).first()[0] or 0
    of_term = of_term.filter(sure_part(F.least("df_term", F.lit(most)), F.col("df_term")) >= max(docs, 1.0) ** (share - 1))
    able = near.join(of_term, "term").join(of_entity, "entity")
    able = materialise(able.filter((F.col("df_entity") < docs) & (sure_part(F.least("df_term", "df_entity"), F.col("df_term")) >= threshold)))
    there = materialise(
        mentions(df, bloom_of(able.select("term_hash").distinct(), "term_hash"), bloom_of(able.selectExpr("entity_hash ^ term_hash as pair_hash"), "pair_hash"), id_col, text_col)
    )
    both = there.select(F.explode("pairs").alias("x")).select("x.*").groupBy("entity", "term").agg(F.count("*").alias("both"))
    return materialise(able.join(both, ["entity", "term"]).filter(sure_part(F.col("both"), F.col("df_term")) >= threshold).select("entity", "term")), there


def personal_data(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    reach: int = REACH,
    share: float = SHARE,
) -> DataFrame:
    """Rows (doc_id, text_hash, spans, terms), one per row of ``df``.

    ``spans`` are the base spans by kind as listed and start, ``terms`` the
    places of disclosing terms, sorted and distinct; all in code points of the
    text.  A null or empty text has none; null ids are kept; repeated rows each
    get their spans, and each counts as a document in the statistics, whose
    base is the whole table; an empty table gives an empty table; other
    columns are ignored.

    Three passes over the texts: one finds spans and near terms, one counts
    the documents of the terms in question, and one finds all places of those
    that can reach the threshold; the rest works on narrow rows.  Texts are
    never shuffled.
    """
    found = materialise(find(df, id_col, text_col, reach))
    pairs, there = disclosing_terms(df, found, id_col, text_col, share)
    held = (
        there.select("doc_id", "text_hash", F.explode("pairs").alias("x"))
        .select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "x.*")
        .join(pairs, ["entity", "term"])
        .select("d", "h", "term")
        .distinct()
    )
    same = F.col("doc_id").eqNullSafe(F.col("d")) & F.col("text_hash").eqNullSafe(F.col("h"))
    flagged = (
        there.select("doc_id", "text_hash", F.explode("places").alias("x"))
        .select("doc_id", "text_hash", F.col("x.term").alias("t"), "x.start", "x.end")
        .join(held, same & (F.col("t") == F.col("term")))
        .groupBy("d", "h")
        .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("terms"))
    )
    none = F.expr("cast(array() as array<struct<start:long,end:long>>)")
    return (
        found.select("doc_id", "text_hash", "spans")
        .join(flagged, same, "left")
        .select("doc_id", "text_hash", "spans", F.coalesce("terms", none).alias("terms"))
    )


def redact(text: str, spans: list[tuple[str, int, int]], generalise: bool = True) -> str:
    """The text with each span replaced: a base span by its kind in brackets, a term by ``[TERM]`` or by nothing."""
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b in spans):
        if b <= at:
            continue
        out.append(text[at : max(a, at)])
        if a >= at:
            out.append("" if kind == TERM and not generalise else f"[{kind.upper()}]")
        at = b
    out.append(text[at:])
    return "".join(out)


def sanitise(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalise: bool = True, **how) -> DataFrame:
    """``df`` with personal data replaced in its text; every other column stays as it is.

    Rows meet their spans by id and a hash of the text; null texts stay null.
    """
    found = personal_data(df, id_col, text_col, **how).filter("size(spans) > 0 or size(terms) > 0")
    every = F.expr(f"concat(spans, transform(terms, t -> named_struct('kind', '{TERM}', 'start', t.start, 'end', t.end)))")
    found = found.groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).agg(F.first(every).alias("__spans"))
    whole = df.withColumn("__text_hash", F.xxhash64(F.col(text_col).cast("string"))).join(
        found, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash")), "left"
    )

    @F.pandas_udf("string")
    def put(text, spans):
        import pandas as pd

        return pd.Series(
            [t if t is None or s is None else redact(t, [(x["kind"], int(x["start"]), int(x["end"])) for x in s], generalise) for t, s in zip(text, spans, strict=True)],
            dtype=object,
        )

    # only rows with spans go through Python
    new = F.when(F.col("__spans").isNotNull(), put(F.col(text_col), F.col("__spans"))).otherwise(F.col(text_col))
    return whole.withColumn(text_col, new).select(*df.columns)

"""How far the vocabularies of sources of one language diverge, by mergeable radix tries.

Tasks count the terms of their documents in byte tries, with a counter for each
source at the leaves, and cut them by prefix.  Prefixes with very many leaves
are cut deeper, round by round, so that no group grows with the corpus; then
the tries below each prefix are merged, and the terms that enough documents of
their language have are kept.  A walk of the merged tries in UTF-8 order gives
sums for pairs of sources and, for each source, the candidates of its telling
terms in tie order.

Sums over all kept terms for all pairs of sources don't need all terms for all
pairs: terms that one source has and the other lacks depend on nothing but the
count, so a histogram of counts for each source tells their sum; only terms
that both have are looked at pair by pair.  All arithmetic is of integers.

Null text, language and source count as empty ones; repeated rows count as
documents of their own; very long texts are split piece by piece.  An empty
table gives no rows, a source without terms has pairs but no term rows, ties go
by the bytes of the item.  Only the three columns that are read are looked up,
so names of others can't clash.
"""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import materialise, small_batches
from docloom.llm.radix import Trie, merged, of_counts

#: A task's counts become a trie when they have so many entries; it is the bound of a worker's memory.
ENTRIES = 1_000_000
#: Tries are cut at prefixes of so many bytes, and a prefix with more leaves than this, in all tries together, at one byte more.
DEPTH, LEAVES = 2, 400_000
#: Long texts are split in pieces of so many bytes, each up to a place between terms.
PIECE = 4 << 20
#: Pairs that are worked out at once, and sums or candidates that a task holds before it hands them on.
PAIRS, HELD = 1 << 20, 1 << 20
#: The shares' common denominator; counts beyond this are worked out in Python's integers, as the product wouldn't fit 64 bits.
UNIT, MOST_COUNT = 1_000_000_000, 9_000_000_000

_LETTERS = bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
#: Bytes outside terms become spaces, A-Z becomes lower case.
_TABLE = bytes((bytes([b]).lower()[0] if b in _LETTERS else 0x20) for b in range(256))

_TRIES = f"lang string, prefix binary, n long, sources array<string>, {Trie.COLUMNS}"
_KEPT = f"lang string, n_terms long, sources array<string>, {Trie.COLUMNS}, counts array<struct<source: string, count: long, n: long>>"
_FOUND = "part string, lang string, source string, item string, value long"


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """A text's terms, in lists of bounded size."""
    clean = text.translate(_TABLE)
    at = 0
    while at < len(clean):
        end = clean.find(b" ", at + PIECE) if len(clean) - at > PIECE else -1
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    names = [x.strip().split(" ")[0] for x in schema.split(", ")[: len(columns)]]
    return pa.RecordBatch.from_arrays(columns, names)


def _trie_rows(rows: list[tuple[str, bytes, list[str], Trie]]) -> pa.RecordBatch:
    packed = list(zip(*(t.packed() for *_, t in rows), strict=True))
    columns = [
        pa.array([r[0] for r in rows], pa.string()),
        pa.array([r[1] for r in rows], pa.binary()),
        pa.array([len(r[3]) for r in rows], pa.int64()),
        pa.array([r[2] for r in rows], pa.list_(pa.string())),
        *(pa.array(p, pa.binary()) for p in packed),
    ]
    return _batch(_TRIES, columns)


def _narrowed(sources: list[str], trie: Trie) -> tuple[list[str], Trie]:
    """A trie with only the sources that occur in it, coded by place."""
    used, code = np.unique(trie.code, return_inverse=True)
    trie.code = code.astype(np.int32)
    return [sources[k] for k in used.tolist()], trie


class _Counts:
    """A task's counts so far: terms by language and source, and documents that have each term by language."""

    def __init__(self) -> None:
        self.of: dict[str, dict[str, Counter]] = defaultdict(lambda: defaultdict(Counter))
        self.docs: dict[str, Counter] = defaultdict(Counter)

    def add(self, lang: str, source: str, text: bytes) -> None:
        counts, seen = self.of[lang][source], None
        for terms in terms_of(text):
            counts.update(terms)
            seen = set(terms) if seen is None else seen.union(terms)
        if seen:
            self.docs[lang].update(seen)

    def entries(self) -> int:
        return sum(map(len, self.docs.values())) + sum(len(c) for by in self.of.values() for c in by.values())

    def tries(self) -> Iterator[pa.RecordBatch]:
        """The counts as tries below each short prefix; nothing is held after."""
        rows: list = []
        for lang in sorted(self.of):
            by = self.of.pop(lang)
            sources = sorted(by)
            keys, trie = of_counts(self.docs.pop(lang, {}), [by[s] for s in sources])
            for prefix, part in trie.cut(DEPTH, keys):
                rows.append((lang, prefix, *_narrowed(sources, part)))
                if len(rows) >= 500:
                    yield _trie_rows(rows)
                    rows = []
        if rows:
            yield _trie_rows(rows)
        self.__init__()


def _counted(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = _Counts()
    for batch in it:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for lang, source, text in zip(langs, sources, batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
            held.add(lang, source, text)
        if held.entries() > ENTRIES:
            yield from held.tries()
    yield from held.tries()


def _read(batch: pa.RecordBatch) -> Iterator[tuple[dict, Trie]]:
    """The rows of a batch with their tries unpacked."""
    packed = [batch.column(n).to_pylist() for n in Trie.NAMES]
    rest = [n for n in batch.schema.names if n not in Trie.NAMES]
    others = [batch.column(n).to_pylist() for n in rest]
    for k in range(batch.num_rows):
        yield {n: c[k] for n, c in zip(rest, others, strict=True)}, Trie.unpacked(*(p[k] for p in packed))


def _deeper(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tries cut at one byte more than they were."""
    for batch in it:
        for row, trie in _read(batch):
            rows = [(row["lang"], p, *_narrowed(row["sources"], t)) for p, t in trie.cut(len(row["prefix"]) + 1)]
            for k in range(0, len(rows), 500):
                yield _trie_rows(rows[k : k + 500])


def tries(docs: DataFrame, leaves: int = LEAVES) -> DataFrame:
    """Stored tries of all documents, cut so that those below one prefix have at most ``leaves`` leaves together, unless they are all of one term.

    ``docs`` has lang, source and text without nulls.
    """
    cut = materialise(docs.mapInArrow(_counted, _TRIES))
    done: list[DataFrame] = []
    depth = DEPTH
    while True:
        key = ["lang", "prefix"]
        # a prefix shorter than the depth is a whole term: nothing is left to cut
        heavy = cut.groupBy(*key).agg(F.sum("n").alias("n")).filter((F.col("n") > leaves) & (F.length("prefix") == depth)).select(*key)
        heavy = materialise(heavy)
        if heavy.isEmpty():
            break
        done.append(cut.join(heavy, key, "left_anti"))
        cut = materialise(cut.join(heavy, key, "left_semi").mapInArrow(_deeper, _TRIES))
        depth += 1
    for part in done:
        cut = cut.unionByName(part)
    return cut


def _kept_rows(lang: str, group: list[tuple[list[str], Trie]], least: int) -> pa.RecordBatch | None:
    """The terms of a prefix that enough documents have, as one trie, with a histogram of counts for each source."""
    sources = sorted({s for names, _ in group for s in names})
    place = {s: k for k, s in enumerate(sources)}
    for names, trie in group:
        trie.code = np.array([place[s] for s in names], np.int32)[trie.code] if names else trie.code
    keys, whole = merged([t for _, t in group])
    stays = whole.docs >= least
    if not stays.any():
        return None
    mask = np.repeat(stays, whole.sizes)
    trie = Trie.of([k for k, s in zip(keys, stays.tolist(), strict=True) if s], whole.docs[stays], whole.sizes[stays], whole.code[mask], whole.count[mask])
    names, trie = _narrowed(sources, trie)
    pairs, n = np.unique(np.stack((trie.code.astype(np.int64), trie.count)), axis=1, return_counts=True)
    counts = [{"source": names[c], "count": v, "n": m} for c, v, m in zip(*pairs.tolist(), n.tolist(), strict=True)]
    columns = [pa.array([lang], pa.string()), pa.array([len(trie)], pa.int64()), pa.array([names], pa.list_(pa.string()))]
    columns += [pa.array([p], pa.binary()) for p in trie.packed()]
    columns.append(pa.array([counts], pa.list_(pa.struct([("source", pa.string()), ("count", pa.int64()), ("n", pa.int64())]))))
    return pa.RecordBatch.from_arrays(columns, ["lang", "n_terms", "sources", *Trie.NAMES, "counts"])


def kept_terms(parts: DataFrame, least: int) -> DataFrame:
    """(lang, n_terms, sources, trie, counts): for each language and prefix the terms in at least ``least`` documents; stored."""

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group = None, []
        for batch in it:
            for row, trie in _read(batch):
                if (row["lang"], row["prefix"]) != at:
                    if group and (out := _kept_rows(at[0], group, least)) is not None:
                        yield out
                    at, group = (row["lang"], row["prefix"]), []
                group.append((row["sources"], trie))
        if group and (out := _kept_rows(at[0], group, least)) is not None:
            yield out

    together = parts.repartition("lang", "prefix").sortWithinPartitions("lang", "prefix")
    return materialise(together.mapInArrow(run, _KEPT))


def shares(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(UNIT * (count + 1) / total), exactly."""
    if len(count) and int(count.max()) > MOST_COUNT:
        wide = np.broadcast_to(np.asarray(total, object), count.shape)
        return np.array([1 + UNIT * (c + 1) // t for c, t in zip(count.tolist(), wide.tolist(), strict=True)], np.int64)
    return 1 + UNIT * (count + 1) // total


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q) ** 2 / q), exactly: shares are at most UNIT + 1, so the square fits 64 bits."""
    d = p - q
    return d * d // q


class _Language:
    """A language's kept terms, and its sources with the sums of their counts and their kept terms."""

    def __init__(self, terms: int, by: list[dict]) -> None:
        self.terms, self.sources = terms, [s["source"] for s in by]
        self.place = {s: k for k, s in enumerate(self.sources)}
        n = np.array([s["n"] for s in by], np.int64)
        self.kept = np.array([s["kept"] for s in by], np.int64)
        self.totals = n + terms
        self.whole = int(n.sum()) + terms
        #: A source's share of a term that it hasn't; without terms there are no shares and nobody asks.
        self.absent = shares(np.zeros(len(by), np.int64), np.maximum(self.totals, 1))


def _pair_sums(lang: _Language, code: np.ndarray, p: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For terms that both of a pair have: what they add to the pair's sum beyond what the histograms count for them."""
    sizes = sizes.astype(np.int64)
    start = np.cumsum(sizes) - sizes
    own, of = np.repeat(sizes, sizes), np.repeat(start, sizes)
    upto = np.cumsum(own)
    a0 = 0
    while a0 < len(code):
        a1 = max(a0 + 1, int(np.searchsorted(upto, (upto[a0 - 1] if a0 else 0) + PAIRS, "right")))
        n = own[a0:a1]
        a = np.repeat(np.arange(a0, a1), n)
        b = of[a] + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        other = a != b
        a, b = a[other], b[other]
        s, t = code[a].astype(np.int64), code[b].astype(np.int64)
        ps, pt, s0, t0 = p[a], p[b], lang.absent[s], lang.absent[t]
        value = gap(ps, pt) - gap(ps, t0) - gap(s0, pt) + gap(s0, t0)
        pairs, at = np.unique(s * len(lang.sources) + t, return_inverse=True)
        sums = np.zeros(len(pairs), np.int64)
        np.add.at(sums, at, value)
        yield pairs, sums
        a0 = a1


class _Walk:
    """A task's walk: sums by pair and the best terms by source, handed on when they become many."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.pairs: dict[tuple[str, str, str], int] = defaultdict(int)
        self.best: dict[tuple[str, str], list[tuple[int, bytes]]] = defaultdict(list)
        self.n_best = 0

    def take(self, name: str, lang: _Language, sources: list[str], trie: Trie) -> None:
        code = np.array([lang.place[s] for s in sources], np.int64)[trie.code]
        keys = trie.keys()
        p = shares(trie.count, lang.totals[code])
        whole = np.add.reduceat(trie.count, np.cumsum(trie.sizes) - trie.sizes)
        q = np.repeat(shares(whole, lang.whole), trie.sizes)
        for pairs, sums in _pair_sums(lang, code, p, trie.sizes):
            n = len(lang.sources)
            for c, v in zip(pairs.tolist(), sums.tolist(), strict=True):
                self.pairs[name, lang.sources[c // n], lang.sources[c % n]] += v
        leaf = np.repeat(np.arange(len(keys)), trie.sizes)
        more = np.flatnonzero(p > q)
        value = gap(p[more], q[more])
        # by source, then the largest value, then the order of the walk
        order = np.lexsort((leaf[more], -value, code[more]))
        of = code[more][order]
        for a, b in itertools.pairwise([*np.flatnonzero(np.diff(of, prepend=-1)).tolist(), len(of)]):
            rows = order[a : min(b, a + self.most)]
            held = self.best[name, lang.sources[int(of[a])]]
            self.n_best -= len(held)
            held += [(-v, keys[k]) for v, k in zip(value[rows].tolist(), leaf[more][rows].tolist(), strict=True)]
            held.sort()
            del held[self.most :]
            self.n_best += len(held)

    def out(self, always: bool = False) -> Iterator[pa.RecordBatch]:
        if not always and len(self.pairs) + self.n_best < HELD:
            return
        rows = [("pair", *k, v) for k, v in self.pairs.items()]
        rows += [("term", *k, term.decode(), -v) for k, found in self.best.items() for v, term in found]
        self.__init__(self.most)
        yield from _found(rows)


def _found(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    types = [pa.string()] * 4 + [pa.int64()]
    for k in range(0, len(rows), 10_000):
        yield _batch(_FOUND, [pa.array(c, t) for c, t in zip(zip(*rows[k : k + 10_000], strict=True), types, strict=True)])


def _alone(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each source against every other one: what terms add that one of the two hasn't, or neither, from the source's histogram of counts."""
    for batch in it:
        for row in batch.to_pylist():
            lang = _Language(row["n_terms"], row["by"])
            s = lang.place[row["source"]]
            count, n = (np.array([c[k] for c in row["counts"]], np.int64) for k in ("count", "n"))
            p = shares(count, lang.totals[s])
            rows = []
            for t, name in enumerate(lang.sources):
                if t == s:
                    continue
                q = np.full(len(p), lang.absent[t], np.int64)
                neither = (lang.terms - int(lang.kept[s]) - int(lang.kept[t])) * int(gap(lang.absent[s], lang.absent[t])) if lang.terms else 0
                rows.append(("pair", row["lang"], row["source"], name, int((n * gap(p, q)).sum()) + neither))
                rows.append(("pair", row["lang"], name, row["source"], int((n * gap(q, p)).sum())))
            yield from _found(rows)


def audit(df: DataFrame, least: int = 3, most: int = 200, leaves: int = LEAVES) -> DataFrame:
    """(lang, source, part, item, value, rank): the divergence of each source from every other one of its language, and its most telling terms.

    ``least``: documents of the language that a kept term has; ``most``: ranks
    of telling terms.  A row of the walk carries the sums of all sources of its
    language: the result has a row for each pair of them, so these are few
    beside it.
    """
    small_batches(df.sparkSession)
    docs = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    groups = docs.select("lang", "source").distinct()
    kept = kept_terms(tries(docs, leaves), least)
    count = F.explode("counts").alias("c")
    counts = kept.select("lang", count).groupBy("lang", "c.source", "c.count").agg(F.sum("c.n").alias("n"))
    counts = counts.groupBy("lang", "source").agg(F.collect_list(F.struct("count", "n")).alias("counts"))
    none = F.expr("cast(array() as array<struct<count: bigint, n: bigint>>)")
    by_source = materialise(groups.join(counts, ["lang", "source"], "left").withColumn("counts", F.coalesce("counts", none)))
    add = "aggregate(counts, 0L, (acc, c) -> acc + {})"
    own = F.struct("source", F.expr(add.format("c.count * c.n")).alias("n"), F.expr(add.format("c.n")).alias("kept"))
    langs = by_source.groupBy("lang").agg(F.array_sort(F.collect_list(own)).alias("by"))
    terms = kept.groupBy("lang").agg(F.sum("n_terms").alias("n_terms"))
    langs = materialise(langs.join(terms, "lang", "left").withColumn("n_terms", F.coalesce("n_terms", F.lit(0))))

    def walk(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walked, known = _Walk(most), ("", None)
        for batch in it:
            for row, trie in _read(batch):
                if known[1] is None or known[0] != row["lang"]:
                    known = (row["lang"], _Language(row["terms"], row["by"]))
                walked.take(row["lang"], known[1], row["sources"], trie)
                yield from walked.out()
        yield from walked.out(always=True)

    beside = langs.select("lang", "by", F.col("n_terms").alias("terms"))
    found = materialise(kept.drop("counts", "n_terms").join(beside, "lang").mapInArrow(walk, _FOUND))
    alone = by_source.join(langs, "lang").select("lang", "source", "counts", "by", "n_terms").mapInArrow(_alone, _FOUND)
    pairs = found.filter("part = 'pair'").unionByName(alone).groupBy("part", "lang", "source", "item").agg(F.sum("value").alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    columns = ["lang", "source", "part", "item", "value"]
    best = found.filter("part = 'term'").select(*columns, place).filter(F.col("rank") <= most)
    return pairs.select(*columns, place).unionByName(best)

"""MinHash near-deduplication with SetSketch registers.

A document's word shingles are hashed; for each of ``m`` hash functions the
least value, read as an exponential variable, is kept as the power of ``BASE``
that it reaches, truncated to a range: registers that can be merged by taking
the larger, are as likely to agree as two sets are similar, and tell both
sizes.  Bands of registers retrieve candidates; from two documents' registers
and sizes the similarity is estimated by maximum likelihood; candidates that
may reach the threshold are confirmed on the full sets.

Documents of equal sets are one class.  Within a band's bucket not all pairs
are written out.  First a few pivots of each bucket are compared with all its
members, which joins the bulk of a group of near copies into one component.
Then the buckets that still hold members of different components are settled:
registers and sets of the members that weren't pivots lie side by side in a
task, where each member outside the bucket's largest component is compared with
all members of other components, by registers, then exactly; only links that
join components leave the task.  A bucket of very many members, or of very long
sets, is dealt out in pairs of blocks, so a task holds two blocks at most.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import bloom_has, bloom_of, id_and_text, materialise, small_batches, texts
from docloom.llm.components import components

#: Registers: base of the powers, rate of the exponential variables (so that small sets aren't truncated), largest value.
BASE, RATE, TOP = 1.02, 20.0, 4_000
#: Bytes of a text whose words are hashed at once, the longest word hashed with others, shingles multiplied at once.
BLOCK, LONG_WORD, CHUNK = 1 << 16, 64, 512
#: How far below the threshold an estimate rules a candidate out: over five standard deviations of 192 registers.
MARGIN = 0.15
#: Pivots of a bucket; members that a copy of a pivot meets in a join.
PIVOTS, MEETS = 4, 256
#: Members, and shingles of all members, of a block of a bucket.
BLOCK_MEMBERS, BLOCK_SHINGLES = 1_024, 1 << 20

_SPACE = np.isin(np.arange(256), [*range(9, 14), 32])
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)


@dataclass(frozen=True)
class Setting:
    """Words a shingle, least similarity in hundredths, registers a band, bands.

    A pair at the least similarity s misses all bands with probability
    (1 - s ** rows) ** bands: 3e-7 at 0.85 with 6 and 32, 3e-6 at 0.8 with 5
    and 32.
    """

    width: int = 3
    percent: int = 85
    rows: int = 6
    bands: int = 32
    seed: int = 2024

    @property
    def factors(self) -> np.ndarray:
        rng = np.random.default_rng(self.seed)
        return rng.integers(0, 1 << 31, self.rows * self.bands, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


class Sketcher:
    """Shingle sets and registers of texts; made once a worker.

    A word's hash is a polynomial of odd base over random values of its bytes,
    modulo 2**64; all words of a block are summed at once, each with the powers
    of where it stands, and divided by the power of its start.  Words of over
    ``LONG_WORD`` bytes are hashed one by one.
    """

    def __init__(self, setting: Setting):
        self.setting, self.factors = setting, setting.factors
        rng = np.random.default_rng(setting.seed + 1)
        self.values = rng.integers(1, 1 << 63, 256, dtype=np.uint64)[_LOWER]
        self.values[_SPACE] = 0
        base = int(rng.integers(1 << 60, 1 << 61)) * 8 + 5
        self.powers = self._powers(base)
        self.inverse = self._powers(pow(base, -1, 1 << 64))

    @staticmethod
    def _powers(base: int) -> np.ndarray:
        steps = np.full(BLOCK, base & ((1 << 64) - 1), np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    def _hash(self, raw: np.ndarray) -> np.ndarray:
        """The hashes of the words of a block."""
        space = np.ones(len(raw) + 2, bool)
        space[1:-1] = _SPACE[raw]
        edge = np.flatnonzero(space[1:] != space[:-1])
        starts, ends = edge[::2], edge[1::2]
        if not len(starts):
            return np.empty(0, np.uint64)
        long = np.flatnonzero(ends - starts > LONG_WORD)
        if len(raw) <= BLOCK:
            out = np.add.reduceat(self.values[raw] * self.powers[: len(raw)], starts) * self.inverse[starts]
        else:  # only a single word is longer than a block
            out = np.zeros(len(starts), np.uint64)
        for i in long:
            out[i] = xxhash.xxh3_64_intdigest(_LOWER[raw[starts[i] : ends[i]]].tobytes())
        return out

    def word_hashes(self, text: str) -> np.ndarray:
        """The words' hashes in order, block by block; blocks end before white space."""
        raw = np.frombuffer(text.encode(), np.uint8)
        if len(raw) <= BLOCK:
            return self._hash(raw)
        out, start = [], 0
        while start < len(raw):
            end = min(start + BLOCK, len(raw))
            if end < len(raw):
                gaps = np.flatnonzero(_SPACE[raw[start + 1 : end + 1]])
                if len(gaps):
                    end = start + 1 + int(gaps[-1])
                else:  # a word runs on past the block: white space may precede it only in this block's first byte
                    while end < len(raw) and not (more := np.flatnonzero(_SPACE[raw[end : end + BLOCK]])).size:
                        end = min(end + BLOCK, len(raw))
                    if end < len(raw):
                        end += int(more[0])
            out.append(self._hash(raw[start:end]))
            start = end
        return np.concatenate(out)

    def shingles(self, text: str) -> np.ndarray:
        """The sorted distinct 64-bit hashes of the shingles; a text of fewer words is one shingle, one without words none."""
        w = self.word_hashes(text)
        k = self.setting.width
        if not len(w):
            return w
        n = max(1, len(w) - k + 1)
        h = np.full(n, min(len(w), k), np.uint64)
        for j in range(min(k, len(w))):
            h = (h * np.uint64(0x9E3779B97F4A7C15)) ^ w[j : j + n]
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        h.sort()
        return h[np.concatenate(([True], h[1:] != h[:-1]))]

    def registers(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.factors), np.iinfo(np.uint32).max, np.uint32)
        low = shingles.astype(np.uint32)  # the shingles' low halves, multiplied in 32 bits: four times as many at once
        for i in range(0, len(low), CHUNK):
            np.minimum(least, (low[i : i + CHUNK, None] * self.factors).min(axis=0), out=least)
        u = (least.astype(np.float64) + 0.5) / 2.0**32
        return np.clip(np.floor(1 - np.log(-np.log1p(-np.minimum(u, 1 - 1e-16)) / RATE) / math.log(BASE)), 0, TOP).astype(np.uint16)

    def bands(self, registers: np.ndarray) -> list[int]:
        rows = self.setting.rows
        raw = registers.tobytes()
        return [
            xxhash.xxh3_64_intdigest(raw[2 * i : 2 * (i + rows)], seed=i) - (1 << 63)
            for i in range(0, len(registers), rows)
        ]


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The likeliest similarity of each pair of rows of registers, given the sets' sizes."""

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    a, b = a.astype(np.int32), b.astype(np.int32)
    more, less = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    same = a.shape[1] - more - less
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    j = np.linspace(0, 1, 101)[None, :] * np.minimum(u / v, v / u)
    up, down = p(u - v * j), p(v - u * j)
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = [np.where(k > 0, k * np.log(np.maximum(q, 1e-300)), 0.0) for k, q in ((more, up), (less, down), (same, 1 - up - down))]
    return np.take_along_axis(j, (parts[0] + parts[1] + parts[2]).argmax(1)[:, None], 1)[:, 0]


def reaches(same: np.ndarray, more: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, at: float) -> np.ndarray:
    """Whether the likeliest similarity is at least ``at``.

    The likelihood is concave in the similarity, so it is enough that it still
    grows there; sizes under which ``at`` is out of reach don't come here.
    """
    scale = (BASE - 1) / BASE
    u = n_a / (n_a + n_b)
    v = 1 - u
    x, y = scale * (u - v * at), scale * (v - u * at)
    log_base = math.log(BASE)
    up, down = -np.log1p(-x) / log_base, -np.log1p(-y) / log_base
    d_up, d_down = -v * scale / (1 - x) / log_base, -u * scale / (1 - y) / log_base
    with np.errstate(divide="ignore", invalid="ignore"):
        slope = more * d_up / np.maximum(up, 1e-12) + less * d_down / np.maximum(down, 1e-12) - same * (d_up + d_down) / (1 - up - down)
    return slope >= 0


def sketch(df: DataFrame, setting: Setting, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_shingles, set_hash, bands), one per row; an empty set has no hash and no bands."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Sketcher(setting)
        for batch in it:
            n, keys, bands = [], [], []
            for text in texts(batch):
                x = s.shingles(text)
                n.append(len(x))
                keys.append(hashlib.blake2b(x.tobytes(), digest_size=16).hexdigest() if len(x) else None)
                bands.append(s.bands(s.registers(x)) if len(x) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.string()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_hash", "bands"],
            )

    return id_and_text(df, id_col, text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, set_hash string, bands array<long>"
    )


def full_sets(df: DataFrame, wanted: DataFrame, setting: Setting, id_col: str, text_col: str) -> DataFrame:
    """(rep, n, registers, shingles) of the wanted documents, from a second scan.

    ``wanted`` (rep, set_hash).  A Bloom filter of fixed size tells the scan
    which documents may be wanted; only those are hashed again and shuffled,
    and the join leaves exactly the wanted ones.
    """
    words = bloom_of(wanted.select(F.xxhash64("rep").alias("h")), "h")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Sketcher(setting)
        for batch in it:
            keep = bloom_has(words, batch.column("h").to_numpy(zero_copy_only=False))
            batch = batch.filter(pa.array(keep))
            ids, n, keys, regs, sets = [], [], [], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                x = s.shingles(text)
                if len(x):
                    ids.append(doc)
                    n.append(len(x))
                    keys.append(hashlib.blake2b(x.tobytes(), digest_size=16).hexdigest())
                    regs.append(s.registers(x).tobytes())
                    sets.append(x.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(keys, pa.string()), pa.array(regs, pa.binary()), pa.array(sets, pa.binary())],
                ["rep", "n", "set_hash", "registers", "shingles"],
            )

    small_batches(df.sparkSession)
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("doc_id is not null")
    found = docs.withColumn("h", F.xxhash64("doc_id")).mapInArrow(run, "rep long, n long, set_hash string, registers binary, shingles binary")
    return found.join(wanted, ["rep", "set_hash"], "left_semi").dropDuplicates(["rep", "set_hash"]).drop("set_hash")


def _buckets(classes: DataFrame) -> DataFrame:
    """(bucket, rep, n) of bands that several classes share; buckets of the same members are one."""
    member = classes.select("rep", "n", F.posexplode("bands").alias("band", "value")).select("rep", "n", F.xxhash64("band", "value").alias("bucket"))
    shared = (
        member.groupBy("bucket")
        .agg(F.count("*").alias("size"), F.min("rep").alias("least"), F.expr("bit_xor(xxhash64(rep, 5L))").alias("mark"))
        .filter("size > 1")
        .groupBy("size", "least", "mark")
        .agg(F.min("bucket").alias("bucket"))
        .select("bucket")
    )
    return member.join(shared, "bucket")


def _likely(it: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of pairs with registers, those whose estimate doesn't rule them out."""
    for batch in it:
        keep = np.zeros(batch.num_rows, bool)
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            regs = [np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(part.num_rows, -1) for c in ("r_a", "r_b")]
            sizes = (part.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("n_a", "n_b"))
            keep[lo : lo + 256] = estimate(*regs, *sizes) >= percent / 100 - MARGIN
        yield batch.select(["a", "b", "copies", "copy"]).filter(pa.array(keep))


def _alike(it: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of pairs with full sets, those that reach the threshold."""
    for batch in it:
        keep = np.zeros(batch.num_rows, bool)
        for i, (s_a, s_b) in enumerate(zip(batch.column("s_a"), batch.column("s_b"), strict=True)):
            x, y = (np.frombuffer(s.as_py(), np.uint64) for s in (s_a, s_b))
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _confirm(pairs: DataFrame, pivots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs whose full sets reach the threshold.

    ``pairs`` (a, b, copies, copy), ``pivots`` (a, copies).  The registers
    decide which pairs the full sets are laid beside.  A pivot that may meet
    very many members is laid out in copies, among which its members are dealt.
    """

    def beside(rows: DataFrame, *columns: str) -> DataFrame:
        member = sets.select(F.col("rep").alias("b"), *(F.col(c).alias(f"{c[0]}_b") for c in columns))
        pivot = sets.select(F.col("rep").alias("a"), *(F.col(c).alias(f"{c[0]}_a") for c in columns)).join(pivots, "a")
        pivot = pivot.withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)"))).drop("copies")
        return rows.join(member, "b").join(pivot, ["a", "copy"])

    likely = beside(pairs, "n", "registers").mapInArrow(lambda it: _likely(it, percent), "a long, b long, copies long, copy long")
    return beside(likely, "shingles").select("a", "b", "s_a", "s_b").mapInArrow(lambda it: _alike(it, percent), "a long, b long")


def settle(cell: dict[str, np.ndarray], registers: np.ndarray, shingles: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join components among a cell's members, exact; at least enough of them to join all that links can join.

    ``cell`` has by member: rep, component, n, outer (not of the bucket's
    largest component), block.  Pairs of members of one block are compared
    where the cell has one block, else pairs of its two.
    """
    component, n, outer, block = cell["component"].copy(), cell["n"].astype(np.float64), cell["outer"], cell["block"]
    two = len(np.unique(block)) > 1
    sizes = np.array([len(x) for x in shingles])
    starts = np.cumsum(sizes) - sizes
    every = np.concatenate(shingles)
    _, flat = np.unique(every, return_inverse=True)
    held = np.zeros(int(flat.max()) + 1, np.int32)
    member = np.arange(len(n))
    out = []
    for i in np.flatnonzero(outer):
        # of two outer members the later one meets the earlier one
        meets = (component != component[i]) & (~outer | (member < i)) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i]))
        if two:
            meets &= block != block[i]
        rest = np.flatnonzero(meets)
        if not len(rest):
            continue
        near = registers[rest]
        more, less = (near < registers[i]).sum(1), (near > registers[i]).sum(1)
        # at the margin the sizes allow the similarity: it is below the threshold that they were held against
        rest = rest[reaches(registers.shape[1] - more - less, more, less, n[i], n[rest], percent / 100 - MARGIN)]
        if not len(rest):
            continue
        own = flat[starts[i] : starts[i] + sizes[i]]
        held[own] = 1
        if 4 * len(rest) >= len(n):
            both = np.add.reduceat(held[flat], starts)[rest]
        else:
            both = np.array([held[flat[starts[j] : starts[j] + sizes[j]]].sum() for j in rest])
        held[own] = 0
        linked = rest[100 * both >= percent * (sizes[i] + sizes[rest] - both)]
        for j in linked:
            if component[j] != component[i]:
                out.append((int(cell["rep"][i]), int(cell["rep"][j])))
                component[component == component[j]] = component[i]
    return out


def _settled(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that join components within buckets.  ``rest``: (bucket, rep, n, component) of the buckets' members still to compare."""
    by_component = rest.groupBy("bucket", "component").agg(F.count("*").alias("m"), F.sum("n").alias("sh"))
    mixed = (
        by_component.groupBy("bucket")
        .agg(F.count("*").alias("k"), F.sum("m").alias("m"), F.sum("sh").alias("sh"), F.max(F.struct("m", "component")).alias("largest"))
        .filter("k > 1")
        .select("bucket", F.col("largest.component").alias("largest"), F.expr(f"cast(greatest(ceil(m / {BLOCK_MEMBERS}), ceil(sh / {BLOCK_SHINGLES})) as long)").alias("blocks"))
    )
    dealt = (
        rest.join(mixed, "bucket")
        .withColumn("block", F.expr("pmod(xxhash64(rep, 3L), blocks)"))
        .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .select("bucket", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "rep", "component", (F.col("component") != F.col("largest")).alias("outer"))
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(pdf) > 1 and pdf["outer"].any() and pdf["component"].nunique() > 1:
            pdf = pdf.sort_values("rep")
            registers = np.frombuffer(b"".join(pdf["registers"]), np.uint16).reshape(len(pdf), -1)
            cell = {c: pdf[c].to_numpy() for c in ("rep", "component", "n", "outer", "block")}
            found = settle(cell, registers, [np.frombuffer(x, np.uint64) for x in pdf["shingles"]], percent)
        return pd.DataFrame({"a": [a for a, _ in found], "b": [b for _, b in found]}, dtype=np.int64)

    return dealt.join(sets, "rep").groupBy("bucket", "lo", "hi").applyInPandas(run, "a long, b long")


def _link(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """(id, component) of the classes that are linked; None if there are none."""
    # pivots of a bucket: one from each of a number of parts
    chosen = (
        members.groupBy("bucket", F.expr(f"pmod(xxhash64(rep, 9L), {PIVOTS})").alias("part"))
        .agg(F.min(F.struct("rep", "n")).alias("p"), F.count("*").alias("m"))
        .select("bucket", F.col("p.rep").alias("a"), F.col("p.n").alias("n_a"), "m")
    )
    # a pivot stands in at most as many buckets as there are bands
    chosen = materialise(chosen.withColumn("copies", F.ceil(PIVOTS * F.max("m").over(Window.partitionBy("a")) / MEETS)).drop("m"))
    pairs = (
        members.join(chosen, "bucket")
        # sets of too different sizes can't reach the threshold
        .filter(f"rep <> a and 100 * least(n, n_a) >= {percent} * greatest(n, n_a)")
        .select("a", F.col("rep").alias("b"), "copies")
        .distinct()
        .withColumn("copy", F.expr("pmod(xxhash64(b), copies)"))
    )
    edges = materialise(_confirm(pairs, chosen.select("a", "copies").distinct(), sets, percent))
    labels = materialise(components(edges))
    # a pivot has met all others of its bucket
    rest = members.join(chosen.select("bucket", F.col("a").alias("rep")), ["bucket", "rep"], "left_anti").join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    rest = materialise(rest.withColumn("component", F.coalesce("component", "rep")))
    more = materialise(_settled(rest, sets, percent))
    if more.isEmpty():
        return None if labels.isEmpty() else labels
    return materialise(components(edges.unionByName(more)))


def near_duplicates(df: DataFrame, setting: Setting = Setting(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one per row of ``df``.

    Words are what lies between ASCII white space, A-Z in lower case.  A text
    of fewer words than a shingle is one shingle; a null text or one without
    words has none and links with nothing.  ``component_id`` is the smallest id
    that links reach; ids are whole numbers.  A row with a null id links with
    nothing: component null, not kept.  Rows that repeat an id are one
    document where their texts agree and share the component otherwise too.
    An empty table gives an empty table; other columns are ignored.
    """
    rows = materialise(sketch(df, setting, id_col, text_col))
    classes = materialise(
        rows.filter("doc_id is not null and set_hash is not null")
        .groupBy("set_hash")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    )
    members = materialise(_buckets(classes))
    names = classes.select("rep", "set_hash")
    labels = None
    if not members.isEmpty():
        wanted = names.join(members.select("rep").distinct(), "rep", "left_semi")
        sets = materialise(full_sets(df, materialise(wanted), setting, id_col, text_col))
        labels = _link(members, sets, setting.percent)
    if labels is not None:
        names = names.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("set_hash", F.coalesce("component", "rep").alias("component"))
    else:
        names = names.select("set_hash", F.col("rep").alias("component"))
    out = (
        rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_hash")).alias("set_hash"))
        .join(names, "set_hash", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def drop_near_duplicates(df: DataFrame, setting: Setting = Setting(width=5, percent=80, rows=5), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without the documents that near-duplicate one of a smaller id; all columns stay.

    Rows with a null id stay: they can't be named as anything's copy.
    """
    gone = near_duplicates(df, setting, id_col, text_col).filter("doc_id is not null and not kept").select(F.col("doc_id").alias("__gone")).distinct()
    return df.join(materialise(gone), F.col(id_col) == F.col("__gone"), "left_anti")

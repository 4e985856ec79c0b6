"""Embedding near-duplicates with an inverted file and product quantisation.

Vectors are scaled to length 1; a cosine of at least ``threshold`` is then a
distance of at most R = sqrt(2 - 2 threshold).  Coarse centroids make inverted
lists, and a vector's residual to its list's centroid is coded by one of 256
centroids in each of eight subspaces.  Every row is indexed and every row is a
query: it looks into its own list and into every list whose border is at most
R / 2 away.  Two partners in different lists lie on either side of the border
between these, so their distances to it add up to at most R and one of them
looks into the other's list: no link is lost.  In a list the distances to the
codes are sums of looked-up values; a vector whose approximate distance exceeds
R by more than its own coding error can't be a partner; the rest are compared
exactly, in double precision.

Identical vectors are one class with a count.  Links inside a list are counted
and reduced to a spanning forest where they are found, so pairs are never
written out; a list of many vectors is cut into blocks, each pair of blocks a
task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import materialise
from docloom.llm.components import components

THRESHOLD = 0.93
#: Vectors that centroids are fitted on, most lists, subspaces, codes of a subspace, rounds of k-means.
SAMPLE, LISTS, SUBSPACES, CODES, ROUNDS = 32_768, 4_096, 8, 256, 8
#: Vectors of a list in one task, and queries compared at once.
BLOCK, ROWS = 4_096, 256
#: Vectors whose distances to all centres are held at once.
NEAR = 256


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Each vector's nearest centre, in stretches whose distances stay in the processor's cache."""
    square, twice = (centres**2).sum(1), 2 * centres.T
    out = np.empty(len(x), np.int64)
    for lo in range(0, len(x), NEAR):
        out[lo : lo + NEAR] = np.argmin(square - x[lo : lo + NEAR] @ twice, axis=1)
    return out


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = ROUNDS) -> np.ndarray:
    centres = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        of = _nearest(x, centres)
        n = np.bincount(of, minlength=len(centres))
        starts = np.cumsum(n) - n
        centres[n > 0] = np.add.reduceat(x[np.argsort(of, kind="stable")], starts[n > 0]) / n[n > 0][:, None]
    return centres


@dataclass
class Index:
    """Coarse centroids and the codebooks of the residuals' subspaces, for vectors of one dimension."""

    centres: np.ndarray
    books: list[np.ndarray] = field(default_factory=list)

    @property
    def cuts(self) -> list[slice]:
        edges = np.linspace(0, self.centres.shape[1], len(self.books) + 1).astype(int)
        return [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]

    def code(self, residuals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and each vector's coding error (its distance to what the codes stand for)."""
        codes = np.empty((len(residuals), len(self.books)), np.uint8)
        off = np.zeros(len(residuals))
        for j, (cut, book) in enumerate(zip(self.cuts, self.books, strict=True)):
            codes[:, j] = _nearest(residuals[:, cut], book)
            off += ((residuals[:, cut] - book[codes[:, j]]) ** 2).sum(1)
        return codes, np.sqrt(off)

    def probes(self, x: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's own list, and which lists it looks into: those whose border is at most half the radius away."""
        square = (self.centres**2).sum(1)
        d = square - 2 * (x @ self.centres.T)
        own = d.argmin(1)
        mine = self.centres[own]
        between = np.sqrt(np.maximum(square[own][:, None] + square - 2 * (mine @ self.centres.T), 1e-18))
        border = (d - d[np.arange(len(x)), own][:, None]) / (2 * between)
        return own, border <= radius / 2 + 1e-9

    def tables(self, residuals: np.ndarray) -> list[np.ndarray]:
        """For each subspace the squared distances of the queries to all codes."""
        return [
            (residuals[:, cut] ** 2).sum(1)[:, None] - 2 * residuals[:, cut] @ book.T + (book**2).sum(1)
            for cut, book in zip(self.cuts, self.books, strict=True)
        ]


def fit(vectors: np.ndarray, lists: int, seed: int = 11) -> Index:
    rng = np.random.default_rng(seed)
    centres = kmeans(vectors, lists, rng)
    residuals = vectors - centres[_nearest(vectors, centres)]
    index = Index(centres, [np.zeros((1, 1))] * min(SUBSPACES, vectors.shape[1]))
    index.books = [kmeans(residuals[:, cut], CODES, rng) for cut in index.cuts]
    return index


def _units(raw: list[bytes], dim: int) -> np.ndarray:
    """Stored vectors at length 1; the largest component is made 1 first, so that no square overflows or vanishes."""
    x = np.frombuffer(b"".join(raw), np.float64 if raw and len(raw[0]) == 8 * dim else np.float32).astype(np.float64).reshape(len(raw), dim)
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def _able(lists: pa.Array, single: bool) -> list[bytes | None]:
    """The bytes of each vector that can link, out of the array's own buffers: neither null nor empty, all components finite, one not zero."""
    lengths = np.asarray(lists.value_lengths().fill_null(0), np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    values = lists.flatten().cast(pa.float32() if single else pa.float64()).fill_null(math.nan)
    x = values.to_numpy(zero_copy_only=False) + 0  # -0 counts as 0
    of = np.repeat(np.arange(len(lengths)), lengths)
    odd = np.bincount(of[~np.isfinite(x)], minlength=len(lengths))
    filled = np.bincount(of[x != 0], minlength=len(lengths))
    raw, width = x.tobytes(), x.itemsize
    return [raw[a * width : b * width] if ok else None for a, b, ok in zip(starts.tolist(), ends.tolist(), ((odd == 0) & (filled > 0)).tolist(), strict=True)]


def _packed(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, dim, key, vec): vec is null where a vector can't link."""
    single = "float" in df.schema[vector_col].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            vecs = _able(batch.column("v"), single)
            dims = [len(v) // (4 if single else 8) if v else None for v in vecs]
            keys = [hashlib.blake2b(v, digest_size=16).hexdigest() if v else None for v in vecs]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(dims, pa.int32()), pa.array(keys, pa.string()), pa.array(vecs, pa.binary())],
                ["vec_id", "label", "dim", "key", "vec"],
            )

    return df.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("v")
    ).mapInArrow(run, "vec_id long, label string, dim int, key string, vec binary")


def _fit_all(classes: DataFrame, total: int, sample: int, most_lists: int) -> dict[int, Index]:
    """An index for each dimension in a bounded sample; a dimension so rare that the sample lacks it is one list, compared exactly."""
    rows = classes.select("dim", "vec", "key").orderBy("key").limit(sample).collect()
    by: dict[int, list[bytes]] = {}
    for r in rows:
        by.setdefault(r["dim"], []).append(bytes(r["vec"]))
    lists = max(1, min(most_lists, round(math.sqrt(total) / 4)))
    return {dim: fit(_units(v, dim), max(1, min(lists, len(v) // 8))) for dim, v in by.items()}


def _indexed(classes: DataFrame, indexes: dict[int, Index], radius: float) -> DataFrame:
    """Each class with its list, the lists it looks into, its codes and its coding error."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            n = batch.num_rows
            home, probes, codes, error = [0] * n, [[0] for _ in range(n)], [b""] * n, [0.0] * n
            dims, vecs = batch.column("dim").to_pylist(), batch.column("vec").to_pylist()
            for dim in set(dims):
                if dim not in indexes:
                    continue  # one list, all compared exactly
                index = indexes[dim]
                every = [i for i in range(n) if dims[i] == dim]
                for k in range(0, len(every), 512):
                    rows = every[k : k + 512]
                    x = _units([vecs[i] for i in rows], dim)
                    own, look = index.probes(x, radius)
                    c, e = index.code(x - index.centres[own])
                    for r, i in enumerate(rows):
                        home[i], probes[i], codes[i], error[i] = int(own[r]), np.flatnonzero(look[r]).tolist(), c[r].tobytes(), float(e[r])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("label", "dim", "id", "n", "vec")), pa.array(home, pa.int32()), pa.array(probes, pa.list_(pa.int32())), pa.array(codes, pa.binary()), pa.array(error, pa.float64())],
                ["label", "dim", "id", "n", "vec", "home", "probes", "codes", "error"],
            )

    return classes.select("label", "dim", "id", "n", "vec").mapInArrow(
        run, "label string, dim int, id long, n long, vec binary, home int, probes array<int>, codes binary, error double"
    )


class _Forest:
    """Sets of a block's vectors, by place; a set's root is its first place."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Each pair's sets become one: roots hang below smaller ones until no pair has two."""
        while True:
            a, b = self.root[a], self.root[b]
            apart = a != b
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while (flat := self.root[self.root]).tobytes() != self.root.tobytes():
                self.root = flat


def _lookers(probes: list[np.ndarray], lists: np.ndarray) -> dict[int, np.ndarray]:
    """For each of ``lists`` the residents that look into it."""
    counts = np.array([len(p) for p in probes], np.int64)
    flat = np.concatenate(probes) if counts.sum() else np.zeros(0, np.int64)
    order = np.argsort(flat, kind="stable")
    who, flat = np.repeat(np.arange(len(probes)), counts)[order], flat[order]
    return {int(h): who[np.searchsorted(flat, h) : np.searchsorted(flat, h, "right")] for h in lists}


def search_block(index: Index | None, at: int, queries: pd.DataFrame, residents: pd.DataFrame, dim: int, threshold: float) -> pd.DataFrame:
    """Links between queries and a list's residents: what each vector's count grows by, and a spanning forest."""
    radius = math.sqrt(2 - 2 * threshold)
    q_id, x_id = queries["id"].to_numpy(), residents["id"].to_numpy()
    q_n, x_n = queries["n"].to_numpy(), residents["n"].to_numpy()
    q, x = _units(queries["vec"].tolist(), dim), _units(residents["vec"].tolist(), dim)
    homes = queries["home"].to_numpy()
    add_q, add_x = np.zeros(len(q_id), np.int64), np.zeros(len(x_id), np.int64)
    # a pair of two lists is counted in one of them: where its query is of the smaller list, or where only this side looks
    looks = _lookers(residents["probes"].tolist(), np.unique(homes[homes > at]))
    ids = np.concatenate([q_id, x_id])
    order, back = np.unique(ids, return_inverse=True)
    forest = _Forest(len(order))
    codes = np.frombuffer(b"".join(residents["codes"].tolist()), np.uint8).reshape(len(x_id), -1) if index else None
    reach = (radius + residents["error"].to_numpy() + 1e-6) ** 2
    for lo in range(0, len(q_id), ROWS):
        hi = min(lo + ROWS, len(q_id))
        if index is None:
            near = np.ones((hi - lo, len(x_id)), bool)
        else:
            tables = index.tables(q[lo:hi] - index.centres[at])
            far = np.zeros((hi - lo, len(x_id)))
            for j, table in enumerate(tables):
                far += table[:, codes[:, j]]
            near = far <= reach
        near &= q_id[lo:hi, None] != x_id[None]
        for h in np.unique(homes[lo:hi][homes[lo:hi] > at]):
            near[np.ix_(homes[lo:hi] == h, looks[int(h)])] = False
        some = np.flatnonzero(near.any(0))
        if not len(some):
            continue
        linked = near[:, some] & (q[lo:hi] @ x[some].T >= threshold)
        add_q[lo:hi] += linked @ x_n[some]
        foreign = homes[lo:hi] != at
        add_x[some] += linked[foreign].T @ q_n[lo:hi][foreign]
        r, c = np.nonzero(linked)
        forest.join(back[lo + r], back[len(q_id) + some[c]])
    out = pd.DataFrame({"id": ids, "links": np.concatenate([add_q, add_x]), "to": order[forest.root[back]]})
    return out[(out["links"] > 0) | (out["to"] != out["id"])]


def links(classes: DataFrame, indexes: dict[int, Index], threshold: float, block: int = BLOCK) -> DataFrame:
    """(id, links, to): parts of each class's count of linked rows, and edges of spanning forests."""
    rows = materialise(_indexed(classes, indexes, math.sqrt(2 - 2 * threshold)))
    cell = ["label", "dim", "list"]
    queries = rows.select("label", "dim", F.explode("probes").alias("list"), "id", "n", "vec", "home")
    sizes = (
        rows.select("label", "dim", F.col("home").alias("list"), F.lit(0).alias("q"), F.lit(1).alias("x"))
        .unionByName(rows.select("label", "dim", F.explode("probes").alias("list")).select("*", F.lit(1).alias("q"), F.lit(0).alias("x")))
        .groupBy(*cell)
        .agg(F.expr(f"cast(ceil(sum(q) / {block}) as int)").alias("qs"), F.expr(f"cast(ceil(sum(x) / {block}) as int)").alias("xs"))
        .filter("qs > 0 and xs > 0")
    )
    dealt_q = (
        queries.join(sizes, cell)
        .withColumn("qc", F.expr("pmod(xxhash64(id), qs)"))
        .withColumn("xc", F.explode(F.expr("sequence(0L, xs - 1L)")))
        .select(*cell, "qc", "xc", F.lit(True).alias("query"), "id", "n", "vec", "home", F.expr("cast(null as array<int>)").alias("probes"), F.expr("cast(null as binary)").alias("codes"), F.lit(0.0).alias("error"))
    )
    dealt_x = (
        rows.withColumn("list", F.col("home"))
        .join(sizes, cell)
        .withColumn("xc", F.expr("pmod(xxhash64(id, 1L), xs)"))
        .withColumn("qc", F.explode(F.expr("sequence(0L, qs - 1L)")))
        .select(*cell, "qc", "xc", F.lit(False).alias("query"), "id", "n", "vec", "home", "probes", "codes", "error")
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        dim, at = int(pdf["dim"].iloc[0]), int(pdf["list"].iloc[0])
        q, x = pdf[pdf["query"]], pdf[~pdf["query"]]
        if not len(q) or not len(x):
            return pd.DataFrame({"id": [], "links": [], "to": []}, dtype=np.int64)
        return search_block(indexes.get(dim), at, q, x, dim, threshold)

    return dealt_q.unionByName(dealt_x).groupBy(*cell, "qc", "xc").applyInPandas(run, "id long, links long, to long")


def near_duplicates(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
    most_lists: int = LISTS,
    block: int = BLOCK,
) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one per row of ``df``.

    Rows of equal, non-null label and equal dimension link at a cosine of at
    least ``threshold``.  A vector that is null, empty or zero, or that holds a
    null or non-finite component, links with nothing, nor does a row with a
    null label or id; such a row is its own component (a null id: null, not
    kept).  Rows that repeat an id are vectors of their own: each counts as a
    link of the others.  An empty table gives an empty table; other columns are
    ignored.

    Every link reported is exact, and none is missing: one of two partners
    always looks into the other's list (held against brute force in the tests).
    """
    rows = materialise(_packed(df, id_col, vector_col, label_col))
    able = rows.filter("vec_id is not null and label is not null and vec is not null")
    classes = able.groupBy("label", "dim", "key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("vec").alias("vec"))
    # numbers of the classes, fixed once they are stored: vectors that repeat an id are classes of their own
    classes = materialise(classes.withColumn("id", F.monotonically_increasing_id()))
    indexes = _fit_all(classes, classes.count(), sample, most_lists)
    found = materialise(links(classes, indexes, threshold, block))
    more = found.groupBy("id").agg(F.sum("links").alias("links"))
    whole = components(found.filter("id <> to"), "id", "to")
    named = materialise(
        classes.select("label", "dim", "key", "rep", "n", "id")
        .join(more, "id", "left")
        .join(whole, "id", "left")
        .select("label", "dim", "key", "rep", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "id").alias("whole"), F.col("component").isNotNull().alias("joined"))
    )
    # the smallest vec_id of a component; a component's first class has no entry of its own in ``whole``
    least = named.groupBy("whole").agg(F.min("rep").alias("component"), F.max("joined").alias("any")).filter("any").select("whole", "component")
    named = named.join(least, "whole", "left").select("label", "dim", "key", "links", F.coalesce("component", "rep").alias("component"))
    out = (
        rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("label")).alias("label"), "dim", "key")
        .join(named, ["label", "dim", "key"], "left")
        .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

"""A quality classifier by attention-based multiple-instance learning.

A document is a bag of passages, blocks of 1,024 UTF-8 bytes.  Every passage is
encoded: the square roots of the shares of its hashed byte pairs, how much of
it repeats and how full it is go through a learned layer, h = tanh(W x + b).  Gated attention weighs the passages,

    a = softmax(w . (tanh(V h) * sigmoid(U h))),

and the document's score is sigmoid(c . sum(a h) + c0).  All weights are learned
from document labels only, with numpy on the driver, from a bounded sample of
labelled documents; every document is scored on the executors from all of its
passages.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import id_and_text, small_batches, texts

PASSAGE, BUCKETS, HIDDEN, GATE = 1_024, 1_024, 24, 12
#: Bytes of the stretches whose repetition counts, buckets they are hashed to, and features beside the byte pairs.
STRETCH, STRETCH_BUCKETS, EXTRA = 8, 4_096, 2
#: Bounds of the training sample: documents, and passages of all of them together.  A document is taken with all its passages or not at all.
SAMPLE, SAMPLE_PASSAGES = 8_000, 32_768
#: Passes over the sample, but at least so many steps.
EPOCHS, LEAST_STEPS, STEP, DECAY, BATCH = 30, 1_500, 0.004, 1e-5, 64
#: Passages whose features are held at once.
BLOCK = 512


def passages_of(text: str) -> list[bytes]:
    """The passages; an empty text is one empty passage."""
    data = text.encode()
    return [data[i : i + PASSAGE] for i in range(0, len(data), PASSAGE)] or [b""]


def features(passages: list[bytes]) -> np.ndarray:
    """One row a passage: square roots of the shares of its hashed byte pairs, the share of its stretches that repeat, its fill."""
    n = len(passages)
    sizes = np.fromiter(map(len, passages), np.int64, n)
    raw = np.frombuffer(b"\0".join(passages) + b"\0", np.uint8).astype(np.uint32)
    pair = ((raw[:-1] << 8 | raw[1:]) * np.uint32(0x9E3779B1)) >> np.uint32(32 - int(math.log2(BUCKETS)))
    starts = np.cumsum(sizes + 1) - sizes - 1
    keep = np.ones(len(raw), bool)
    keep[starts + sizes] = False  # what follows a passage's end belongs to no passage
    key = np.repeat(np.arange(n), sizes) * BUCKETS + pair[keep[:-1]]
    counts = np.bincount(key, minlength=n * BUCKETS).reshape(n, BUCKETS)
    # each byte starts a stretch, of which the last ones run over the passage's end with what fills up
    wide = np.frombuffer((b"\0" * STRETCH).join(passages) + b"\0" * STRETCH, np.uint8)
    words = np.lib.stride_tricks.sliding_window_view(wide, STRETCH).copy().view(np.uint64).ravel()
    gaps = np.cumsum(sizes + STRETCH) - sizes - STRETCH
    at = np.repeat(gaps - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    place = (words[at] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - int(math.log2(STRETCH_BUCKETS)))
    seen = np.zeros(n * STRETCH_BUCKETS, bool)
    seen[np.repeat(np.arange(n), sizes) * STRETCH_BUCKETS + place.astype(np.int64)] = True
    distinct = seen.reshape(n, STRETCH_BUCKETS).sum(1)
    out = np.empty((n, BUCKETS + EXTRA), np.float32)
    out[:, :BUCKETS] = np.sqrt(counts / np.maximum(sizes, 1)[:, None])
    out[:, BUCKETS] = 1 - distinct / np.maximum(sizes, 1)
    out[:, BUCKETS + 1] = sizes / PASSAGE
    return out


@dataclass
class Model:
    """Weights; ``prior`` is the score where there was nothing to learn from."""

    W: np.ndarray
    b: np.ndarray
    V: np.ndarray
    U: np.ndarray
    w: np.ndarray
    c: np.ndarray
    c0: np.ndarray
    prior: float | None = None

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Representation and unnormalised attention of passages."""
        h = np.tanh(x @ self.W + self.b)
        return h, (np.tanh(h @ self.V) * _sigmoid(h @ self.U)) @ self.w

    def scores(self, bags: list[list[bytes]]) -> np.ndarray:
        """A score a bag, from all of its passages."""
        if self.prior is not None:
            return np.full(len(bags), self.prior)
        flat = [p for bag in bags for p in bag]
        parts = [self.encode(features(flat[i : i + BLOCK])) for i in range(0, len(flat), BLOCK)]
        h = np.concatenate([x for x, _ in parts]).astype(np.float64)
        a = np.concatenate([x for _, x in parts]).astype(np.float64)
        first = np.cumsum([0] + [len(bag) for bag in bags[:-1]])
        sizes = np.array([len(bag) for bag in bags])
        e = np.exp(a - np.repeat(np.maximum.reduceat(a, first), sizes))
        z = np.add.reduceat(h * e[:, None], first) / np.add.reduceat(e, first)[:, None]
        return _sigmoid(z @ self.c.astype(np.float64) + float(self.c0[0]))


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def learn(bags: list[list[bytes]], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Fit by Adam on the log loss, each document one bag."""
    y = np.array(labels, np.float32)
    rng = np.random.default_rng(seed)
    shapes = {"W": (BUCKETS + EXTRA, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,), "c0": (1,)}
    p = {k: (rng.standard_normal(s) * (1 / math.sqrt(s[0]) if k != "W" else 1.0)).astype(np.float32) for k, s in shapes.items()}
    p["b"][:] = 0
    p["c0"][:] = 0
    if len(y) == 0 or y.min() == y.max():
        return Model(**p, prior=float(y.mean()) if len(y) else 0.5)
    flat = [p for bag in bags for p in bag]
    x = np.empty((len(flat), BUCKETS + EXTRA), np.float32)
    for i in range(0, len(flat), BLOCK):
        x[i : i + BLOCK] = features(flat[i : i + BLOCK])
    sizes = np.array([len(b) for b in bags])
    first = np.cumsum(sizes) - sizes
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    t = 0
    for _ in range(max(epochs, math.ceil(LEAST_STEPS * BATCH / len(y)))):
        order = rng.permutation(len(y))
        for i in range(0, len(order), BATCH):
            take = order[i : i + BATCH]
            n = sizes[take]
            rows = np.concatenate([np.arange(first[k], first[k] + sizes[k]) for k in take])
            at = np.cumsum(n) - n
            of = np.repeat(np.arange(len(take)), n)
            xb, yb = x[rows], y[take]
            h = np.tanh(xb @ p["W"] + p["b"])
            tv, su = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
            g = tv * su
            a = g @ p["w"]
            e = np.exp(a - np.maximum.reduceat(a, at)[of])
            e /= np.add.reduceat(e, at)[of]
            z = np.add.reduceat(h * e[:, None], at)
            d = ((_sigmoid(z @ p["c"] + p["c0"][0]) - yb) / len(take)).astype(np.float32)
            dz = d[:, None] * p["c"]
            # through the weighted mean and the softmax
            along = (h * dz[of]).sum(1)
            da = e * (along - np.add.reduceat(along * e, at)[of])
            dg = da[:, None] * p["w"]
            dv, du = dg * su * (1 - tv**2), dg * tv * su * (1 - su)
            dh = (e[:, None] * dz[of] + dv @ p["V"].T + du @ p["U"].T) * (1 - h**2)
            grad = {"W": xb.T @ dh, "b": dh.sum(0), "V": h.T @ dv, "U": h.T @ du, "w": g.T @ da, "c": z.T @ d, "c0": d.sum(keepdims=True)}
            t += 1
            for k, v in grad.items():
                v = v + DECAY * p[k]
                m[k] = 0.9 * m[k] + 0.1 * v
                s[k] = 0.999 * s[k] + 0.001 * v * v
                p[k] = (p[k] - STEP * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return Model(**p)


def training_sample(
    df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int, held_out: int, folds: int, most_passages: int = SAMPLE_PASSAGES
) -> tuple[list[list[bytes]], list[int]]:
    """Bags and labels of labelled documents outside the held-out fold, the same at each run.

    In the order of a hash of their ids, at most ``sample`` documents are
    looked at, and each is taken whole that still fits into ``most_passages``.
    The ids are chosen from the labels alone, so the join's other side is
    bounded and broadcast; the texts aren't shuffled.
    """
    chosen = (
        labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y"))
        .filter(F.col("__y").isin(0, 1) & (F.crc32(F.col("__id").cast("string")) % folds != held_out))
        .groupBy("__id")
        .agg(F.max("__y").alias("__y"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(sample)
    )
    known = id_and_text(df, id_col, text_col).join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))
    known = known.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("__y").alias("y")).withColumn("n", F.greatest(F.ceil(F.octet_length("text") / PASSAGE), F.lit(1)))
    known = known.withColumn("h", F.xxhash64("doc_id", "text"))
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("h")]
    sizes = known.select("doc_id", "h", "n").orderBy(*order).limit(sample).collect()  # rows that repeat an id don't widen the bound
    fits, left = [], most_passages
    for r in sizes:
        if r["n"] <= left:
            left -= r["n"]
            fits.append((r["doc_id"], r["h"]))
    if not fits:
        return [], []
    wanted = df.sparkSession.createDataFrame(sorted(set(fits)), f"w {df.schema[id_col].dataType.simpleString()}, wh long")
    rows = (
        known.join(F.broadcast(wanted), (F.col("doc_id") == F.col("w")) & (F.col("h") == F.col("wh")))
        .dropDuplicates(["doc_id", "h"])
        .orderBy(*order)
        .select("text", "y")
        .collect()
    )
    return [passages_of(r["text"]) for r in rows], [r["y"] for r in rows]


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, held_out: int = 1, folds: int = 3) -> Model:
    """A model from the labelled rows outside the held-out fold (crc32 of the id as text, modulo ``folds``).

    Labels other than 0 and 1 and null ids aren't used; of several labels of an
    id the larger counts; without labels of both classes the model is their
    share.  The sample is bounded by ``sample`` documents and ``SAMPLE_PASSAGES``
    passages.
    """
    bags, y = training_sample(df, labels, id_col, text_col, label_col, sample, held_out, folds)
    return learn(bags, y)


def _scored(ts: list[str], model: Model) -> np.ndarray:
    """Scores of texts, taken in groups of about a block of passages."""
    out, bags, held = [], [], 0
    for text in ts:
        bags.append(passages_of(text))
        held += len(bags[-1])
        if held >= BLOCK:
            out.append(model.scores(bags))
            bags, held = [], 0
    if bags:
        out.append(model.scores(bags))
    return np.round(np.concatenate(out), 12) if out else np.zeros(0)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, score), one per row of ``df``; no shuffle.

    Only the text decides.  A null text is the empty text, a bag of one empty
    passage, and has a score too; null ids stay null; repeated rows score the
    same; an empty table gives an empty table; other columns are ignored.  A
    model that had no labels of both classes gives every text the share of
    label 1 (0.5 without any label).
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_scored(texts(batch), model), pa.float64())], ["doc_id", "score"])

    kind = df.schema[id_col].dataType.simpleString()
    return id_and_text(df, id_col, text_col).mapInArrow(run, f"doc_id {kind}, score double")


def keep_good(df: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``df`` whose text scores at least ``threshold``, with all their columns; a null text counts as the empty one, equal rows are kept or go together."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            yield batch.filter(pa.array(_scored(texts(batch, text_col), model) >= threshold, pa.bool_()))

    small_batches(df.sparkSession)
    return df.mapInArrow(run, df.schema)

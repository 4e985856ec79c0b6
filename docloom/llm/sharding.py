"""Sharding of indivisible groups by Karmarkar-Karp differencing.

A partial partition is a tuple of ``n`` subsets with their sums.  Differencing
takes the two partial partitions of the largest spread (largest sum less
smallest) and combines them oppositely ordered: the largest subset of one with
the smallest of the other.  Until one is left, that balances far better than
dealing by size.

It runs in levels, so that no task sees all groups.  Groups fall into buckets
by their hash; each bucket is differenced in a task of its own and gives one
partial partition; those are differenced again, a bounded number at a time, up
to the last one.  A group's shard follows from its subset in its bucket and
from where each level put that subset.
"""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import join_hot, materialise

#: Groups differenced in one task, partial partitions combined in one task, rows numbered in one task.
BUCKET_GROUPS, FAN_IN, SLOT_ROWS = 4_000, 1_000, 10_000


def difference(sizes: list[list[int]], n: int) -> list[list[int]]:
    """Combine partial partitions, each ``n`` sums: for each, which final subset each of its subsets goes to."""
    if not sizes:
        return []
    # a node: (-spread, order, sums ascending, members per subset as (partition, subset) in linked pairs)
    heap = []
    for k, sums in enumerate(sizes):
        order = sorted(range(n), key=lambda j: (sums[j], j))
        ranked = [sums[j] for j in order]
        heap.append((ranked[0] - ranked[-1], k, ranked, [(k, j) for j in order]))
    heapq.heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        _, _, a, of_a = heapq.heappop(heap)
        _, _, b, of_b = heapq.heappop(heap)
        both = sorted(((a[i] + b[n - 1 - i], i) for i in range(n)))
        sums = [s for s, _ in both]
        heapq.heappush(heap, (sums[0] - sums[-1], made, sums, [(of_a[i], of_b[n - 1 - i]) for _, i in both]))
        made += 1
    out = [[0] * n for _ in sizes]
    for subset, tree in enumerate(heap[0][3]):
        stack = [tree]
        while stack:
            x, y = stack.pop()
            if isinstance(x, tuple):
                stack += [x, y]
            else:
                out[x][y] = subset
    return out


def partition(values: list[int], n: int) -> list[int]:
    """The subset of each value."""
    placed = difference([[v] + [0] * (n - 1) for v in values], n)
    return [p[0] for p in placed]


def _difference_buckets(groups: DataFrame, n: int) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "group"], ascending=[False, True], kind="stable")
        return pd.DataFrame({"group": pdf["group"], "bucket": pdf["bucket"], "size": pdf["size"], "subset": partition(pdf["size"].tolist(), n)})

    return groups.groupBy("bucket").applyInPandas(run, "group string, bucket long, size long, subset int")


def _combine(parts: DataFrame, n: int, fan_in: int) -> DataFrame:
    """(part, subset, size) to (part, subset, above, subset_above): one level up."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = sorted(pdf["part"].unique())
        at = {p: i for i, p in enumerate(ids)}
        sums = [[0] * n for _ in ids]
        for p, j, s in zip(pdf["part"], pdf["subset"], pdf["size"], strict=True):
            sums[at[p]][j] = int(s)
        rows = [
            (p, j, int(pdf["above"].iloc[0]), to[j], sums[i][j])
            for i, (p, to) in enumerate(zip(ids, difference(sums, n), strict=True))
            for j in range(n)
        ]
        return pd.DataFrame(rows, columns=["part", "subset", "above", "subset_above", "size"])

    return (
        parts.withColumn("above", F.expr(f"part div {fan_in}"))
        .groupBy("above")
        .applyInPandas(run, "part long, subset int, above long, subset_above int, size long")
    )


def assign_groups(groups: DataFrame, n: int, bucket_groups: int = BUCKET_GROUPS, fan_in: int = FAN_IN) -> DataFrame:
    """(group string, size long), groups distinct and stored, to (group, shard)."""
    buckets = max(1, math.ceil(groups.count() / bucket_groups))
    low = materialise(_difference_buckets(groups.withColumn("bucket", F.expr(f"pmod(xxhash64(`group`), {buckets}L)")), n))
    place = low.groupBy(F.col("bucket").alias("part"), "subset").agg(F.sum("size").alias("size"))
    at, width = low.select("group", F.col("bucket").alias("part"), "subset"), buckets
    while True:
        level = materialise(_combine(place, n, fan_in))
        at = at.join(level.select("part", "subset", "above", "subset_above"), ["part", "subset"]).select(
            "group", F.col("above").alias("part"), F.col("subset_above").alias("subset")
        )
        width = math.ceil(width / fan_in)
        if width <= 1:
            return at.select("group", F.col("subset").alias("shard"))
        place = level.groupBy(F.col("above").alias("part"), F.col("subset_above").alias("subset")).agg(F.sum("size").alias("size"))


def number_slots(rows: DataFrame, order: list[str], slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Add ``slot``: each shard's rows numbered from 0 without gaps.

    Rows are spread over blocks by a hash of the order columns, which together
    tell any two rows apart; a row's slot is the number of its shard's rows in
    earlier blocks plus its place in its own block, so no task numbers a whole
    shard.
    """
    total = rows.count()
    blocks = max(1, math.ceil(total / slot_rows))
    rows = rows.withColumn("block", F.pmod(F.xxhash64(*order, F.lit(7)), F.lit(blocks)))
    before = Window.partitionBy("shard").orderBy("block")
    counts = rows.groupBy("shard", "block").agg(F.count("*").alias("n"))
    counts = counts.select("shard", "block", (F.sum("n").over(before) - F.col("n")).alias("earlier"))
    place = Window.partitionBy("block", "shard").orderBy(*order)
    return (
        rows.withColumn("in_block", F.row_number().over(place) - 1)
        .join(counts, ["block", "shard"])
        .withColumn("slot", (F.col("earlier") + F.col("in_block")).cast("long"))
        .drop("block", "in_block", "earlier")
    )


def shard(
    df: DataFrame,
    n_shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_groups: int = BUCKET_GROUPS,
    fan_in: int = FAN_IN,
    slot_rows: int = SLOT_ROWS,
) -> DataFrame:
    """Rows (doc_id, size, text_crc32, group, shard, slot), one per row of ``df``.

    Documents of equal text are one indivisible group.  A null text is the
    empty text: size 1.  Null ids are placed like others; repeated rows are
    each placed, with a slot of their own; an empty table gives an empty
    table; other columns are ignored.  One group larger than a shard's share
    stays whole: its shard is then as large as that group.

    Only ids, sizes and hashes are shuffled, never texts.  A group with a large
    part of the rows is looked up in a bounded broadcast, and rows of one id
    (or none) are told apart by a stored row number, so neither ends in one
    task.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = materialise(
        df.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.md5(text).alias("group"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    groups = materialise(rows.groupBy("group").agg(F.sum("size").alias("size"), F.count("*").alias("n")))
    shards = assign_groups(groups.select("group", "size"), n_shards, bucket_groups, fan_in)
    found = materialise(shards.join(groups.select("group", "n"), "group"))
    placed = materialise(join_hot(rows, found, "group", "shard"))
    return number_slots(placed, ["doc_id", "row"], slot_rows).drop("row")

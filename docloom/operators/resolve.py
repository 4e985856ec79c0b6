"""Old ids resolved to new ones by the evidence that both name."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from math import ceil, isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows (id, evidence) of a block on average, and pairs of an old and a new id that a task lays out at once.
BLOCK, PAIRS = 4_000_000, 4_000_000
#: Rows (id, evidence) of both sides that a task joins on average, and that it packs at once.
PACKED = 2_000_000
#: What a block knows of each piece of evidence besides its ids: new ids that share its weight, ids on the other side, the smallest of them.
KNOWN = ["n", "held", "first"]
#: Columns of a piece of a block, each a small file, as a row holds millions of ids.
PIECE = ["heads", "ids", "known"]


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of all runs, one after the other."""
    end = np.cumsum(size)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(start - end + size, size)


def _packed(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of blocks from rows (id, evidence, block and what is known), a bounded number of rows at a time."""
    held: list[pa.RecordBatch] = []
    for batch in it:
        held.append(batch)
        if sum(b.num_rows for b in held) >= PACKED:
            yield from _pieces(pa.Table.from_batches(held))
            held = []
    if held:
        yield from _pieces(pa.Table.from_batches(held))


def _pieces(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """(block, heads, ids, known): the pieces of evidence of a block with the number of their ids and ``n``; the ids; what else is known of each piece."""
    column = {c: pa.concat_arrays(rows[c].chunks) for c in rows.column_names}
    code, block = column["evidence"].dictionary_encode().indices.to_numpy(), column["block"].to_numpy()
    order = np.lexsort((code, block))
    code, block = code[order], block[order]
    begin = np.flatnonzero((np.diff(code, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
    size, of = np.diff(begin, append=len(order)).astype(np.int32), block[begin]
    for first in np.flatnonzero(np.diff(of, prepend=-1)):
        last = np.searchsorted(of, of[first], "right")
        heads = pa.array(order[begin[first:last]])
        ids = column["id"].take(pa.array(order[begin[first] : begin[last - 1] + size[last - 1]]))
        take = {c: column[c].take(heads) for c in ("evidence", *KNOWN)}
        tables = {"evidence": take["evidence"], "size": pa.array(size[first:last]), "n": take["n"]}, {"ids": ids}, {"held": take["held"], "first": take["first"]}
        yield pa.RecordBatch.from_arrays([pa.array(of[first : first + 1]), *(pa.array([_bytes(pa.table(t))]) for t in tables)], ["block", *PIECE])


def _bytes(table: pa.Table) -> bytes:
    """A small Parquet file, whole numbers as packed differences."""
    sink, whole = pa.BufferOutputStream(), {f.name: "DELTA_BINARY_PACKED" for f in table.schema if pa.types.is_integer(f.type)}
    pq.write_table(table, sink, compression="zstd", use_dictionary=False, column_encoding=whole, write_statistics=False)
    return sink.getvalue().to_pybytes()


def _read(pieces: pa.Array, part: str) -> dict[str, pa.Array]:
    """The columns of one part of all pieces of a block."""
    table = pa.concat_tables([pq.ParquetFile(pa.BufferReader(b.as_buffer())).read(use_threads=False) for b in pc.struct_field(pieces, part)])
    return {c: pa.concat_arrays(table[c].chunks) for c in table.column_names}


def _alone(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, weight, n, first) by each id's heaviest piece of evidence alone: how many on the other side have it, the smallest of them."""
    for batch in it:
        for pieces in (row.values for row in batch.column("pieces")):
            ids, known = _read(pieces, "ids")["ids"].dictionary_encode(), _read(pieces, "heads") | _read(pieces, "known")
            of, size = ids.indices.to_numpy(), known["size"].to_numpy()
            weight = np.repeat(np.floor(1_000_000 / known["n"].to_numpy() + 0.5).astype(np.int64), size)
            top = np.zeros(len(ids.dictionary), np.int64)
            np.maximum.at(top, of, weight)
            is_top = weight == top[of]
            n = np.zeros(len(top), np.int64)
            np.add.at(n, of[is_top], np.repeat(known["held"].to_numpy(), size)[is_top])
            found = known["first"].dictionary_encode()
            names = found.dictionary.take(pc.sort_indices(found.dictionary))  # numbered in their order, so that the smallest is the least
            place = np.repeat(pc.index_in(known["first"], names).to_numpy(zero_copy_only=False), size)
            least = np.full(len(top), len(names))
            np.minimum.at(least, of[is_top], place[is_top])
            yield pa.RecordBatch.from_arrays([ids.dictionary, pa.array(top), pa.array(n), names.take(pa.array(least))], ["id", "weight", "n", "first"])


def _several(it: Iterable[pa.RecordBatch], pairs: int) -> Iterator[pa.RecordBatch]:
    """(old_id, new_id, weight, n): best pairs of an id in two blocks that share several pieces of evidence.

    One pair stands for all that weigh the same for its old id (their number in
    the upper half of n) or for its new id (in the lower half).
    """
    for batch in it:
        for old, new in zip((row.values for row in batch.column("old")), (row.values for row in batch.column("new"))):
            # the new ids of each piece of evidence, in one run
            heads, ids = _read(new, "heads"), _read(new, "ids")["ids"].dictionary_encode()
            evidence, new_names, size = pc.unique(heads["evidence"]), ids.dictionary, heads["size"].to_numpy().astype(np.int64)
            code = pc.index_in(heads["evidence"], evidence).to_numpy(zero_copy_only=False)
            order = np.argsort(code)
            others = ids.indices.to_numpy()[_runs((np.cumsum(size) - size)[order], size[order])]
            n = np.zeros(len(evidence), np.int64)
            n[code] = heads["n"].to_numpy()
            size = np.bincount(code, size, len(evidence)).astype(np.int64)
            start = np.cumsum(size) - size
            # the old ids that have several of these pieces, in order
            heads, ids = _read(old, "heads"), _read(old, "ids")["ids"].dictionary_encode()
            code = np.repeat(pc.fill_null(pc.index_in(heads["evidence"], evidence), -1).to_numpy(zero_copy_only=False), heads["size"].to_numpy())
            of, old_names = ids.indices.to_numpy(), ids.dictionary
            keep = (code >= 0) & (np.bincount(of[code >= 0], minlength=len(old_names)) > 1)[of]
            of, code = of[keep], code[keep]
            order = np.argsort(of)
            of, code = of[order], code[order]
            if not len(of):
                continue
            begin = np.flatnonzero(np.diff(of, prepend=-1))
            done = np.cumsum(np.add.reduceat(size[code], begin))
            bits, best = int(n.max()).bit_length(), np.zeros(len(new_names), np.int64)
            rank = np.zeros(len(new_names), np.int64)
            rank[pc.sort_indices(new_names).to_numpy()] = np.arange(len(rank))
            room = max(1, (1 << 62 - bits) // len(new_names))
            lo = 0
            while lo < len(begin):
                hi = min(max(lo + 1, int(np.searchsorted(done, (done[lo - 1] if lo else 0) + pairs, "right"))), lo + room)
                part = slice(begin[lo], begin[hi] if hi < len(begin) else len(of))
                c, o = code[part], of[part]
                if size[c].sum() > pairs:  # one id with very many pairs: its weights are summed up new id by new id
                    c = c[np.argsort(n[c], kind="stable")]
                    total, times = np.zeros(len(new_names)), np.zeros(len(new_names), np.int64)
                    steps = np.cumsum(size[c]) // pairs
                    for s in np.split(c, np.flatnonzero(np.diff(steps)) + 1):
                        at = others[_runs(start[s], size[s])]
                        np.add.at(total, at, np.repeat(1_000_000 / n[s], size[s]))
                        times += np.bincount(at, minlength=len(times))
                    name = np.flatnonzero(times > 1)
                    row, weight = np.full(len(name), o[0]), np.floor(total[name] + 0.5).astype(np.int64)
                else:
                    key = np.repeat((np.cumsum(np.diff(o, prepend=o[0]) != 0)) * len(new_names), size[c]) + others[_runs(start[c], size[c])]
                    key = key << bits | np.repeat(n[c], size[c])
                    key.sort()
                    pair = key >> bits
                    same = np.concatenate([[False], pair[1:] == pair[:-1], [False]])
                    several = same[1:] | same[:-1]
                    key, pair = key[several], pair[several]
                    first = np.flatnonzero(np.diff(pair, prepend=-1))
                    weight = np.floor(np.add.reduceat(1_000_000 / (key & (1 << bits) - 1), first) + 0.5).astype(np.int64) if len(first) else np.zeros(0, np.int64)
                    row, name = np.divmod(pair[first], len(new_names))
                    row = of[begin[lo:hi]][row]
                top = np.zeros(len(old_names), np.int64)
                np.maximum.at(top, row, weight)
                np.maximum.at(best, name, weight)
                n_same = np.zeros(len(weight), np.int64)
                for whose, most, other, half in ((row, top, rank[name], 32), (name, best, row, 0)):
                    at = np.flatnonzero(weight == most[whose])
                    at = at[np.lexsort((other[at], whose[at]))]
                    first = np.flatnonzero(np.diff(whose[at], prepend=-1))
                    n_same[at[first]] += np.diff(first, append=len(at)) << half
                keep = np.flatnonzero(n_same)
                yield pa.RecordBatch.from_arrays([old_names.take(pa.array(row[keep])), new_names.take(pa.array(name[keep])), pa.array(weight[keep]), pa.array(n_same[keep])], ["old_id", "new_id", "weight", "n"])
                lo = hi


def resolved(old: DataFrame, new: DataFrame, most_holders: int = 1_000, block: int = BLOCK, pairs: int = PAIRS) -> DataFrame:
    """(old_id, new_id, weight, outcome) for every old id.

    ``old``: old_id, evidence; ``new``: new_id, evidence.  A piece of evidence
    weighs one part of as many as new ids name it; one that more than
    ``most_holders`` (a million at most) name on either side tells nothing, by
    definition, so no group of pairs grows with the table.  A pair is matched
    if each is the other's only best.  Outcomes: matched; tied (several new ids
    weigh the same, the smallest is shown); outbid (the new id's best is
    another old one, or several); none.

    Neither pairs nor lists of an id's partners are shuffled.  A pair that
    shares one piece of evidence weighs what the piece does, and less than any
    pair that shares it and another, so the best of these follows from counts.
    Pairs that share several are found block by block: rows (id, evidence) are
    packed into blocks by id, each task takes a block of old ids and one of new
    ids, and lays out the pairs of some old ids at a time.  What is stored
    grows with the rows; what is read grows with rows times blocks.
    """
    if most_holders > 1_000_000:
        raise ValueError("the weight of a piece of evidence is at least 1 for a million holders at most")
    spark = old.sparkSession
    rows, partitions = {"old": old.count(), "new": new.count()}, int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the number of tasks follows the rows, so that what one holds does not
    tasks, least = max(partitions, ceil(sum(rows.values()) / PACKED)), isqrt(partitions - 1) + 1
    # by evidence once, for distinct rows, counts and joins alike
    clean = lambda x, c: x.select(F.col(c).alias("id"), "evidence").filter("id is not null and evidence is not null").repartition(tasks, "evidence").distinct()
    sides = {"old": clean(old, "old_id"), "new": clean(new, "new_id")}
    few = {s: x.groupBy("evidence").agg(F.count("*").alias(f"n_{s}"), F.min("id").alias(f"first_{s}")).filter(F.col(f"n_{s}") <= most_holders) for s, x in sides.items()}
    shared = few["new"].join(few["old"], "evidence")

    def blocks(side: str, other: str) -> DataFrame:
        """A row for each block of ids: what its rows say, in pieces as they were packed."""
        n = max(least, ceil(rows[side] / block))
        known = shared.select("evidence", F.col("n_new").cast("int").alias("n"), F.col(f"n_{other}").cast("int").alias("held"), F.col(f"first_{other}").alias("first"))
        found = sides[side].join(known, "evidence").select("id", "evidence", *KNOWN, F.pmod(F.hash("id"), F.lit(n)).alias("block"))
        packed = found.mapInArrow(_packed, "block int, heads binary, ids binary, known binary")
        return packed.repartitionById(n, "block").groupBy("block").agg(F.collect_list(F.struct(*PIECE)).alias("pieces"))

    olds, news = blocks("old", "new"), blocks("new", "old")
    kinds = {"old": old.schema["old_id"].dataType.simpleString(), "new": new.schema["new_id"].dataType.simpleString()}
    pairing = lambda x, c: x.select(F.transform("pieces", lambda p: F.struct(p["heads"].alias("heads"), p["ids"].alias("ids"))).alias(c))
    grid = pairing(olds, "old").hint("shuffle_replicate_nl").crossJoin(pairing(news, "new"))
    several = grid.mapInArrow(partial(_several, pairs=pairs), f"old_id {kinds['old']}, new_id {kinds['new']}, weight long, n long")
    # read from one shuffle by both sides, so neither may ask for less of it than the other
    several = several.filter("old_id is not null and new_id is not null").repartition(tasks, "old_id")

    def best(packed: DataFrame, side: str, other: str) -> DataFrame:
        """(id, weight, n, first): the largest weight of an id, how many have it, the smallest of these."""
        alone = packed.select("pieces").mapInArrow(_alone, f"id {kinds[side]}, weight long, n long, first {kinds[other]}").repartition(tasks, "id")
        n = F.shiftright("n", 32) if side == "old" else F.col("n").bitwiseAND((1 << 32) - 1)
        many = several.groupBy(f"{side}_id", "weight").agg(F.sum(n).alias("n"), F.min(f"{other}_id").alias("first"))
        many = many.groupBy(F.col(f"{side}_id").alias("id")).agg(F.max(F.struct("weight", "n", "first")).alias("m"))
        more, same = F.coalesce(F.col("m.weight") > F.col("weight"), F.lit(False)), F.coalesce(F.col("m.weight") == F.col("weight"), F.lit(False))
        either = lambda c, both: F.when(more, F.col(f"m.{c}")).when(same, both).otherwise(F.col(c)).alias(c)
        return alone.join(many, "id", "left").select("id", either("weight", F.col("weight")), either("n", F.col("m.n") + F.col("n")), either("first", F.least("m.first", "first")))

    bids = best(news, "new", "old").select(F.col("id").alias("new_id"), F.col("weight").alias("bid"), F.col("n").alias("n_bid"))
    tops = best(olds, "old", "new").select(F.col("id").alias("old_id"), F.col("first").alias("new_id"), "weight", "n")
    outcome = F.when(F.col("n") > 1, "tied").when((F.col("weight") < F.col("bid")) | (F.col("n_bid") > 1), "outbid").otherwise("matched")
    told = tops.join(bids, "new_id").select("old_id", "new_id", "weight", outcome.alias("outcome"))
    ids = old.select("old_id").filter("old_id is not null").distinct()
    return ids.join(told, "old_id", "left").withColumn("outcome", F.coalesce("outcome", F.lit("none")))

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Least and most bits of a Bloom filter, and bits a key: it is never larger than 32 MB, so it may be broadcast.
LEAST_BITS, MOST_BITS, KEY_BITS = 1 << 20, 1 << 28, 24


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    The setting is read from the session; only where it is unset (tests, a
    laptop) is a folder of our own set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = "/tmp/docloom-checkpoints"
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/docloom/{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders of intermediate results through Spark's own file system."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme: one without stands for Spark's default file system, not the local one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


#: A key with more than this part of all rows is hot; so there are fewer hot keys than this, whatever the table's size.
HOT_KEYS = 4_096


def join_hot(rows: DataFrame, found: DataFrame, key: str, value: str) -> DataFrame:
    """``rows`` with the column ``value`` of ``found`` (key, value, n), null where the key is null or not found.

    ``found`` is stored and has every key once, with the number ``n`` of rows
    that have it; keys are hexadecimal strings.  Hot keys are looked up in a
    broadcast of fewer than ``HOT_KEYS`` rows.  Their rows and those without a
    key meet nothing in the shuffled join, so each goes by a key of its own and
    no task gets all rows of one key.
    """
    total = found.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * HOT_KEYS > total
    quick = F.broadcast(found.filter(hot).select(F.col(key).alias("__key"), F.col(value).alias("__quick")))
    slow = found.filter(~hot).select(F.col(key).alias("__key"), F.col(value).alias("__slow"))
    out = rows.join(quick, F.col(key) == F.col("__key"), "left").drop("__key")
    alone = F.col("__quick").isNotNull() | F.col(key).isNull()
    out = out.withColumn("__at", F.when(alone, F.concat(F.lit("~"), F.monotonically_increasing_id().cast("string"))).otherwise(F.col(key)))
    out = out.join(slow, F.col("__at") == F.col("__key"), "left")
    return out.withColumn(value, F.coalesce("__quick", "__slow")).drop("__key", "__at", "__quick", "__slow")


#: Rows, and bytes, that are handed to a Python worker at once.
BATCH_ROWS, BATCH_BYTES = 1_000, 16 << 20


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python workers in small batches: Spark's default of 10,000 rows costs each worker, and the JVM beside it, hundreds of megabytes.

    A session that has set a size of its own keeps it.
    """
    for key, default, value in (("maxRecordsPerBatch", "10000", BATCH_ROWS), ("maxBytesPerBatch", None, BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(name, None)
        if now is None or now == default or default is None and int(re.sub(r"\D", "", now) or 0) > value:
            spark.conf.set(name, str(value))


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The whole texts of a batch; null counts as empty."""
    return ["" if t is None else t for t in batch.column(name).to_pylist()]


def id_and_text(df: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """Only the columns an operator reads, under fixed names: extra columns can't clash."""
    small_batches(df.sparkSession)
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more)


def blocks(it: Iterable[list], size: int) -> Iterator[list]:
    """Lists of at least ``size`` items out of smaller lists (the last may be shorter)."""
    held: list = []
    for x in it:
        held += x
        if len(held) >= size:
            yield held
            held = []
    if held:
        yield held


def bloom_of(df: DataFrame, key_hash: str, most_bits: int = MOST_BITS) -> np.ndarray:
    """A Bloom filter with two probes over a column of 64-bit hashes, as 64-bit words.

    Its size follows the number of keys, up to ``most_bits``.  It is aggregated
    on the executors; at most ``most_bits / 64`` words come to the driver,
    however many keys there are.  Beyond ``most_bits / KEY_BITS`` keys there are
    more false positives, which every user of the filter removes by an exact join.
    """
    bits = LEAST_BITS
    keys = df.count()
    while bits < most_bits and bits < KEY_BITS * keys:
        bits *= 2
    word = F.explode(
        F.array(
            F.expr(f"pmod({key_hash}, {bits})"),
            F.expr(f"pmod(shiftright({key_hash}, 32), {bits})"),
        )
    )
    words = (
        df.select(word.alias("bit"))
        .groupBy(F.expr("shiftright(bit, 6)").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("mask"))
    )
    got = words.toPandas()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[got["word"].to_numpy(np.int64)] = got["mask"].to_numpy(np.int64).view(np.uint64)
    return out


def bloom_has(words: np.ndarray, key_hash: np.ndarray) -> np.ndarray:
    """Which of the signed 64-bit hashes may be in the filter."""
    bits = len(words) * 64
    out = np.ones(len(key_hash), dtype=bool)
    for h in (key_hash, key_hash >> 32):
        b = np.mod(h, bits)
        out &= (words[b >> 6] >> (b & 63).astype(np.uint64)) & np.uint64(1) == 1
    return out


def proven_split(text: str, start: int, end: int) -> int:
    """The last place in (start, end] where the byte-level pre-tokeniser must split, or -1.

    Such a place lies between an ASCII character that isn't white space and a
    space or line feed: no alternative of the pattern holds a character of
    either kind before one of the other, so a match always ends there, whatever
    stands on either side.
    """
    while True:
        p = max(text.rfind(" ", start + 1, end), text.rfind("\n", start + 1, end))
        if p < 0:
            return -1
        if "!" <= text[p - 1] <= "~":
            return p
        end = p

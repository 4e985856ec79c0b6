"""A review ledger kept by a stream of decisions.

The stream's state holds the latest decision of each key; a batch writes the
keys that it changed to a folder of its own, named by the batch's number.  A
batch that is run again after a failure writes the same folder anew, so a
ledger that is replayed from its checkpoint is the ledger that an undisturbed
run gives.  What is latest is told by ``seq`` alone, not by arrival, so it
doesn't matter how files are dealt to batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.sources.files import exists


def latest(decisions: DataFrame, key: str, fields: list[str], seq: str) -> DataFrame:
    """(key, fields, seq, n): each key's last decision and how many it had, of a stream or a table.

    Of equal ``seq`` the larger fields win, in order; a null ``seq`` is before
    all others, a null key is a key.
    """
    last = F.max(F.struct(seq, *fields))
    out = decisions.groupBy(key).agg(last.alias("__d"), F.count("*").alias("n"))
    return out.select(key, *(F.col("__d")[c].alias(c) for c in [*fields, seq]), "n")


def keep(decisions: DataFrame, key: str, fields: list[str], seq: str, path: str, checkpoint: str, written: Callable[[int], None] | None = None) -> None:
    """Fold all that has arrived on the stream ``decisions`` into the ledger at ``path``, then stop; called again it goes on from ``checkpoint``.

    ``written`` is called with a batch's number once its folder is there.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
        if written:
            written(number)

    run = latest(decisions, key, fields, seq).writeStream.outputMode("update").foreachBatch(put)
    run.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def ledger(spark: SparkSession, path: str, key: str, schema: str) -> DataFrame:
    """The ledger as it stands: each key as the last batch that changed it has it; ``schema`` gives a ledger without batches its columns."""
    if not exists(spark, f"{path}/batch=*"):
        return spark.createDataFrame([], schema)
    rows = spark.read.parquet(path)
    columns = [c for c in rows.columns if c not in (key, "batch")]
    last = F.max_by(F.struct(*columns), "batch").alias("__r")
    return rows.groupBy(key).agg(last).select(key, "__r.*")


def compact(spark: SparkSession, path: str, target: str, key: str, schema: str) -> DataFrame:
    """The ledger written to ``target`` as one batch numbered -1, which any later batch beside it overrules."""
    ledger(spark, path, key, schema).write.mode("overwrite").parquet(f"{target}/batch=-1")
    return ledger(spark, target, key, schema)

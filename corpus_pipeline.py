"""A corpus pipeline of five stages over ``documents``.

Each stage works on all that its predecessor kept; its result is written to the
folder that driver and executors share and read again by the next one, after
which its own predecessor's folder is deleted.

A null text counts as the empty text in every decision and stays null up to the
last stage, which encodes it as no ids; empty texts link with nothing, hold
nothing, and stay if the classifier keeps the empty text.  Very long texts are
taken whole.  A null id stays and is nothing's copy; rows that repeat an id and
a text stay or go together; of equal texts of different ids the smallest id
stays.  An empty table gives an empty one, without labels of both classes the
first stage keeps what the share of label 1 tells (all without any label), and
without benchmark items the third keeps all.  Columns beside those of
``documents`` pass through all stages but the last, whatever they are called.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import byte_bpe, decontaminate, near_dedup, pii, quality
from docloom.llm.common import remove, shared_folder
from docloom.session import table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below one half go."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document of the smallest id stays."""
    return near_dedup.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that disclose it are replaced in the texts; ``n_chars`` follows."""
    return pii.sanitise(docs).withColumn("n_chars", F.length("text").cast("long"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every remaining text, with the hashes of ids and decoded bytes."""
    return byte_bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("PII", pii_stage),
    ("byte-level BPE", bpe_stage),
]

#: A trained classifier decides the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, from ``documents``."""
    docs, held = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        kept, path = stage(spark, docs, sf_dir), shared_folder(spark)
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if held:
            remove(spark, held)
        held = path
    return STAGES[-1][1](spark, docs, sf_dir)

"""Sinks: files with fixed columns, partitioned sets, manifests, and keyed writes to stored tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docloom.sources.files import exists


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """CSV with these columns in this order; nulls as empty cells, quotes doubled."""
    df.select(*columns).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """A JSON object a line, UTF-8 as it is, null fields kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_lines(df: DataFrame, path: str, line: Column) -> None:
    """A text a line: Markdown, HTML or Turtle blocks."""
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """A folder for each group; folders of groups that are no more go."""
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def manifest(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(name, n_bytes, sha256) of files; a path that names none is an error."""
    if missing := [p for p in paths if not exists(spark, p)]:
        raise FileNotFoundError(", ".join(missing))
    files = spark.read.format("binaryFile").load(paths)
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha256"))


def _whole(key: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in key))


def replaced(base: DataFrame, incoming: DataFrame, keys: list[list[str]], seq: str) -> DataFrame:
    """``base`` with the incoming rows put in one by one in the order of ``seq``, which differs from row to row.

    A row that is put in deletes all rows that share a key with it, be it the
    primary or another unique one; a key with a null in it clashes with none.
    Every incoming row is put in, if only for a while.  So a base row goes if
    any incoming one shares a key with it, also one that is deleted later; and
    an incoming row stays if it is the last one with each of its keys.  Both
    are plain joins: the last of each key is aggregated before rows move, and
    is met by key and ``seq`` together, so that a frequent key is no hot one.
    """
    fresh = incoming
    for key in keys:
        last = incoming.filter(_whole(key)).groupBy(*key).agg(F.max(seq).alias(seq))
        fresh = fresh.join(last, [*key, seq], "left_semi").unionByName(fresh.filter(~_whole(key)))
        base = base.join(last.select(*key), key, "left_anti").select(*base.columns)
    return base.unionByName(fresh.select(*base.columns))


def slice_replaced(base: DataFrame, doomed: Column, incoming: DataFrame) -> DataFrame:
    """``base`` without the rows of a slice, and the slice made anew: the same however often it runs."""
    return base.filter(~F.coalesce(doomed, F.lit(False))).unionByName(incoming)


def cascade(tables: dict[str, tuple[DataFrame, str]], doomed: DataFrame, key: str, guard: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """Tables without the rows of the doomed keys, and how many rows each lost.

    ``tables``: name to (rows, key column).  If ``guard`` refers to any doomed
    key, nothing is deleted: that is an error.
    """
    keys = doomed.select(key).distinct()
    if not guard.join(keys, key, "left_semi").isEmpty():
        raise ValueError("an item to delete is referred to by a group")
    left, counts = {}, []
    for name, (rows, column) in tables.items():
        of = keys.withColumnRenamed(key, column)
        left[name] = rows.join(of, column, "left_anti")
        counts.append(rows.join(of, column, "left_semi").agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n"))
    return left, reduce(DataFrame.unionByName, counts)


def updated(base: DataFrame, decisions: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``base`` with the decisions' fields where they are filled; a blank one leaves what was there."""
    fresh = decisions.select(key, *(F.nullif(F.trim(f), F.lit("")).alias(f"__{f}") for f in fields))
    out = base.join(fresh, key, "left")
    for f in fields:
        out = out.withColumn(f, F.coalesce(f"__{f}", f))
    return out.select(*base.columns)


def put_in_place(spark: SparkSession, staged: str, path: str) -> None:
    """A folder that has been written beside ``path`` in its place."""
    jvm = spark._jvm
    target, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.old-{uuid.uuid4().hex}"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target):
        fs.rename(target, old)
    fs.rename(jvm.org.apache.hadoop.fs.Path(staged), target)
    fs.delete(old, True)


def swap(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Write beside ``path`` and put it in place at the end: a failure leaves what was there."""
    staged = f"{path}.new-{uuid.uuid4().hex}"
    df.write.parquet(staged)
    put_in_place(spark, staged, path)


def load_pack(spark: SparkSession, folder: str, order: list[tuple[str, list[str]]], rows: dict[str, DataFrame], seq: str = "seq") -> list[tuple[str, int, int]]:
    """Upsert the row sets of a pack into stored tables in a fixed order; (table, rows before, rows after).

    All tables are looked for before any is written.
    """
    if missing := [n for n, _ in order if not exists(spark, f"{folder}/{n}")]:
        raise FileNotFoundError(f"no table {', '.join(missing)}")
    out = []
    for name, key in order:
        base = spark.read.parquet(f"{folder}/{name}")
        before = base.count()
        if name in rows:
            swap(spark, replaced(base, rows[name], [key], seq), f"{folder}/{name}")
        out.append((name, before, spark.read.parquet(f"{folder}/{name}").count()))
    return out


def written_with(df: DataFrame, path: str, metrics: dict[str, Column]) -> dict[str, object]:
    """Write ``df`` and return aggregates of it that were taken while it was written, without a second scan."""
    seen = Observation()
    df.observe(seen, *(c.alias(n) for n, c in metrics.items())).write.parquet(path)
    return seen.get


def replaced_with(spark: SparkSession, df: DataFrame, path: str, metrics: dict[str, Column]) -> tuple[dict, dict]:
    """Put ``df``, which may be made from the table at ``path``, in its place; the metrics of what was there and of what is there now."""
    before = spark.read.parquet(path).agg(*(c.alias(n) for n, c in metrics.items())).first().asDict()
    staged = f"{path}.new-{uuid.uuid4().hex}"
    after = written_with(df, staged, metrics)
    put_in_place(spark, staged, path)
    return before, after

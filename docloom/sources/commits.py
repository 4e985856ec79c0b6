"""Stored tables that documents are committed to one by one, though one job loads many.

A load stages the rows of all its documents below a new folder, says for each
document whether they count, and ends by putting a new manifest in place, by
one rename.  Before that nothing of it is seen, after it all; a document that
failed has no rows in it and keeps those of its last load.  Readers go by the
newest manifest; of a document loaded several times the last completed load
counts.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of a failure's text that are kept.
NOTE = 500
ERROR = "__error"


def attempted(df: DataFrame, id_col: str, work, schema: str) -> DataFrame:
    """The rows that ``work(pandas frame of a document)`` makes, and a row with a note in ``__error`` for each document where it raises."""
    out = T.StructType([*T._parse_datatype_string(schema).fields, T.StructField(ERROR, T.StringType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        try:
            made = work(pdf)
            return made.assign(**{ERROR: None})[out.names]
        except Exception as e:  # noqa: BLE001 - whatever a document's work raises fails that document alone
            row = {n: None for n in out.names} | {id_col: pdf[id_col].iloc[0], ERROR: f"{type(e).__name__}: {e}"[:NOTE]}
            return pd.DataFrame([row], columns=out.names)

    return df.groupBy(id_col).applyInPandas(run, out)


class Store:
    """Tables below a folder that all executors and the driver can reach."""

    def __init__(self, spark: SparkSession, folder: str, id_col: str = "doc_id") -> None:
        self.spark, self.folder, self.id_col = spark, folder.rstrip("/"), id_col
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.folder}/{name}" if name else self.folder)

    def manifest(self) -> dict:
        """The newest manifest: its version and its loads, the oldest first."""
        folder = self._path("manifests")
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        newest = max((n for n in names if n.endswith(".json")), default=None)
        if newest is None:
            return {"version": 0, "loads": []}
        return json.loads(self.spark.read.text(f"{self.folder}/manifests/{newest}", wholetext=True).first()[0])

    def _publish(self, manifest: dict) -> None:
        """Put a manifest in place; if another load has come first, that is an error and nothing changes."""
        staged, target = self._path(f"staged/{uuid.uuid4().hex}.json"), self._path(f"manifests/{manifest['version']:012d}.json")
        self._fs.mkdirs(target.getParent())
        out = self._fs.create(staged, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if self._fs.exists(target) or not self._fs.rename(staged, target):
            self._fs.delete(staged, False)
            raise FileExistsError(f"version {manifest['version']} has been committed meanwhile")

    def _loads(self) -> list[dict]:
        return self.manifest()["loads"]

    def statuses(self) -> DataFrame:
        """(id, version, run_status, notes, n_rows): what became of each document in each load."""
        parts = [self.spark.read.parquet(f"{self.folder}/{x['folder']}/_status").withColumn("version", F.lit(x["version"])) for x in self._loads()]
        if not parts:
            raise FileNotFoundError(f"{self.folder} holds no load")
        return reduce(DataFrame.unionByName, parts)

    def latest(self) -> DataFrame:
        """(id, version): the last completed load of each document."""
        return self.statuses().filter("run_status = 'completed'").groupBy(self.id_col).agg(F.max("version").alias("version"))

    def table(self, name: str) -> DataFrame:
        """A table's committed rows."""
        parts = [self.spark.read.parquet(f"{self.folder}/{x['folder']}/{name}").withColumn("version", F.lit(x["version"])) for x in self._loads() if name in x["tables"]]
        if not parts:
            raise FileNotFoundError(f"{self.folder} holds no {name}")
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        return rows.join(self.latest(), [self.id_col, "version"], "left_semi").drop("version")

    def load(self, documents: DataFrame, tables: dict[str, DataFrame], checks: dict[str, dict[str, Column]] | None = None, required: str | None = None, rerun: bool = False) -> DataFrame:
        """Load tables for documents and say of each what became of it: (id, run_status, notes, n_rows, version).

        ``checks``: by table a name and a condition that no row of it may meet.
        A row's ``__error``, if its table has one, fails its document too.
        ``required``: the table without rows of which a document has no source.
        A document that has been completed before is skipped unless ``rerun``.
        Statuses: missing_source, skipped_existing, failed, completed.  Rows of
        documents that aren't named in ``documents`` are left out.
        """
        key, now = self.id_col, self.manifest()
        ids = documents.select(key).filter(F.col(key).isNotNull()).distinct()
        faults, counts = [], []
        for name, rows in tables.items():
            found = [F.when(F.coalesce(bad, F.lit(False)), F.lit(f"{name}: {code}")) for code, bad in (checks or {}).get(name, {}).items()]
            if ERROR in rows.columns:
                found.append(F.when(F.col(ERROR).isNotNull(), F.concat(F.lit(f"{name}: "), F.col(ERROR))))
            note = F.coalesce(*found) if found else F.lit(None).cast("string")
            faults.append(rows.select(key, note.alias("note"), F.lit(name).alias("table")))
        # one aggregation over all tables' rows: the first fault by text, and how many rows each table has
        every = reduce(DataFrame.unionByName, faults)
        counts = [F.count_if(F.col("table") == n).alias(f"n_{n}") for n in tables]
        seen = every.groupBy(key).agg(F.min("note").alias("note"), F.count("*").alias("n_rows"), *counts)
        before = self.latest().select(key, F.lit(True).alias("before")) if now["loads"] else ids.limit(0).select(key, F.lit(True).alias("before"))
        status = ids.join(seen, key, "left").join(before, key, "left")
        missing = F.coalesce(F.col(f"n_{required}" if required else "n_rows"), F.lit(0)) == 0
        status = status.withColumn(
            "run_status",
            F.when(F.lit(not rerun) & F.coalesce("before", F.lit(False)), "skipped_existing").when(F.col("note").isNotNull(), "failed").when(missing, "missing_source").otherwise("completed"),
        )
        done = F.col("run_status") == "completed"
        status = status.select(key, "run_status", F.when(F.col("run_status") == "failed", F.substring("note", 1, NOTE)).alias("notes"), F.when(done, F.col("n_rows")).otherwise(0).alias("n_rows"))
        folder, version = f"loads/{uuid.uuid4().hex}", now["version"] + 1
        try:
            status.write.parquet(f"{self.folder}/{folder}/_status")
            stored = self.spark.read.parquet(f"{self.folder}/{folder}/_status")
            good = stored.filter(done).select(key)
            for name, rows in tables.items():
                rows.drop(ERROR).join(good, key, "left_semi").write.parquet(f"{self.folder}/{folder}/{name}")
            self._publish({"version": version, "loads": [*now["loads"], {"version": version, "folder": folder, "tables": sorted(tables)}]})
        except BaseException:
            self._fs.delete(self._path(folder), True)
            raise
        return stored.withColumn("version", F.lit(version))

    def compacted(self) -> None:
        """All committed rows as one load: what later loads have replaced is no longer read."""
        loads = self._loads()
        names = sorted({t for x in loads for t in x["tables"]})
        folder, now = f"loads/{uuid.uuid4().hex}", self.manifest()
        last = self.statuses().join(self.latest(), [self.id_col, "version"], "left_semi").drop("version")
        last.write.parquet(f"{self.folder}/{folder}/_status")
        for n in names:
            self.table(n).write.parquet(f"{self.folder}/{folder}/{n}")
        version = now["version"] + 1
        self._publish({"version": version, "loads": [{"version": version, "folder": folder, "tables": names}]})

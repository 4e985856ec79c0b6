"""The streamed ledger against the same decisions as a table: in any order of arrival, replayed, and after a failure."""

import random

import pytest
from pyspark.sql import functions as F

from docloom.streaming import ledger

SCHEMA = "key string, status string, note string, seq long"
OUT = "key string, status string, note string, seq long, n long"


def _decisions(n, seed):
    r = random.Random(seed)
    return [(r.choice(["a", "b", "c", "d", None]), r.choice(["approved", "rejected", None]), r.choice(["", "x", None]), r.choice([None, *range(20)])) for _ in range(n)]


def _arrive(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def _keep(spark, folder, path, checkpoint, written=None):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    ledger.keep(stream, "key", ["status", "note"], "seq", path, checkpoint, written)


def _rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def _want(spark, rows):
    return _rows(ledger.latest(spark.createDataFrame(rows, SCHEMA), "key", ["status", "note"], "seq"))


@pytest.fixture
def folders(tmp_path):
    return [str(tmp_path / x) for x in ("in", "ledger", "checkpoint")]


def test_goes_on_from_its_checkpoint(spark, folders):
    source, path, checkpoint = folders
    every = []
    for k in range(3):
        rows = _decisions(40, k)
        every += rows
        _arrive(spark, source, rows)
        _keep(spark, source, path, checkpoint)
        assert _rows(ledger.ledger(spark, path, "key", OUT)) == _want(spark, every)
    _keep(spark, source, path, checkpoint)
    assert _rows(ledger.ledger(spark, path, "key", OUT)) == _want(spark, every)


def test_failed_batch_runs_again(spark, folders):
    source, path, checkpoint = folders
    every = []
    for k in range(3):
        every += _decisions(30, 10 + k)
        _arrive(spark, source, every[-30:])

    def fail(number):
        if number == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        _keep(spark, source, path, checkpoint, fail)
    assert _rows(ledger.ledger(spark, path, "key", OUT)) != _want(spark, every)
    _keep(spark, source, path, checkpoint)
    assert _rows(ledger.ledger(spark, path, "key", OUT)) == _want(spark, every)


def test_compacted(spark, folders, tmp_path):
    source, path, checkpoint = folders
    _arrive(spark, source, _decisions(50, 5))
    _arrive(spark, source, _decisions(50, 6))
    _keep(spark, source, path, checkpoint)
    before = _rows(ledger.ledger(spark, path, "key", OUT))
    assert _rows(ledger.compact(spark, path, str(tmp_path / "small"), "key", OUT)) == before
    (spark.createDataFrame([("a", "approved", "z", 99, 1)], OUT)).write.parquet(str(tmp_path / "small/batch=7"))
    assert [r["note"] for r in ledger.ledger(spark, str(tmp_path / "small"), "key", OUT).filter("key = 'a'").collect()] == ["z"]


def test_nothing_arrived(spark, folders):
    source, path, checkpoint = folders
    _arrive(spark, source, [])
    _keep(spark, source, path, checkpoint)
    assert ledger.ledger(spark, path, "key", OUT).count() == 0


def test_order_of_arrival_is_nothing(spark, folders):
    source, path, checkpoint = folders
    _arrive(spark, source, [("a", "new", "", 5)])
    _keep(spark, source, path, checkpoint)
    _arrive(spark, source, [("a", "old", "", 4), ("a", "none", "", None)])
    _keep(spark, source, path, checkpoint)
    assert ledger.ledger(spark, path, "key", OUT).select("status", F.col("n")).first() == ("new", 3)

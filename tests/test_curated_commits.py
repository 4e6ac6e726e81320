"""A failure between any two steps leaves the old or the new table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from waitcast.sources import files as FS
from waitcast.streaming import ingest as X

SCHEMA = "row_id long, fecha date, k string, w double"
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def _rows(spark, path):
    return sorted((r.row_id, r.w) for r in X.read_curated(spark, path).collect())


@pytest.fixture
def started(spark):
    sink = X.CuratedMerge(FS.staging_dir(spark, "t-commits"), ["fecha", "k"], "row_id")
    with pytest.raises(FileNotFoundError):
        X.read_curated(spark, sink.path)
    sink(spark.createDataFrame([(1, D1, "a", 1.0), (2, D2, "a", 2.0), (3, None, "a", 3.0)], SCHEMA), 0)
    return sink


def test_failure_while_writing_leaves_the_old_table(spark, started):
    batch = spark.createDataFrame([(5, D1, "a", 5.0), (6, D2, "b", 6.0)], SCHEMA)
    started.transform = lambda b: b.withColumn("w", F.when(F.col("row_id") == 6, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("w")))
    with pytest.raises(Exception, match="lost"):
        started(batch, 1)
    assert _rows(spark, started.path) == [(1, 1.0), (2, 2.0), (3, 3.0)]
    started.transform = None
    started(batch, 1)
    assert _rows(spark, started.path) == [(2, 2.0), (3, 3.0), (5, 5.0), (6, 6.0)]


def test_failure_before_the_commit_leaves_the_old_table(spark, started, monkeypatch):
    before = X.read_curated(spark, started.path)

    def lost(*_):
        raise RuntimeError("lost")

    batch = spark.createDataFrame([(5, D1, "a", 5.0), (7, None, "b", 7.0)], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(started, "_commit", lost)
        with pytest.raises(RuntimeError, match="lost"):
            started(batch, 1)
    assert _rows(spark, started.path) == [(1, 1.0), (2, 2.0), (3, 3.0)]
    started(batch, 1)  # the replay writes over what was left
    assert _rows(spark, started.path) == [(2, 2.0), (3, 3.0), (5, 5.0), (7, 7.0)]
    started(spark.createDataFrame([(9, D1, "a", 9.0)], SCHEMA), 1)  # committed already
    assert _rows(spark, started.path) == [(2, 2.0), (3, 3.0), (5, 5.0), (7, 7.0)]
    # a reader that opened the table before keeps its rows
    assert sorted(r.w for r in before.collect()) == [1.0, 2.0, 3.0]


def test_empty_batches_and_untouched_partitions(spark, started):
    started(spark.createDataFrame([], SCHEMA), 1)
    assert _rows(spark, started.path) == [(1, 1.0), (2, 2.0), (3, 3.0)]
    started(spark.createDataFrame([(8, D2, "a", 8.0)], SCHEMA), 10)
    last = X.last_commit(spark, started.path)
    assert last.batch_id == 10 and last.held == {"2024-01-01": 0, "2024-01-02": 10, None: 0}
    assert sorted(r.row_id for r in last.read(spark, {"2024-01-01"}).collect()) == [1]


def test_a_first_batch_without_rows(spark):
    sink = X.CuratedMerge(FS.staging_dir(spark, "t-commits"), ["fecha", "k"], "row_id")
    sink(spark.createDataFrame([], SCHEMA), 0)
    assert X.read_curated(spark, sink.path).count() == 0
    sink(spark.createDataFrame([(1, D1, "a", 1.0)], SCHEMA), 1)
    assert _rows(spark, sink.path) == [(1, 1.0)]

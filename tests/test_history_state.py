"""A1-A9 kept up to date: after any batches, replays and failures the histories equal a full recount."""

import random

import pytest
from pyspark.sql import functions as F

from waitcast.operators import history as H
from waitcast.sources import files as FS
from waitcast.streaming import histories as HS
from waitcast.streaming import ingest as X

SCHEMA = "atraccion string, mes int, hora_int int, dia_semana_num int, tiempo_espera double, sign int"


def readings(n, seed, rides):
    r = random.Random(seed)
    return [(r.choice(rides), r.choice([1, 2, None]), r.randint(9, 12), r.randint(0, 6), r.choice([None, 5.0, 10.0, 15.0, r.random()]), 1) for _ in range(n)]


def rows(df):
    # sums in another order differ in their last digits
    digits = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return sorted(map(str, df.select(sorted(df.columns)).select(*[d for _, d in sorted(zip(df.columns, digits))]).collect()))


def same(spark, path, counted):
    assert rows(HS.read_histories(spark, path)) == rows(H.all_histories(spark.createDataFrame(counted, SCHEMA)))


def test_batches_replays_and_a_failure_between_the_commits(spark, monkeypatch):
    state = HS.HistoryState(FS.staging_dir(spark, "t-histories"), buckets=5)
    with pytest.raises(FileNotFoundError):
        HS.read_histories(spark, state.path)
    one, two = readings(200, 1, ["a", "b", "c", None]), readings(60, 2, ["b", "d"])
    state(spark.createDataFrame(one, SCHEMA), 0)
    same(spark, state.path, one)
    with monkeypatch.context() as m:
        m.setattr(state, "_derive", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            state(spark.createDataFrame(two, SCHEMA), 1)
    same(spark, state.path, one)
    state(spark.createDataFrame(two, SCHEMA), 1)
    same(spark, state.path, one + two)
    state(spark.createDataFrame(two, SCHEMA), 1)
    same(spark, state.path, one + two)
    # parts of rides that the batch did not hold keep their version
    held = X.last_commit(spark, f"{state.path}/histories").held
    assert 0 in held.values() and held[HS.ALL] == 1
    state(spark.createDataFrame([], SCHEMA), 2)
    same(spark, state.path, one + two)
    with pytest.raises(ValueError):
        HS.HistoryState(state.path, buckets=6)(spark.createDataFrame(two, SCHEMA), 3)


def test_readings_taken_back(spark):
    state = HS.HistoryState(FS.staging_dir(spark, "t-histories"), buckets=3, sign="sign")
    one = readings(80, 3, ["a", "b"])
    state(spark.createDataFrame(one, SCHEMA), 0)
    back = [(*r[:5], -1) for r in one if r[0] == "a"] + readings(10, 4, ["b"])
    state(spark.createDataFrame(back, SCHEMA), 1)
    same(spark, state.path, [r for r in one if r[0] == "b"] + readings(10, 4, ["b"]))


def test_a_stream(spark):
    path = FS.staging_dir(spark, "t-histories")
    batches = [readings(40, 5, ["a", "b"]), readings(40, 6, ["c"])]
    for i, b in enumerate(batches):
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.parquet(f"{path}/in/{i}")
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    X.run_available_now(stream, HS.HistoryState(f"{path}/state"), f"{path}/checkpoint")
    same(spark, f"{path}/state", batches[0] + batches[1])

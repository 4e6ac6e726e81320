"""Histories of whole rides at once against those by window."""

import math
import random

import pyarrow as pa
from pyspark.sql import functions as F

from waitcast.operators import history as H
from waitcast.operators import ride_histories as R

SCHEMA = "atraccion string, mes int, hora_int int, dia_semana_num int, tiempo_espera double"
GRAINS = [g for g in H.CASCADE_GRAINS if g != "global"]


def _rows(n=6000):
    r = random.Random(11)
    rides = ["a", "b", "", None, "ride of many"]
    rows = [(r.choices(rides, [1, 2, 1, 1, 6])[0], r.choice([1, 2, 12, None]), r.choice([8, 9, None]), r.randint(0, 6),
             r.choice([5.0, 5.0, -0.0, 0.0, 1e6 + r.random(), r.gauss(20, 9), None])) for _ in range(n)]
    return rows + [("nan", 1, 8, 0, float("nan")), ("nan", 1, 8, 0, 4.0), ("one", 1, 8, 0, 7.0)]


def _flat(df):
    keys = ["grain", *H.KEYS]
    return {tuple(r[k] for k in keys): tuple(None if r[c] is None else "nan" if math.isnan(r[c]) else round(r[c], 6) for c in df.columns if c not in keys)
            for r in df.collect()}


def test_equal_to_those_by_window(spark):
    pre = H.precount(spark.createDataFrame(_rows(), SCHEMA).repartition(7), H.KEYS)
    want = H._histories_by_window(pre, GRAINS, H.WAIT)
    got = H.histories_from_counts(pre, GRAINS)
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert _flat(got) == _flat(want) and got.count() == want.count()
    some = H.histories_from_counts(pre, GRAINS, ride_rows=500)  # a large ride beside small ones
    assert _flat(some) == _flat(want) and some.count() == want.count()
    assert H.histories_from_counts(pre.limit(0), GRAINS).count() == 0


def test_counts_are_not_copied_for_each_grain(spark):
    df = spark.createDataFrame(_rows(400), SCHEMA)
    plan = H.all_histories(df, GRAINS)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "Window" not in plan


def test_whole_numbers(spark):
    df = spark.createDataFrame(_rows(), SCHEMA).where("NOT isnan(tiempo_espera) AND tiempo_espera < 1000")
    pre = H.precount(df.withColumn("tiempo_espera", F.col("tiempo_espera").cast("int")), H.KEYS)
    assert _flat(H.histories_from_counts(pre, GRAINS)) == _flat(H._histories_by_window(pre, GRAINS, H.WAIT))


def test_tables_end_between_rides():
    rides = sorted(random.Random(2).choices(range(40), [30, *[1] * 39], k=2000))
    batches = [pa.record_batch({"_ride": rides[i:i + 70]}) for i in range(0, 2000, 70)]
    tables = [t.column("_ride").to_pylist() for t in R.whole_rides(iter(batches), 150)]
    assert sum(tables, []) == rides and len(tables) > 5
    assert all(a[-1] != b[0] for a, b in zip(tables, tables[1:]))

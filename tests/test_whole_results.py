"""No row and no value is lost: NULL keys, NULL sequences, clashing names, line breaks, second runs."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from waitcast.functions import calendar as cal
from waitcast.operators import dedup as D
from waitcast.operators import encode as E
from waitcast.operators import explore as X
from waitcast.operators import history as H
from waitcast.operators import metrics as M
from waitcast.operators import model as MD
from waitcast.operators.quantiles import exact_percentiles
from waitcast.sources import files as FS
from waitcast.sources import nested as N
from waitcast.streaming import ingest as I


def test_keep_first_and_last_with_null_sequences(spark):
    rows = [("a", None, 5.0), ("b", 1, 1.0), ("b", None, 2.0), ("b", 3, 3.0)]
    df = spark.createDataFrame(rows, "k string, seq int, w double")
    assert {(r.k, r.w) for r in D.keep_last(df, ["k"], ["seq"]).collect()} == {("a", 5.0), ("b", 3.0)}
    assert {(r.k, r.w) for r in D.keep_first(df, ["k"], ["seq"]).collect()} == {("a", 5.0), ("b", 1.0)}


@pytest.mark.parametrize("prefer", ["seq", "arrival"])
def test_merge_keeps_rows_without_a_date(spark, prefer):
    schema = "fecha date, k string, seq int, w double"
    day = dt.date(2025, 1, 1)
    sink = I.CuratedMerge(FS.staging_dir(spark, "t-null-date"), ["fecha", "k"], "seq", prefer=prefer)
    sink(spark.createDataFrame([(day, "a", 1, 1.0), (None, "b", 1, 2.0)], schema), 0)
    sink(spark.createDataFrame([(day, "c", 2, 3.0), (None, "d", 2, 4.0)], schema), 1)
    sink(spark.createDataFrame([(day, "c", 2, 9.0)], schema), 1)                       # a replayed batch does nothing
    assert sorted(r.w for r in I.read_curated(spark, sink.path).collect()) == [1.0, 2.0, 3.0, 4.0]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_stratified_split_keeps_null_strata(spark):
    df = spark.createDataFrame([(i, "s" if i % 2 else None) for i in range(200)], "id long, s string")
    got = E.stratified_split(df, "id", ["s"], 0.8, buckets=16)
    assert got.count() == 200
    assert {(r.s, r.n) for r in got.where("is_train").groupBy("s").agg(F.count("*").alias("n")).collect()} == {("s", 80), (None, 80)}


def test_one_hot_names_never_merge(spark):
    df = spark.createDataFrame([("a b",), ("a_b",), ("Éu",), ("u",), (None,)], "c string")
    got = E.one_hot(df, df, "c")
    ones = [c for c in got.columns if c != "c"]
    assert len(ones) == 4
    assert sorted(sum(r[c] for c in ones) for r in got.collect()) == [0, 1, 1, 1, 1]


def test_null_groups_in_summaries_and_balancing(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 3.0), (None, 100.0)], "k string, tiempo_espera double")
    assert {r.k: r.median for r in X.box_summary(df, ["k"]).collect()} == {"a": 1.5, None: 51.5}
    classes = spark.createDataFrame([(1, "x"), (2, "x"), (3, None)], "id long, clase string")
    assert {(r.clase, r.n) for r in MD.balance_classes(classes, "id").groupBy("clase").agg(F.count("*").alias("n")).collect()} == {("x", 2), (None, 2)}


def test_chart_series_over_line_breaks(spark):
    html = 'x "chart-1", [{"name": "R",\n "data": [["01/02/25 12:00", 5],\n ["01/02/25 12:05", 7]]}]\n, {"colors": []}'
    got = N.extract_chart_series(spark.createDataFrame([(html,)], "html string")).collect()
    assert sorted(r.minutos for r in got) == [5.0, 7.0]


def test_null_dates_have_no_names(spark):
    r = spark.createDataFrame([(None,)], "d date").select(cal.day_name("d", "es").alias("day"), cal.month_name("d", "es").alias("month")).first()
    assert (r.day, r.month) == (None, None)


def test_deviation_of_large_values(spark):
    df = spark.createDataFrame([("a", 1e9 + i) for i in (1, 2, 3, 4)], "atraccion string, tiempo_espera double")
    want = np.std([1, 2, 3, 4], ddof=1)
    assert H.history(df, ["atraccion"], ["std"]).first()["std"] == pytest.approx(want)
    assert H.global_stats(df).first()["std"] == pytest.approx(want)
    m = M.regression_metrics(df.select(F.col("tiempo_espera").alias("y"), (F.col("tiempo_espera") + 1).alias("pred"))).first()
    assert m.r2 == pytest.approx(1 - 4 / 5)


def test_exact_percentiles_over_value_ranges(spark):
    r = np.random.default_rng(1)
    rows = [(int(k), float(v)) for k, v in zip(r.integers(0, 3, 2000), np.concatenate([r.normal(0, 50, 1000), r.integers(0, 60, 1000)]))]
    rows += [(None, 1.5), (None, -2.0), (7, 1e9), (8, None)]
    counted = spark.createDataFrame(rows, "k int, v double").groupBy("k", "v").agg(F.count("*").alias("_n"))
    probs = [0.0, 0.005, 0.25, 0.5, 0.95, 1.0]
    got = {x.k: x._q for x in exact_percentiles(counted, ["k"], "v", probs).collect()}
    assert set(got) == {0, 1, 2, 7, None}
    for k, q in got.items():
        assert q == pytest.approx(np.percentile([v for x, v in rows if x == k and v is not None], [100 * p for p in probs]))
    assert exact_percentiles(counted, [], "v", probs).first()._q == pytest.approx(np.percentile([v for _, v in rows if v is not None], [100 * p for p in probs]))
    assert exact_percentiles(counted.limit(0), [], "v", probs).count() == 0


def test_global_percentiles_plan(spark):
    df = spark.range(1000).select(F.rand(1).alias("tiempo_espera"), *[F.lit(1).cast("int").alias(k) for k in ("mes", "hora_int", "dia_semana_num")],
                                  F.lit("r").alias("atraccion"))
    plan = H.global_stats(df)._jdf.queryExecution().toString()
    assert "percentile(" not in plan
    assert [r.n for r in H.all_histories(df).where("grain = 'global'").collect()] == [1000]


def test_fitting_again_fits_again(spark):
    from waitcast.plans import training as TR
    fit = lambda shift: TR.fitted_gbt(spark, spark.createDataFrame([(float(i), shift + i) for i in range(20)], "x double, tiempo_espera double"),
                                      ["x"], "test_config")
    MD.GBT_CONFIGS["test_config"] = dict(maxIter=2, stepSize=0.5, maxDepth=2)
    try:
        probe = spark.createDataFrame([(3.0,)], "x double")
        first, second = (fit(s).transform(probe).first().pred_base for s in (0.0, 80.0))
    finally:
        del MD.GBT_CONFIGS["test_config"]
    assert first < 20 < 80 <= second

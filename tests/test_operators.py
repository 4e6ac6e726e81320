"""Operators on hand-made frames: cleaning (P*), dedup/merge (D*, U*), histories (A1-A9),
exploration and metrics; property checks against pandas/numpy brute force."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from waitcast.operators import clean as C
from waitcast.operators import dedup as D
from waitcast.operators import encode as E
from waitcast.operators import explore as X
from waitcast.operators import history as H
from waitcast.operators import metrics as M


def _readings(spark, n=400, seed=3, rides=6):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        d = dt.date(2024, rnd.randint(1, 12), rnd.randint(1, 28))
        rows.append((i, f"z{rnd.randint(0, 2)}", f"ride{rnd.randint(0, rides - 1)}", float(5 * rnd.randint(0, 24)),
                     d, rnd.randint(9, 21), d.month, d.weekday()))
    return spark.createDataFrame(rows, "row_id long, zona string, atraccion string, tiempo_espera double, "
                                       "fecha date, hora_int int, mes int, dia_semana_num int")


def test_exclude_zones_keeps_nulls_and_closed_zero_null_safe(spark):
    df = spark.createDataFrame([(1, "Halloween", 0.0, False), (2, None, 0.0, False), (3, "A", 0.0, None),
                                (4, "A", 0.0, False), (5, "A", 10.0, False)],
                               "row_id long, zona string, tiempo_espera double, abierta boolean")
    assert sorted(r.row_id for r in C.exclude_zones(df).collect()) == [2, 3, 4, 5]     # P3 keeps NULL zone
    assert sorted(r.row_id for r in C.drop_closed_zero(df).collect()) == [3, 5]  # P4: NULL flag kept


def test_quantile_trim_inclusive_matches_numpy(spark):
    df = _readings(spark)
    pdf = df.toPandas()
    lo, hi = np.percentile(pdf.tiempo_espera, [1, 99])
    exp = set(pdf[(pdf.tiempo_espera >= lo) & (pdf.tiempo_espera <= hi)].row_id)
    assert {r.row_id for r in C.quantile_trim(df, lo=0.01, hi=0.99).collect()} == exp


def test_degenerate_columns_and_validation(spark):
    df = spark.createDataFrame([(1, None, 5, "x"), (2, None, 5, None)], "a long, b string, c int, d string")
    rep = {r.column_name: (r.all_null, r.constant) for r in C.degenerate_columns(df).collect()}
    assert rep == {"a": (False, False), "b": (True, False), "c": (False, True), "d": (False, True)}
    assert C.drop_degenerate(df).columns == ["a"]
    req = spark.createDataFrame([("2025-10-25", "", "r", None)], "fecha string, hora string, atraccion string, zona string")
    r = C.validate_requests(req).collect()[0]
    assert r.missing == ["hora", "zona"] and r.valid is False


def test_keep_first_last_match_pandas_and_are_idempotent(spark):
    df = _readings(spark, n=600, rides=3)
    keys = ["fecha", "hora_int", "atraccion"]
    pdf = df.toPandas().sort_values("row_id")
    for last, fn in [(False, D.keep_first), (True, D.keep_last)]:
        exp = set(pdf.drop_duplicates(subset=keys, keep="last" if last else "first").row_id)
        once = fn(df, keys, ["row_id"])
        assert {r.row_id for r in once.collect()} == exp
        assert {r.row_id for r in fn(once, keys, ["row_id"]).collect()} == exp   # idempotent


def test_precedence_merge_new_wins(spark):
    a = spark.createDataFrame([(1, "d", 10.0), (2, "e", 20.0)], "row_id long, k string, v double")
    b = spark.createDataFrame([(0, "d", 11.0)], "row_id long, k string, v double")
    c = spark.createDataFrame([(0, "e", 30.0), (1, "e", 31.0)], "row_id long, k string, v double")
    got = {r.k: r.v for r in D.precedence_merge([a, b, c], ["k"]).collect()}
    assert got == {"d": 11.0, "e": 31.0}


def test_duplicate_members_and_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, "b"), (3, "c"), (3, "c")], "x int, y string")
    assert sorted(tuple(r) for r in D.exact_duplicate_members(df).collect()) == [(1, "a")] * 3 + [(3, "c")] * 2
    assert D.exact_duplicate_count(df).collect()[0][0] == 3
    assert {(r.x, r.n) for r in D.exact_duplicate_groups(df).collect()} == {(1, 3), (3, 2)}


def _np_stats(v):
    v = np.asarray(v, dtype=float)
    return {"count": len(v), "mean": v.mean(), "median": np.percentile(v, 50),
            "std": v.std(ddof=1) if len(v) > 1 else None, "p25": np.percentile(v, 25),
            "p75": np.percentile(v, 75), "p90": np.percentile(v, 90), "p95": np.percentile(v, 95)}


@pytest.mark.parametrize("grain", list(H.GRAINS))
def test_grain_history_matches_numpy(spark, grain):
    df = _readings(spark)
    keys, stats = H.GRAINS[grain]
    got = {tuple(r[k] for k in keys): r for r in H.grain_history(df, grain).collect()}
    pdf = df.toPandas()
    for key, g in pdf.groupby(keys):
        exp = _np_stats(g.tiempo_espera)
        row = got[tuple(key)]
        for st in stats:
            e, o = exp[st], row[f"{st}_{grain}"]
            assert (o is None) if e is None else o == pytest.approx(e), (grain, key, st)


def test_one_pass_equals_direct_and_counts_sum(spark):
    df = _readings(spark, n=500)
    allh = H.all_histories(df)
    total = df.count()
    for grain, keys in H.CASCADE_GRAINS.items():
        sl = allh.where(F.col("grain") == grain)
        assert sl.agg(F.sum("n")).collect()[0][0] == total, grain          # n sums to rows at every grain
        if keys:
            direct = H.history(df, keys, ["count", "median", "p75", "p90", "std"])
            d = {tuple(r[k] for k in keys): r for r in direct.collect()}
            for r in sl.collect():
                x = d[tuple(r[k] for k in keys)]
                assert r.n == x["count"] and r.p50 == pytest.approx(x["median"]) and r.p75 == pytest.approx(x["p75"])
                assert r.p90 == pytest.approx(x["p90"])


def test_one_pass_null_key_is_not_a_rollup(spark):
    df = spark.createDataFrame([("r", None, 10, 1, 5.0), ("r", 3, 10, 1, 15.0)],
                               "atraccion string, mes int, hora_int int, dia_semana_num int, tiempo_espera double")
    h = H.all_histories(df)
    mh = h.where("grain = 'mes_hora'").collect()
    assert sorted((r.mes, r.n) for r in mh if r.mes is not None) == [(3, 1)]
    assert any(r.mes is None and r.n == 1 for r in mh)                   # NULL month kept as its own key
    assert h.where("grain = 'hora'").collect()[0].n == 2


def test_stratified_split_exact_share(spark):
    df = _readings(spark, n=700)
    out = E.stratified_split(df, "row_id", ["mes"], 0.8, buckets=16).toPandas()
    for _, g in out.groupby("mes"):
        assert g.is_train.sum() == int(np.ceil(0.8 * len(g)))


def test_target_encoding_smoothing_and_fallback(spark):
    tr = spark.createDataFrame([("a", 10.0), ("a", 20.0), ("b", 40.0)], "c string, tiempo_espera double")
    te = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    g = (10 + 20 + 40) / 3
    r = {x.c: x.c_enc for x in E.target_mean_encoding(te, tr, "c", smoothing=10).collect()}
    assert r["a"] == pytest.approx((2 * 15 + 10 * g) / 12)
    assert r["z"] == pytest.approx(g) and r[None] == pytest.approx(g)


def test_metrics_match_numpy(spark):
    rnd = random.Random(1)
    rows = [(float(5 * rnd.randint(0, 20)), rnd.uniform(0, 100)) for _ in range(300)]
    df = spark.createDataFrame(rows, "y double, pred double")
    r = M.regression_metrics(df).collect()[0]
    y, p = np.array([a for a, _ in rows]), np.array([b for _, b in rows])
    assert r.mae == pytest.approx(np.mean(np.abs(y - p)))
    assert r.rmse == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert r.r2 == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))
    assert r.within_20pct == pytest.approx(np.mean(np.abs((y - p) / np.maximum(y, 1)) <= 0.2) * 100)


def test_classification_metrics_by_hand(spark):
    pairs = [("A", "A")] * 5 + [("A", "B")] * 2 + [("B", "B")] * 3 + [("B", "C")] * 1 + [("C", "A")] * 1
    df = spark.createDataFrame(pairs, "a string, p string")
    conf = M.confusion(df, F.col("a"), F.col("p"))
    r = M.classification_metrics(conf).collect()[0]
    n = len(pairs)
    prec = {"A": 5 / 6, "B": 3 / 5, "C": 0.0}
    rec = {"A": 5 / 7, "B": 3 / 4, "C": 0.0}
    f1 = {k: (2 * prec[k] * rec[k] / (prec[k] + rec[k]) if prec[k] + rec[k] else 0.0) for k in prec}
    po = 8 / n
    pe = (7 * 6 + 4 * 5 + 1 * 1) / n ** 2
    assert r.accuracy == pytest.approx(po)
    assert r.macro_precision == pytest.approx(np.mean(list(prec.values())))
    assert r.macro_recall == pytest.approx(np.mean(list(rec.values())))
    assert r.macro_f1 == pytest.approx(np.mean(list(f1.values())))
    assert r.kappa == pytest.approx((po - pe) / (1 - pe))


def test_box_summary_and_histogram(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 100.0]
    df = spark.createDataFrame([(v,) for v in vals], "tiempo_espera double")
    b = X.box_summary(df).collect()[0]
    q1, q3 = np.percentile(vals, [25, 75])
    assert (b.q1, b.q3, b.whisker_hi, b.n_outliers) == (q1, q3, 8.0, 1)
    h = X.histogram(df, "tiempo_espera", 4).collect()
    counts, _ = np.histogram(vals, bins=4)
    assert sorted((r.bin, r.n) for r in h) == [(i, int(c)) for i, c in enumerate(counts) if c]


def test_correlation_pairs_matches_pandas(spark):
    df = _readings(spark)
    got = {(r.col_a, r.col_b): r.corr for r in X.correlation_pairs(df, ["tiempo_espera", "hora_int", "mes"]).collect()}
    pdf = df.toPandas()[["tiempo_espera", "hora_int", "mes"]].astype(float).corr()
    assert got[("tiempo_espera", "hora_int")] == pytest.approx(pdf.loc["tiempo_espera", "hora_int"])
    assert got[("hora_int", "mes")] == pytest.approx(pdf.loc["hora_int", "mes"])


def test_balance_classes_reaches_majority(spark):
    rows = [(i, "Corto") for i in range(100)] + [(100 + i, "Largo") for i in range(25)]
    df = spark.createDataFrame(rows, "row_id long, clase string")
    out = {r.clase: r.n for r in E_bal(df).groupBy("clase").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert out["Corto"] == 100 and out["Largo"] == 100


def E_bal(df):
    from waitcast.operators.model import balance_classes
    return balance_classes(df, "row_id")


def test_value_counts_and_null_counts(spark):
    df = spark.createDataFrame([("a", None), ("a", 1), ("b", None)], "x string, y int")
    assert [(r.x, r.n) for r in X.value_counts(df, "x").collect()] == [("a", 2), ("b", 1)]
    assert [(r.column_name, r.nulls) for r in X.null_counts(df).collect()] == [("y", 2), ("x", 0)]
    _ = pd  # pandas used by other helpers


def test_size_checked_join_falls_back_to_shuffle_join(spark):
    from waitcast.operators.joins import size_checked_join
    left = spark.range(0, 2000).withColumnRenamed("id", "k")
    right = spark.range(0, 500).withColumnRenamed("id", "k").withColumn("v", F.col("k") * 2)
    small = size_checked_join(left, right, "k", "left", n_rows=500)
    big = size_checked_join(left, right, "k", "left", n_rows=500, limit=10)   # too large for a 10-byte limit
    assert "broadcast" in small._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "broadcast" not in big._jdf.queryExecution().optimizedPlan().toString().lower()
    assert sorted(small.collect()) == sorted(big.collect())


def test_column_percentiles_match_numpy(spark):
    rnd = random.Random(5)
    rows = [(float(rnd.randint(0, 30)), rnd.choice([None, float(rnd.randint(-5, 5))])) for _ in range(500)]
    df = spark.createDataFrame(rows, "a double, b double")
    r = H.column_percentiles(df, ["a", "b"], [0.25, 0.5, 0.9]).collect()[0]
    a = np.array([x for x, _ in rows])
    b = np.array([y for _, y in rows if y is not None])
    for i, q in enumerate([25, 50, 90]):
        assert r[f"a__{i}"] == pytest.approx(np.percentile(a, q))
        assert r[f"b__{i}"] == pytest.approx(np.percentile(b, q))


def test_weather_fill_only_where_missing(spark):
    from waitcast.operators.joins import fill_missing_weather, weather_keys_needed
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1), 10, None, 50.0, 1), (2, dt.date(2024, 1, 1), 10, 20.0, None, 2),
                                (3, dt.date(2024, 1, 2), 11, None, None, None)],
                               "row_id long, fecha date, hora_int int, temperatura double, humedad double, codigo_clima int")
    w = spark.createDataFrame([(dt.date(2024, 1, 1), 10, 5.0, 90.0, 4)],
                              "fecha date, hora_int int, temperatura double, humedad double, codigo_clima int")
    got = {r.row_id: (r.temperatura, r.humedad, r.codigo_clima) for r in fill_missing_weather(df, w).collect()}
    assert got == {1: (5.0, 90.0, 4), 2: (20.0, None, 2), 3: (None, None, None)}   # all columns move together
    assert [(r.fecha, r.hora_int) for r in weather_keys_needed(df, w).collect()] == [(dt.date(2024, 1, 2), 11)]


def test_hot_ride_holding_a_third_of_rows(spark):
    """One ride with a third of all rows: one-pass histories, keep-last and the exact
    stratified split still match pandas / exact counts."""
    rnd = random.Random(11)
    rows = []
    for i in range(1500):
        ride = "hot" if i % 3 == 0 else f"r{rnd.randint(0, 20)}"
        d = dt.date(2024, rnd.randint(1, 12), rnd.randint(1, 28))
        rows.append((i, ride, float(5 * rnd.randint(0, 30)), d, rnd.randint(9, 21), d.month, d.weekday()))
    df = spark.createDataFrame(rows, "row_id long, atraccion string, tiempo_espera double, fecha date, hora_int int, "
                                     "mes int, dia_semana_num int")
    pdf = df.toPandas()
    allh = {(r.grain, r.atraccion, r.mes, r.hora_int, r.dia_semana_num): r for r in H.all_histories(df).collect()}
    hot = pdf[pdf.atraccion == "hot"].tiempo_espera
    r = allh[("atraccion", "hot", None, None, None)]
    assert r.n == len(hot) and r.p75 == pytest.approx(np.percentile(hot, 75)) and r.std == pytest.approx(hot.std())
    for (m, h), g in pdf[pdf.atraccion == "hot"].groupby(["mes", "hora_int"]):
        x = allh[("mes_hora", "hot", m, h, None)]
        assert x.n == len(g) and x.p50 == pytest.approx(np.percentile(g.tiempo_espera, 50))
    keys = ["atraccion", "fecha"]
    exp = set(pdf.sort_values("row_id").drop_duplicates(subset=keys, keep="last").row_id)
    assert {x.row_id for x in D.keep_last(df, keys, ["row_id"]).collect()} == exp
    split = E.stratified_split(df, "row_id", ["atraccion"], 0.8, buckets=64).toPandas()
    for _, g in split.groupby("atraccion"):
        assert g.is_train.sum() == int(np.ceil(0.8 * len(g)))


def test_one_pass_approx_close_to_exact(spark):
    """The approximate form returns actual elements (inverted-CDF quantiles), counts and
    means are exact."""
    df = _readings(spark, n=800)
    ex = {(r.grain, r.atraccion, r.mes, r.hora_int, r.dia_semana_num): r for r in H.all_histories(df).collect()}
    ap = {(r.grain, r.atraccion, r.mes, r.hora_int, r.dia_semana_num): r for r in
          H.all_histories(df, exact=False).collect()}
    assert ex.keys() == ap.keys()
    for k, r in ex.items():
        assert ap[k].n == r.n and ap[k].mean == pytest.approx(r.mean)
    pdf = df.toPandas()
    for ride, g in pdf.groupby("atraccion"):
        a = ap[("atraccion", ride, None, None, None)]
        for col, q in [("p25", 25), ("p50", 50), ("p90", 90)]:
            assert a[col] == np.percentile(g.tiempo_espera, q, method="inverted_cdf"), (ride, col)

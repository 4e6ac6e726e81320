"""Nested sources (S4, S6, S7), file scans (S1-S3, S12) and streaming (X1-X3, X6) vs batch."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF_SMALL
from waitcast.operators import dedup as D
from waitcast.sources import files as FS
from waitcast.sources import nested as N
from waitcast.streaming import ingest as X


def test_flatten_feed_edge_cases(spark):
    docs = [
        {"lands": [{"name": "Z1", "rides": [{"name": "A", "is_open": True, "wait_time": 20, "last_updated": "2025-10-30T15:25:08"},
                                            {"name": "B", "is_open": False, "wait_time": 0, "last_updated": "x"},
                                            {"name": "C", "is_open": None, "wait_time": 5}]},
                   {"name": "Z2", "rides": []}]},
        {},                                   # no lands
        {"lands": [{"name": "Z3"}]},          # no rides
    ]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "payload string")
    out = N.flatten_feed(df).collect()
    assert [(r.zona, r.atraccion, r.tiempo_espera) for r in out] == [("Z1", "A", 20.0)]
    assert out[0].ultima_actualizacion == dt.datetime(2025, 10, 30, 15, 25, 8)
    assert N.flatten_feed(df, open_only=False).count() == 3


def test_flatten_weather_uneven_arrays(spark):
    doc = {"hourly": {"time": ["2025-10-30T16:00", "2025-10-30T17:00", "2025-10-30T18:00"],
                      "temperature_2m": [17.6, 16.0], "relative_humidity_2m": [68, 70, None],
                      "apparent_temperature": [16.4, 15.0, 14.0], "weathercode": [2, 3, 61]}}
    df = spark.createDataFrame([(json.dumps(doc),)], "payload string")
    rows = N.flatten_weather(df).orderBy("hora_int").collect()
    assert [r.hora_int for r in rows] == [16, 17, 18]
    assert rows[2].temperatura is None and rows[2].humedad is None and rows[2].codigo_clima == 61


def test_chart_extraction_and_window(spark):
    series = [{"name": "Reported by users", "data": []},
              {"name": "Reported by park", "data": [["11/09/25 12:10:00", "15.0"], ["11/09/25 19:30:00", "20.0"],
                                                    ["11/09/25 19:35:00", "25.0"], ["bad", "1"]]},
              {"name": "Closed", "data": [["11/09/25 08:00:00", "0.0"], ["11/09/25 13:00:00", "0.0"]]}]
    html = f'<script>new Chartkick.LineChart("chart-1", {json.dumps(series)}, {{"colors": ["#111"]}});</script>'
    pages = spark.createDataFrame([(1, html), (2, "<html>no chart here</html>")], "page_id long, html string")
    pts = N.extract_chart_series(pages)
    assert pts.count() == 6
    counts = {r.series: r.n_points for r in N.points_in_window(pts, ["page_id"]).collect()}
    assert counts == {"Reported by park": 2, "Closed": 1}       # 12:00-19:30 inclusive, bad text excluded


def test_csv_roundtrip_and_missing_path(spark):
    root = FS.staging_dir(spark, "t-csv")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType()),
                           T.StructField("d", T.DateType())])
    df = spark.createDataFrame([(1, 2.5, dt.date(2024, 1, 1)), (2, None, None)], schema)
    FS.write_csv(df, root)
    assert sorted(FS.read_csv(spark, root, schema).collect()) == sorted(df.collect())
    with pytest.raises(FileNotFoundError):
        FS.read_csv(spark, root + "-nope/*.csv", schema)
    empty = FS.load_artifact(spark, root, "not-there", schema)
    assert empty.count() == 0 and empty.schema == schema


def test_tolerant_scan_aligns_and_skips(spark):
    a, b, bad = (FS.staging_dir(spark, n) for n in ("ta", "tb", "tbad"))
    FS.write_csv(spark.createDataFrame([("12:00", "R", "Z", "2024-01-02", "15")], "hora string, atraccion string, "
                                       "zona string, fecha string, tiempo_espera string"), a)
    FS.write_csv(spark.createDataFrame([("Z2", "R2", "oops", "21.5")], "zona string, atraccion string, "
                                       "tiempo_espera string, temperatura string"), b)
    FS.write_csv(spark.createDataFrame([("x",)], "zona string"), bad)
    out = FS.tolerant_scan(spark, [a, b, bad, "/nonexistent/path"]).orderBy("zona").collect()
    assert [(r.zona, r.tiempo_espera, r.temperatura, r.fecha) for r in out] == [
        ("Z", 15.0, None, dt.date(2024, 1, 2)), ("Z2", None, 21.5, None)]


EV = "row_id long, zona string, atraccion string, tiempo_espera double, fecha date, hora_int int, ts timestamp"


def test_stream_merge_equals_batch_keep_last(spark):
    src = FS.staging_dir(spark, "t-stream")
    base = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.col("event_id").alias("row_id"), F.col("event_type").alias("zona"),
        F.concat("event_type", F.lit("_"), (F.col("user_id") % 3).cast("string")).alias("atraccion"),
        F.col("value").alias("tiempo_espera"), F.to_date("ts").alias("fecha"), F.hour("ts").alias("hora_int"),
        F.col("ts").cast("timestamp").alias("ts"))
    base.repartition(5).write.json(src)
    out = FS.staging_dir(spark, "t-curated")
    stream = X.read_stream(spark, src, T._parse_datatype_string(EV), "json", max_files_per_trigger=2)
    X.run_available_now(stream, X.CuratedMerge(out, ["fecha", "hora_int", "atraccion"], "row_id"),
                        FS.staging_dir(spark, "t-ckpt"))
    got = sorted(r.row_id for r in X.read_curated(spark, out).collect())
    exp = sorted(r.row_id for r in D.keep_last(base, ["fecha", "hora_int", "atraccion"], ["row_id"]).collect())
    assert got == exp


def test_tick_rollup_equals_batch(spark):
    src = FS.staging_dir(spark, "t-roll")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.col("event_type").alias("atraccion"), F.col("value").alias("tiempo_espera"), F.col("ts").cast("timestamp"))
    ev.repartition(3).write.json(src)
    stream = spark.readStream.schema("atraccion string, tiempo_espera double, ts timestamp").json(src)
    roll = X.tick_rollup(stream, "ts", delay="40 days").select(F.col("tick.start").alias("t"), "atraccion", "n")
    log = FS.staging_dir(spark, "t-log")
    X.run_available_now(roll, X.AppendLog(log), FS.staging_dir(spark, "t-ckpt"), output_mode="update")
    got = {(r.t, r.atraccion): r.n for r in X.latest_per_key(spark.read.parquet(log), ["t", "atraccion"]).collect()}
    exp = {(r.t, r.atraccion): r.n for r in ev.groupBy(F.window("ts", "15 minutes").start.alias("t"), "atraccion")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == exp


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10 and df.columns == ["atraccion", "n", "mean_wait", "peak_share", "weekend_share",
                                                   "mean_hist_p75"]
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs) and len(qs) >= 150
    from waitcast.plans import catalog
    assert not any(k.lower().startswith("op") for k in catalog.QUERIES)   # those are the training-data queries
    assert os.path.exists(SF_SMALL)


def test_curated_merge_replay_and_precedence(spark):
    schema = "row_id long, fecha date, hora string, atraccion string, tiempo_espera double"
    b0 = spark.createDataFrame([(5, dt.date(2024, 1, 1), "10:00", "R", 10.0), (1, dt.date(2024, 2, 1), "10:00", "R", 1.0)], schema)
    b1 = spark.createDataFrame([(3, dt.date(2024, 1, 1), "10:00", "R", 30.0)], schema)
    for prefer, expect in [("seq", 10.0), ("arrival", 30.0)]:
        out = FS.staging_dir(spark, "t-merge")
        sink = X.CuratedMerge(out, ["fecha", "hora", "atraccion"], "row_id", prefer=prefer)
        sink(b0, 0)
        sink(b1, 1)
        sink(b1.withColumn("tiempo_espera", F.lit(99.0)), 1)     # replayed batch id: ignored
        got = {r.fecha: r.tiempo_espera for r in X.read_curated(spark, out).collect()}
        assert got == {dt.date(2024, 1, 1): expect, dt.date(2024, 2, 1): 1.0}, prefer

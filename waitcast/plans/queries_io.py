"""File source/sink round trips and streaming queries.

Every query stages its input by writing the driver-table readings into a
fresh folder under ``spark.checkpoint.dir`` (shared storage on a cluster),
runs the job over those files, and returns what the job produced.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitcast.operators import joins as J
from waitcast.functions import calendar as cal
from waitcast.functions.hours import parse_hour
from waitcast.operators import history as H
from waitcast.operators import metrics as M
from waitcast.plans.catalog import query, rounded
from waitcast.plans.features import basic_calendar
from waitcast.plans.queries_explore import predictions
from waitcast.plans.queries_history import history_sql
from waitcast.sources import files as FS
from waitcast.sources import tables as tb
from waitcast.streaming import ingest as X

ORDERS_CSV_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()), T.StructField("zona", T.StringType()),
    T.StructField("atraccion", T.StringType()), T.StructField("tiempo_espera", T.DoubleType()),
    T.StructField("fecha", T.DateType()), T.StructField("hora", T.StringType()),
    T.StructField("temperatura", T.DoubleType()), T.StructField("humedad", T.DoubleType()),
    T.StructField("codigo_clima", T.IntegerType()), T.StructField("abierta", T.BooleanType()),
])
_RO_COLS = "row_id, zona, atraccion, tiempo_espera, fecha, hora, temperatura, humedad, codigo_clima, abierta"


@query("s1_s8_csv_roundtrip", f"select {_RO_COLS} from @RO")
def s1(spark, sf):
    """S8 CSV sink of the orders readings, then S1/S2 scan of the folder (glob) with an
    explicit schema."""
    path = FS.staging_dir(spark, "csv")
    FS.write_csv(tb.readings_orders(spark, sf).select(*[f.name for f in ORDERS_CSV_SCHEMA.fields]), path)
    return FS.read_csv(spark, f"{path}/*.csv", ORDERS_CSV_SCHEMA)


@query("s13_qualified_path", f"select {_RO_COLS} from @RO")
def s13(spark, sf):
    """Two folders below a path with a scheme and a space, as of an object store, read by one glob."""
    path = FS.staging_dir(spark, "store")
    uri = path if ":/" in path else f"file://{path}"
    rows = tb.readings_orders(spark, sf)
    for name, part in (("a", rows.where("row_id % 2 = 0")), ("b", rows.where("row_id % 2 = 1"))):
        FS.write_csv(part.select(*[f.name for f in ORDERS_CSV_SCHEMA.fields]), f"{uri}/raw 2025/{name}")
    return FS.read_csv(spark, f"{uri}/raw 2025/{{a,b}}/*.csv", ORDERS_CSV_SCHEMA)


@query("s3_tolerant_scan", """
select zona, atraccion, round(tiempo_espera, 6) tiempo_espera, abierta, cast(null as timestamp) ultima_actualizacion,
       fecha, hora, cast(null as varchar) dia_semana, cast(null as timestamp) "timestamp", cast(null as integer) mes,
       cast(null as boolean) fin_de_semana, cast(null as double) temperatura, cast(null as double) humedad,
       cast(null as double) sensacion_termica, cast(null as integer) codigo_clima from @RE
union all
select zona, atraccion, tiempo_espera, abierta, null, fecha, hora, null, null, null, null, temperatura, humedad, null,
       codigo_clima from @RO""")
def s3(spark, sf):
    """S3: files with different column sets and orders (events readings, orders readings),
    plus one file lacking the ride column (skipped) and a missing path (skipped)."""
    a = FS.staging_dir(spark, "csv-a")
    b = FS.staging_dir(spark, "csv-b")
    bad = FS.staging_dir(spark, "csv-bad")
    ev = tb.readings_events(spark, sf)
    FS.write_csv(ev.select("hora", "atraccion", "zona", "fecha", "tiempo_espera", "abierta"), a)
    FS.write_csv(tb.readings_orders(spark, sf).select("zona", "atraccion", "tiempo_espera", "fecha", "hora",
                                                      "temperatura", "humedad", "codigo_clima", "abierta"), b)
    FS.write_csv(ev.select("zona", "tiempo_espera"), bad)
    out = FS.tolerant_scan(spark, [a, b, bad, bad + "-missing"])
    return rounded(out)


@query("s9_parquet_partitioned", f"select {_RO_COLS}, year(fecha) anio, month(fecha) mes_p from @RO where month(fecha) = 10")
def s9(spark, sf):
    """CSV -> parquet partitioned by year/month; the October filter prunes partitions."""
    src = FS.staging_dir(spark, "csv-src")
    dst = FS.staging_dir(spark, "parquet")
    FS.write_csv(tb.readings_orders(spark, sf).select(*[f.name for f in ORDERS_CSV_SCHEMA.fields]), src)
    FS.csv_to_parquet(spark, f"{src}/*.csv", dst, ORDERS_CSV_SCHEMA)
    return spark.read.parquet(dst).where(F.col("mes_p") == 10)


_HIST_MES = H.GRAINS["mes"]


@query("s10_s12_artifacts", history_sql(_HIST_MES[0], _HIST_MES[1], "mes"))
def s10(spark, sf):
    """S10 save the six histories as parquet artifacts, S12 load them back (a missing
    artifact loads as an empty frame); returns the ride x month history."""
    root = FS.staging_dir(spark, "artifacts")
    r = basic_calendar(tb.readings_lineitem(spark, sf))
    hist = {f"hist_{g}": H.grain_history(r, g) for g in H.GRAINS}
    FS.save_artifacts(hist, root)
    missing = FS.load_artifact(spark, root, "hist_not_saved", hist["hist_mes"].schema)
    loaded = FS.load_artifact(spark, root, "hist_mes", hist["hist_mes"].schema)
    return rounded(loaded.unionByName(missing))


from waitcast.plans.catalog import ORACLES as _OR  # noqa: E402  (explore queries are registered first)


@query("s14_metrics_json", _OR["m14_regression_metrics"])
def s14(spark, sf):
    """Metrics record written as JSON and read back (JSON re-reads longs and doubles)."""
    path = FS.staging_dir(spark, "metrics")
    FS.write_json(rounded(M.regression_metrics(predictions(spark, sf))), path)
    return spark.read.json(path)


@query("s15_quality_report_csv", "select column_name, cast(nulls as varchar) nulls, cast(duplicates_removed as varchar) "
       "duplicates_removed from (" + _OR["a12_quality_report"] + ")")
def s15(spark, sf):
    """Quality report (all orders columns) written as CSV and read back as text."""
    from waitcast.operators.explore import quality_report
    path = FS.staging_dir(spark, "quality")
    FS.write_csv(quality_report(tb.readings_orders(spark, sf), ["zona", "fecha"]), path)
    return spark.read.option("header", True).csv(path)


# ---- streaming --------------------------------------------------------------

_EV_JSON = T.StructType([
    T.StructField("row_id", T.LongType()), T.StructField("zona", T.StringType()),
    T.StructField("atraccion", T.StringType()), T.StructField("tiempo_espera", T.DoubleType()),
    T.StructField("fecha", T.DateType()), T.StructField("hora_int", T.IntegerType()),
    T.StructField("abierta", T.BooleanType()), T.StructField("ts", T.TimestampType()),
    T.StructField("ultima_actualizacion", T.TimestampType()),
])


def _stage_events_stream(spark, sf):
    """Originals, then a later write of corrections (+1 minute, newer update time) for the
    second half of the month."""
    d = FS.staging_dir(spark, "stream-in")
    ev = tb.readings_events(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    ev = ev.select("row_id", "zona", "atraccion", "tiempo_espera", "fecha", "hora_int", "abierta", "ts",
                   F.col("ts").alias("ultima_actualizacion"))
    ev.repartition(4).write.mode("append").json(d)
    corr = (ev.where(F.col("fecha") >= F.lit("2024-01-16").cast("date"))
            .withColumns({"tiempo_espera": F.col("tiempo_espera") + 1,
                          "ultima_actualizacion": F.col("ts") + F.expr("INTERVAL 1 HOUR")}))
    corr.repartition(2).write.mode("append").json(d)
    return d


@query("x1_x3_stream_merge", """
with ev as (select row_id, zona, atraccion, tiempo_espera, fecha, hora_int, abierta, ts, ts ua from @RE),
u as (select * from ev union all
      select row_id, zona, atraccion, tiempo_espera + 1, fecha, hora_int, abierta, ts, ts + interval 1 hour
      from ev where fecha >= date '2024-01-16')
select row_id, zona, atraccion, round(tiempo_espera, 6) tiempo_espera, fecha, hora_int from u
qualify row_number() over (partition by fecha, hora_int, atraccion order by ua desc, row_id desc) = 1""")
def x3(spark, sf):
    """X1 file stream (AvailableNow, 2 files per micro-batch) -> X3 keep-last merge into a
    date-partitioned curated table inside foreachBatch; returns the curated table."""
    src = _stage_events_stream(spark, sf)
    out = FS.staging_dir(spark, "curated")
    stream = X.read_stream(spark, src, _EV_JSON, "json", max_files_per_trigger=2)
    sink = X.CuratedMerge(out, ["fecha", "hora_int", "atraccion"], ["ultima_actualizacion", "row_id"],
                          partition_format="yyyy-MM")        # a month of backfill per run
    X.run_available_now(stream, sink, FS.staging_dir(spark, "ckpt"))
    cur = X.read_curated(spark, out)
    return rounded(cur.select("row_id", "zona", "atraccion", "tiempo_espera", "fecha", "hora_int"))


@query("x2_stream_dedup_watermark", """
select distinct fecha, hora_int, atraccion from @RE""")
def x2(spark, sf):
    """Drop repeated (fecha, hora_int, atraccion) readings within a 1-hour watermark
    (keep-first, bounded state). All staged files (originals and later corrections) form one
    trigger, so nothing is late; which copy survives depends on arrival, so the check is on
    the surviving keys: each distinct key exactly once."""
    src = _stage_events_stream(spark, sf)
    out = FS.staging_dir(spark, "dedup")
    stream = X.read_stream(spark, src, _EV_JSON, "json")
    X.run_to_parquet(X.dedup_within_watermark(stream, ["fecha", "hora_int", "atraccion"], "ts"), out,
                     FS.staging_dir(spark, "ckpt"))
    return spark.read.parquet(out).select("fecha", "hora_int", "atraccion")


_X4_SQL = """
with o as (select row_id, zona, atraccion, tiempo_espera, fecha, hora, temperatura, humedad, codigo_clima, abierta,
                  cast(trunc(coalesce(case when instr(trim(hora), ':') > 0 then trunc(try_cast(split_part(trim(hora), ':', 1) as double))
                       + trunc(try_cast(split_part(trim(hora), ':', 2) as double)) / 60.0 else trunc(try_cast(trim(hora) as double)) end, 12.0)) as integer) hora_int
           from @RO),
c as (select * from o where not coalesce(zona in ('Halloween', 'Warner Beach'), false)
      and not coalesce(tiempo_espera = 0 and abierta = false, false) and zona is not null and trim(zona) <> ''),
w as (select w.*, cast(t.hh as integer) hora_int from @WD w, range(24) t(hh)),
e as (select c.row_id, c.zona, c.atraccion, c.tiempo_espera, c.fecha, c.hora,
             case when c.temperatura is null then w.temperatura else c.temperatura end temperatura,
             case when c.temperatura is null then w.humedad else c.humedad end humedad,
             case when c.temperatura is null then w.codigo_clima else c.codigo_clima end codigo_clima,
             dayname(c.fecha) dia_semana, month(c.fecha) mes, isodow(c.fecha) - 1 in (5, 6) fin_de_semana,
             SEASON temporada
      from c left join w on w.fecha = c.fecha and w.hora_int = c.hora_int)
select * from e qualify row_number() over (partition by fecha, hora, atraccion order by row_id desc) = 1"""


def _x4_sql():
    from waitcast.plans.queries_features import season_sql
    return _X4_SQL.replace("SEASON", season_sql("c", "month(c.fecha)"))


@query("x4_stream_stage_chain", _x4_sql())
def x4(spark, sf):
    """Per micro-batch clean (P3, P4, P10) -> enrich (day name, month, weekend) ->
    weather fill (J4 against a static table, X5) -> season (F7 c) -> keep-last merge (X3)."""
    d = FS.staging_dir(spark, "orders-in")
    tb.readings_orders(spark, sf).repartition(6).write.json(d)
    weather, n_weather = J.weather_table(tb.weather_hourly(spark, sf))

    def chain(batch):
        b = X.clean_batch(batch)
        b = b.withColumn("hora_int", parse_hour("hora", default=12.0).cast("int"))
        b = X.enrich_static(b, weather, n_rows=n_weather)
        b = b.withColumns({"dia_semana": cal.day_name("fecha"), "mes": F.month("fecha"),
                           "fin_de_semana": F.weekday("fecha").isin(5, 6),
                           "temporada": cal.season(F.month("fecha"), "c")})
        return b.drop("hora_int", "abierta")

    schema = T.StructType([f for f in ORDERS_CSV_SCHEMA.fields])
    out = FS.staging_dir(spark, "curated")
    stream = X.read_stream(spark, d, schema, "json", max_files_per_trigger=2)
    X.run_available_now(stream, X.CuratedMerge(out, ["fecha", "hora", "atraccion"], "row_id", chain,
                                               partition_format="yyyy-MM"),   # seven years of backfill
                        FS.staging_dir(spark, "ckpt"))
    return X.read_curated(spark, out)


@query("x5_stream_static_join", f"""
with o as (select *, cast(trunc(coalesce(case when instr(trim(hora), ':') > 0 then trunc(try_cast(split_part(trim(hora), ':', 1) as double))
                       + trunc(try_cast(split_part(trim(hora), ':', 2) as double)) / 60.0 else trunc(try_cast(trim(hora) as double)) end, 12.0)) as integer) hora_int
           from @RO),
w as (select w.*, cast(t.hh as integer) hora_int from @WD w, range(24) t(hh))
select o.row_id, case when o.temperatura is null then w.temperatura else o.temperatura end temperatura,
       case when o.temperatura is null then w.humedad else o.humedad end humedad,
       case when o.temperatura is null then w.codigo_clima else o.codigo_clima end codigo_clima
from o left join w on w.fecha = o.fecha and w.hora_int = o.hora_int""")
def x5(spark, sf):
    """Streaming readings left-joined with a static hourly weather table (fill only
    where missing), appended to parquet."""
    d = FS.staging_dir(spark, "orders-in")
    tb.readings_orders(spark, sf).repartition(4).write.json(d)
    stream = X.read_stream(spark, d, ORDERS_CSV_SCHEMA, "json", max_files_per_trigger=2)
    stream = stream.withColumn("hora_int", parse_hour("hora", default=12.0).cast("int"))
    enriched = X.enrich_static(stream, tb.weather_hourly(spark, sf)).select("row_id", "temperatura", "humedad",
                                                                            "codigo_clima")
    out = FS.staging_dir(spark, "x5")
    X.run_to_parquet(enriched, out, FS.staging_dir(spark, "ckpt"))
    return spark.read.parquet(out)


@query("x6_tick_rollup", """
select time_bucket(interval 15 minute, ts) tick_start, atraccion, count(*) n, round(avg(tiempo_espera), 6) mean_wait,
       round(max(tiempo_espera), 6) max_wait from @RE group by all""")
def x6(spark, sf):
    """15-minute tick rollup per ride with a 2-hour watermark over a file stream, update mode
    into an append log; the newest version of each (tick, ride) is the result. The backlog is taken
    as one micro-batch, so no row of it is late, in whatever order its files were written."""
    d = FS.staging_dir(spark, "events-in")
    ev = tb.readings_events(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    ev = ev.select("atraccion", "tiempo_espera", "ts")
    ev.write.json(d)
    schema = "atraccion string, tiempo_espera double, ts timestamp"
    stream = spark.readStream.schema(schema).json(d)   # the backlog, of any years, is one micro-batch
    roll = X.tick_rollup(stream, "ts", delay="2 hours").select(F.col("tick.start").alias("tick_start"), "atraccion",
                                                              "n", "mean_wait", "max_wait")
    log = FS.staging_dir(spark, "rollup")
    X.run_available_now(roll, X.AppendLog(log), FS.staging_dir(spark, "ckpt"), output_mode="update")
    return rounded(X.latest_per_key(spark.read.parquet(log), ["tick_start", "atraccion"]))

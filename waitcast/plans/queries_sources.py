"""Queries for nested sources and weather enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from waitcast.functions.hours import parse_hour
from waitcast.operators import clean as C
from waitcast.operators import joins as J
from waitcast.plans.catalog import query, rounded
from waitcast.sources import nested as N
from waitcast.sources import tables as tb

WH_SQL = "(select w.*, cast(t.hh as integer) hora_int from @WD w, range(24) t(hh))"
RO_HI_SQL = """(select *, cast(trunc(coalesce(case when instr(trim(hora), ':') > 0 then
      trunc(try_cast(split_part(trim(hora), ':', 1) as double)) + trunc(try_cast(split_part(trim(hora), ':', 2) as double)) / 60.0
      else trunc(try_cast(trim(hora) as double)) end, 12.0)) as integer) hora_int from @RO)"""


def _orders_hi(spark, sf):
    r = tb.readings_orders(spark, sf)
    return r.withColumn("hora_int", parse_hour("hora", default=12.0).cast("int"))


@query("s4_feed_flatten", """
with r as (select * from @RE),
l as (select date_trunc('hour', ts) captured_at, zona, atraccion, arg_max(abierta, ts) ab,
             arg_max(cast(trunc(tiempo_espera) as integer), ts) w, max(ts) mts from r group by all)
select captured_at, zona, atraccion, cast(w as double) tiempo_espera, ab abierta,
       date_trunc('second', mts) ultima_actualizacion, cast(captured_at as date) fecha,
       strftime(captured_at, '%H:%M') hora, dayname(captured_at) dia_semana from l where ab""")
def s4(spark, sf):
    """events -> hourly JSON feed snapshots -> flatten lands/rides, open rides only
    -> stamp capture date/hour/day (S5)."""
    snaps = N.build_feed_snapshots(tb.readings_events(spark, sf))
    return N.stamp_capture(N.flatten_feed(snaps))


@query("s6_weather_flatten", f"""
select fecha, hora_int, temperatura, cast(trunc(humedad) as double) humedad,
       sensacion_termica, codigo_clima from {WH_SQL}""")
def s6(spark, sf):
    """Hourly weather replies (parallel arrays, one per date) -> one row per hour."""
    replies = N.build_weather_replies(tb.weather_hourly(spark, sf))
    return rounded(N.flatten_weather(replies))


_BUCKETS_SQL = """with r as (select * from @RE),
b as (select atraccion, cast(ts as date) fecha, time_bucket(interval 5 minute, ts) b,
             arg_max(tiempo_espera, ts) v, arg_max(abierta, ts) ab from r group by all)"""


@query("s7_chart_extract", _BUCKETS_SQL + """
select atraccion, fecha, case when ab then 'Reported by park' else 'Closed' end series,
       strftime(b, '%m/%d/%y %H:%M:%S') ts_text, round(case when ab then v else 0.0 end, 6) minutos from b""")
def s7(spark, sf):
    """Day-chart pages (one per ride and day) -> chart-1 series -> points."""
    pages = N.build_chart_pages(tb.readings_events(spark, sf))
    return rounded(N.extract_chart_series(pages))


@query("p15_chart_time_window", _BUCKETS_SQL + """
select atraccion, fecha, case when ab then 'Reported by park' else 'Closed' end series,
       strftime(b, '%m/%d/%y %H:%M:%S') ts_text from b where strftime(b, '%H:%M') between '12:00' and '19:30'""")
def p15(spark, sf):
    pts = N.extract_chart_series(N.build_chart_pages(tb.readings_events(spark, sf)))
    return pts.where(N.in_chart_window(F.col("ts_text"))).select("atraccion", "fecha", "series", "ts_text")


@query("a27_points_in_window", _BUCKETS_SQL + """
select atraccion, fecha, case when ab then 'Reported by park' else 'Closed' end series, count(*) n_points
from b where strftime(b, '%H:%M') between '12:00' and '19:30' group by all""")
def a27(spark, sf):
    pts = N.extract_chart_series(N.build_chart_pages(tb.readings_events(spark, sf)))
    return N.points_in_window(pts, ["atraccion", "fecha"])


@query("j3_attach_weather", f"""
select r.row_id, r.fecha, r.hora_int, w.temperatura w_temperatura, w.humedad w_humedad, w.codigo_clima w_codigo, w.sensacion_termica w_sensacion
from {RO_HI_SQL} r left join {WH_SQL} w using (fecha, hora_int)""")
def j3(spark, sf):
    w = tb.weather_hourly(spark, sf).select("fecha", "hora_int", F.col("temperatura").alias("w_temperatura"),
                                            F.col("humedad").alias("w_humedad"), F.col("codigo_clima").alias("w_codigo"), F.col("sensacion_termica").alias("w_sensacion"))
    return J.attach_weather(_orders_hi(spark, sf).select("row_id", "fecha", "hora_int"), w)


@query("j4_fill_missing_weather", f"""
select r.row_id, case when r.temperatura is null then w.temperatura else r.temperatura end temperatura,
       case when r.temperatura is null then w.humedad else r.humedad end humedad,
       case when r.temperatura is null then w.codigo_clima else r.codigo_clima end codigo_clima,
       case when r.temperatura is null then w.sensacion_termica else r.temperatura - 1 end sensacion_termica
from {RO_HI_SQL} r left join {WH_SQL} w using (fecha, hora_int)""")
def j4(spark, sf):
    r = _orders_hi(spark, sf).select("row_id", "fecha", "hora_int", "temperatura", "humedad", "codigo_clima")
    r = r.withColumn("sensacion_termica", F.col("temperatura") - 1)
    return J.fill_missing_weather(r, tb.weather_hourly(spark, sf)).drop("fecha", "hora_int")


@query("j5_weather_keys_needed", f"""
select distinct fecha, hora_int from {RO_HI_SQL} r where temperatura is null
and not exists (select 1 from {WH_SQL} w where w.fecha = r.fecha and w.hora_int = r.hora_int and w.fecha < date '2000-01-01')""")
def j5(spark, sf):
    """J5 against a weather table that ends with 1999: the keys still to fetch."""
    known = tb.weather_hourly(spark, sf).where(F.col("fecha") < F.to_date(F.lit("2000-01-01")))
    return J.weather_keys_needed(_orders_hi(spark, sf), known)


@query("p19_missing_weather", "select row_id, fecha from @RO where temperatura is null")
def p19(spark, sf):
    return tb.readings_orders(spark, sf).where(C.missing_weather()).select("row_id", "fecha")

"""Nested sources: live-feed snapshots (S4, S5), weather replies (S6), chart pages.

Each source has a flatten operator (the job) that works on any rows of the
documented shape, and a builder that derives such rows from the driver tables
(stand-in input). Builders only group into documents of bounded size: one feed
snapshot per hour tick (one entry per ride: its last reading of the tick), one weather reply
per date (24 hours), one chart page per ride and day (at most 288 five-minute
points).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitcast.operators.clean import time_of_day_in
from waitcast.schema import CHART, FEED, WEATHER_REPLY

# Chart element id and date format of the day-chart page; time window kept.
CHART_ID = "chart-1"
CHART_TS_FORMAT = "MM/dd/yy HH:mm:ss"
CHART_WINDOW = ("12:00", "19:30")
CHART_SERIES = ["Reported by users", "Reported by park", "Closed"]


# ---- S4 / S5: feed snapshots ----------------------------------------------

def flatten_feed(snapshots: DataFrame, json_col: str = "payload", open_only: bool = True) -> DataFrame:
    """``{lands: [{name, rides: [...]}]}`` -> one row per ride (zona, atraccion,
    tiempo_espera, abierta, ultima_actualizacion); keeps open rides by default (P11).

    Other columns of ``snapshots`` (e.g. the capture time) are carried along.
    """
    keep = [c for c in snapshots.columns if c != json_col]
    parsed = snapshots.select(*keep, F.from_json(F.col(json_col), FEED).alias("_f"))
    lands = parsed.select(*keep, F.explode(F.col("_f.lands")).alias("_l"))
    rides = lands.select(*keep, F.col("_l.name").alias("zona"), F.explode(F.col("_l.rides")).alias("_r"))
    out = rides.select(*keep, "zona", F.col("_r.name").alias("atraccion"),
                       F.col("_r.wait_time").cast("double").alias("tiempo_espera"),
                       F.col("_r.is_open").alias("abierta"),
                       F.try_to_timestamp(F.col("_r.last_updated")).alias("ultima_actualizacion"))
    return out.where(F.col("abierta") == F.lit(True)) if open_only else out


def stamp_capture(df: DataFrame, capture_col: str = "captured_at") -> DataFrame:
    """Capture date, hh:mm and English day name from the capture time."""
    c = F.col(capture_col)
    return df.withColumns({"fecha": F.to_date(c), "hora": F.date_format(c, "HH:mm"),
                           "dia_semana": F.date_format(c, "EEEE")})


def build_feed_snapshots(readings: DataFrame) -> DataFrame:
    """Stand-in feed: one JSON snapshot per hour tick, rides grouped by zone.

    ``readings`` needs zona, atraccion, tiempo_espera, abierta, ts.
    """
    tick = F.date_trunc("hour", F.col("ts")).alias("captured_at")
    ride = F.struct(F.col("atraccion").alias("name"), F.col("abierta").alias("is_open"),
                    F.col("tiempo_espera").cast("int").alias("wait_time"),
                    F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("last_updated"))
    last = readings.groupBy(tick, "zona", "atraccion").agg(F.max_by(ride, "ts").alias("_r"))
    per_zone = last.groupBy("captured_at", "zona").agg(F.sort_array(F.collect_list("_r")).alias("rides"))
    per_tick = per_zone.groupBy("captured_at").agg(
        F.collect_list(F.struct(F.col("zona").alias("name"), F.col("rides"))).alias("lands"))
    return per_tick.select("captured_at", F.to_json(F.struct("lands")).alias("payload"))


# ---- S6: weather replies ---------------------------------------------------

def flatten_weather(replies: DataFrame, json_col: str = "payload") -> DataFrame:
    """Parallel arrays under ``hourly`` -> one row per hour.

    ``arrays_zip`` pads shorter arrays with NULL (arrays of different length);
    ``time`` like ``2025-10-30T16:00`` becomes (fecha, hora_int).
    """
    keep = [c for c in replies.columns if c != json_col]
    h = replies.select(*keep, F.from_json(F.col(json_col), WEATHER_REPLY).alias("_w")).select(*keep, "_w.hourly.*")
    z = h.select(*keep, F.explode(F.arrays_zip("time", "temperature_2m", "relative_humidity_2m",
                                               "apparent_temperature", "weathercode")).alias("_z"))
    ts = F.try_to_timestamp(F.col("_z.time"), F.lit("yyyy-MM-dd'T'HH:mm"))
    return z.select(*keep, F.to_date(ts).alias("fecha"), F.hour(ts).alias("hora_int"),
                    F.col("_z.temperature_2m").alias("temperatura"),
                    F.col("_z.relative_humidity_2m").cast("double").alias("humedad"),
                    F.col("_z.apparent_temperature").alias("sensacion_termica"),
                    F.col("_z.weathercode").alias("codigo_clima"))


def build_weather_replies(hourly: DataFrame) -> DataFrame:
    """Stand-in replies: one reply per date (24 hourly entries, ordered by hour).

    ``hourly`` needs fecha, hora_int, temperatura, humedad, codigo_clima.
    """
    t = F.concat(F.date_format("fecha", "yyyy-MM-dd"), F.lit("T"), F.lpad(F.col("hora_int").cast("string"), 2, "0"),
                 F.lit(":00"))
    e = F.struct(F.col("hora_int").alias("h"), t.alias("time"), F.col("temperatura").alias("temperature_2m"),
                 F.col("humedad").cast("int").alias("relative_humidity_2m"),
                 F.col("sensacion_termica").alias("apparent_temperature"),
                 F.col("codigo_clima").alias("weathercode"))
    g = hourly.groupBy("fecha").agg(F.sort_array(F.collect_list(e)).alias("_e"))
    hourly_struct = F.struct(*[F.col("_e." + f).alias(f) for f in
                               ["time", "temperature_2m", "relative_humidity_2m", "apparent_temperature", "weathercode"]])
    return g.select(F.to_json(F.struct(hourly_struct.alias("hourly"))).alias("payload"))


# ---- S7: chart pages -------------------------------------------------------

_CHART_RE = r'(?s)"chart-1",\s*(\[.*\])\s*,\s*\{"colors"'


def extract_chart_series(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Locate the ``chart-1`` call in page text, parse its JSON series, and emit
    one row per point: (series, ts_text, minutos). Pages without a chart yield nothing."""
    keep = [c for c in pages.columns if c != html_col]
    js = F.regexp_extract(F.col(html_col), _CHART_RE, 1)
    parsed = pages.select(*keep, F.from_json(F.when(js != "", js), CHART).alias("_s"))
    series = parsed.select(*keep, F.explode("_s").alias("_ser"))
    pts = series.select(*keep, F.col("_ser.name").alias("series"), F.explode("_ser.data").alias("_p"))
    return pts.select(*keep, "series", F.get(F.col("_p"), 0).alias("ts_text"),
                      F.get(F.col("_p"), 1).try_cast("double").alias("minutos"))


def in_chart_window(ts_text: Column) -> Column:
    """P15 for chart points: time of day within 12:00-19:30, bad text -> false."""
    return time_of_day_in(ts_text, CHART_TS_FORMAT, *CHART_WINDOW)


def points_in_window(points: DataFrame, by: list[str]) -> DataFrame:
    """Count of in-window points per series."""
    return (points.where(in_chart_window(F.col("ts_text")))
            .groupBy(*by, "series").agg(F.count(F.lit(1)).alias("n_points")))


def build_chart_pages(readings: DataFrame) -> DataFrame:
    """Stand-in pages: one page per (ride, date) with the three series of the day chart.

    Points are five-minute buckets (last reading of the bucket), so a page holds
    at most 288 points per series whatever the input size.
    """
    b = F.window("ts", "5 minutes").start.alias("b")
    last = (readings.groupBy("atraccion", F.to_date("ts").alias("fecha"), b)
            .agg(F.max_by(F.struct("tiempo_espera", "abierta"), "ts").alias("_v")))
    pt_ts = F.date_format("b", CHART_TS_FORMAT)
    park = F.when(F.col("_v.abierta"), F.array(pt_ts, F.col("_v.tiempo_espera").cast("string")))
    closed = F.when(~F.col("_v.abierta"), F.array(pt_ts, F.lit("0.0")))
    pages = last.groupBy("atraccion", "fecha").agg(
        F.sort_array(F.collect_list(F.struct("b", park.alias("p")))).alias("_park"),
        F.sort_array(F.collect_list(F.struct("b", closed.alias("p")))).alias("_closed"))
    clean = lambda c: F.filter(F.transform(F.col(c), lambda s: s["p"]), lambda x: x.isNotNull())
    series = F.array(
        F.struct(F.lit(CHART_SERIES[0]).alias("name"), F.array().cast("array<array<string>>").alias("data")),
        F.struct(F.lit(CHART_SERIES[1]).alias("name"), clean("_park").alias("data")),
        F.struct(F.lit(CHART_SERIES[2]).alias("name"), clean("_closed").alias("data")))
    html = F.concat(F.lit('<html><body><div id="chart-1"></div><script>Chartkick.LineChart("chart-1", '),
                    F.to_json(series), F.lit(', {"colors": ["#ccc", "#3366cc", "#dc3912"]});</script></body></html>'))
    return pages.select("atraccion", "fecha", html.alias("html"))

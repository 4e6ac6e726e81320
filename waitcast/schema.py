"""Explicit schemas (never inferred: inference turns ``16:26`` into a timestamp)."""

from __future__ import annotations

from pyspark.sql import types as T

# Central table of ride readings, in the column order the curated files use.
READINGS_COLUMNS = [
    ("zona", T.StringType()),
    ("atraccion", T.StringType()),
    ("tiempo_espera", T.DoubleType()),
    ("abierta", T.BooleanType()),
    ("ultima_actualizacion", T.TimestampType()),
    ("fecha", T.DateType()),
    ("hora", T.StringType()),
    ("dia_semana", T.StringType()),
    ("timestamp", T.TimestampNTZType()),
    ("mes", T.IntegerType()),
    ("fin_de_semana", T.BooleanType()),
    ("temperatura", T.DoubleType()),
    ("humedad", T.DoubleType()),
    ("sensacion_termica", T.DoubleType()),
    ("codigo_clima", T.IntegerType()),
]

READINGS = T.StructType([T.StructField(n, t, True) for n, t in READINGS_COLUMNS])

# Raw CSV files keep every field as text; typing happens with try_cast so bad
# values become NULL instead of failing the scan (ANSI mode).
READINGS_RAW = T.StructType([T.StructField(n, T.StringType(), True) for n, _ in READINGS_COLUMNS])

# Live feed snapshot: lands -> rides.
RIDE = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("is_open", T.BooleanType()),
    T.StructField("wait_time", T.IntegerType()),
    T.StructField("last_updated", T.StringType()),
])
FEED = T.StructType([
    T.StructField("lands", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("rides", T.ArrayType(RIDE)),
    ]))),
])

# Hourly weather reply: parallel arrays under ``hourly``.
WEATHER_REPLY = T.StructType([
    T.StructField("hourly", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("temperature_2m", T.ArrayType(T.DoubleType())),
        T.StructField("relative_humidity_2m", T.ArrayType(T.IntegerType())),
        T.StructField("apparent_temperature", T.ArrayType(T.DoubleType())),
        T.StructField("weathercode", T.ArrayType(T.IntegerType())),
    ])),
])

# Day chart: series of [timestamp text, minutes text] pairs.
CHART = T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("data", T.ArrayType(T.ArrayType(T.StringType()))),
]))

# Prediction requests.
REQUESTS = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("fecha", T.StringType()),
    T.StructField("hora", T.StringType()),
    T.StructField("zona", T.StringType()),
    T.StructField("atraccion", T.StringType()),
    T.StructField("temperatura", T.DoubleType()),
    T.StructField("humedad", T.DoubleType()),
    T.StructField("sensacion_termica", T.DoubleType()),
    T.StructField("codigo_clima", T.IntegerType()),
])

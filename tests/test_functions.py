"""Scalar functions: hour parsing (F1/F2, T2, T10), calendar (F4-F15, T1, T4), rounding."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from waitcast.functions import calendar as cal
from waitcast.functions import labels as L
from waitcast.functions.hours import parse_hour, parse_hour_int


def py_parse_hour(s):
    """Independent model of the hour-text rule: HH:MM -> HH + MM/60 (parts truncated),
    plain numbers truncated, anything else None."""
    if s is None:
        return None
    t = s.strip()
    try:
        if ":" in t:
            parts = t.split(":")
            return int(float(parts[0])) + int(float(parts[1])) / 60.0
        return float(int(float(t)))
    except (ValueError, IndexError, OverflowError):
        return None


HOURS = ["12:15:00", "16:26", "9", "14.5", " 13 ", "abc", None, "12:", "", "7:45:10", "23:59", "0", "-1.5", "08:30"]


def test_parse_hour_matches_rule(spark):
    df = spark.createDataFrame([(h,) for h in HOURS], "h string")
    got = {r.h: r.x for r in df.select("h", parse_hour("h").alias("x")).collect()}
    for h in HOURS:
        exp = py_parse_hour(h)
        if exp is None:
            assert got[h] is None, h
        else:
            assert got[h] == pytest.approx(exp), h


def test_parse_hour_default_and_plain_fraction(spark):
    df = spark.createDataFrame([("abc",), ("14.5",)], "h string")
    r = df.select(parse_hour("h", default=12.0).alias("a"), parse_hour("h", truncate_plain=False).alias("b")).collect()
    assert r[0].a == 12.0 and r[0].b is None
    assert r[1].a == 14.0 and r[1].b == 14.5


def test_parse_hour_int_accepts_datetime_text(spark):
    df = spark.createDataFrame([("2025-10-30 14:05:00",), ("14:30:00",), ("15",), ("x",)], "h string")
    assert [r.x for r in df.select(parse_hour_int("h").alias("x")).collect()] == [14, 14, 15, None]


def test_weekday_monday_zero_and_iso_week(spark):
    df = spark.createDataFrame([(dt.date(2025, 10, 27),), (dt.date(2025, 10, 26),), (dt.date(2025, 12, 29),)], "d date")
    r = df.select(*[c.alias(n) for n, c in cal.date_parts("d").items()]).collect()
    assert [x.dia_semana_num for x in r] == [0, 6, 0]          # Monday 0, Sunday 6 (T1)
    assert r[2].semana_anio == 1                               # ISO week of 2025-12-29


def test_holiday_and_bridge(spark):
    days = {dt.date(2024, 1, 1): (True, True),     # holiday (Monday)
            dt.date(2024, 1, 5): (False, True),    # Friday before Saturday 6 Jan
            dt.date(2024, 1, 7): (False, True),    # Sunday after Saturday holiday
            dt.date(2024, 1, 2): (False, False),   # Tuesday after a Monday holiday: not a bridge
            dt.date(2023, 12, 26): (False, False),  # Tuesday after Christmas Monday
            dt.date(2024, 11, 1): (True, True),
            dt.date(2024, 10, 11): (False, True)}  # Friday before 12 Oct (Saturday)
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r.d: (r.h, r.b) for r in df.select("d", cal.is_holiday("d").alias("h"), cal.is_bridge("d").alias("b")).collect()}
    assert got == days


def test_season_variants(spark):
    df = spark.createDataFrame([(m,) for m in range(1, 13)], "m int")
    rows = df.select("m", *[cal.season("m", v).alias(v) for v in "abcdef"]).orderBy("m").collect()
    a = [r.a for r in rows]
    assert a == [0, 0, 1, 2, 2, 2, 3, 3, 1, 3, 1, 2]
    assert [r.c for r in rows][6:8] == ["alta", "alta"] and rows[0].c == "media" and rows[3].c == "baja"


def test_hour_bands_serve_vs_train(spark):
    df = spark.createDataFrame([(h,) for h in range(0, 24)], "h int")
    s = {r.h: r for r in df.select("h", *[c.alias(n) for n, c in cal.hour_bands("h").items()]).collect()}
    t = {r.h: r for r in df.select("h", *[c.alias(n) for n, c in cal.hour_bands("h", "train").items()]).collect()}
    assert [h for h in s if s[h].es_hora_apertura] == [10]
    assert [h for h in s if s[h].es_hora_pico] == list(range(11, 17))
    assert [h for h in t if t[h].es_hora_apertura] == [12]
    assert [h for h in t if t[h].es_hora_valle_manana] == list(range(0, 14))  # T4: training variant


def test_round_half_even_is_python_round(spark):
    rnd = random.Random(7)
    vals = [rnd.uniform(-200, 200) for _ in range(3000)]
    vals += [round(rnd.uniform(0, 300), 2) for _ in range(3000)]             # decimal ties in text
    vals += [x + 0.05 for x in range(-50, 50)] + [0.25, 2.5, -2.5, 0.125, 1e-9, 158.35, 6.85]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = df.select("x", L.round_half_even("x", 1).alias("a"), L.round_half_even("x", 2).alias("b")).collect()
    for row in r:
        assert row.a == round(row.x, 1), row.x
        assert row.b == round(row.x, 2), row.x


def test_clamp_policies_bounds(spark):
    df = spark.createDataFrame([(v,) for v in [-10.0, 0.5, 3.0, 100.0, 500.0]], "x double")
    rescue = F.greatest(F.lit(20.0) * 0.5, F.lit(5.0))
    r = df.select(L.clamp("x", "serve").alias("s"), L.clamp("x", "lambda", rescue).alias("l"),
                  L.clamp("x", "notebook_a").alias("a"), L.clamp("x", "notebook_b").alias("b")).collect()
    assert [x.s for x in r] == [5.0, 5.0, 5.0, 100.0, 180.0]
    assert [x.l for x in r] == [10.0, 10.0, 3.0, 100.0, 180.0]
    assert [x.a for x in r] == [5.0, 5.0, 5.0, 100.0, 120.0]
    assert [x.b for x in r] == [0.0, 0.5, 3.0, 100.0, 180.0]


def test_wait_class_rule_vs_bins(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 3.0, 5.0, 15.0, 16.0, 45.0, 46.0]], "t double")
    r = df.select(L.wait_class_rule("t").alias("r"), L.wait_class_bins("t").alias("b")).collect()
    assert [x.r for x in r] == ["Largo", "Largo", "Corto", "Corto", "Medio", "Medio", "Largo"]  # T9
    assert [x.b for x in r] == ["Corto", "Corto", "Corto", "Corto", "Medio", "Medio", "Largo"]


def test_crowd_level_and_advice(spark):
    df = spark.createDataFrame([(10.0, 1, 0), (29.0, 0, 1), (59.0, 1, 1), (90.0, 0, 0)], "m double, p int, w int")
    r = df.select(L.crowd_level("m").alias("c"), L.advice("m", "p", "w").alias("a")).collect()
    assert [x.c for x in r] == ["Bajo", "Moderado", "Alto", "Muy Alto"]
    assert r[0].a == ["excelente_momento", "hora_pico"]
    assert r[2].a == ["espera_alta", "hora_pico", "fin_de_semana"]
    assert math.isclose(len(r[3].a), 1)

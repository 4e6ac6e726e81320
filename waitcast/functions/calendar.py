"""Calendar features as native expressions.

Weekday base is Monday = 0 everywhere (``F.weekday``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# Fixed public holidays as (month, day): 1 Jan, 6 Jan, 1 May, 12 Oct, 1 Nov, 6 Dec, 8 Dec, 25 Dec.
HOLIDAYS = [(1, 1), (1, 6), (5, 1), (10, 12), (11, 1), (12, 6), (12, 8), (12, 25)]
# Spanish day names, Monday first, and month names, January first.
DAYS_ES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]
MONTHS_ES = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto",
             "Septiembre", "Octubre", "Noviembre", "Diciembre"]
# Season from month, six variants found in the reference: ordered (months, value) rules,
# first match wins, otherwise the default.
SEASONS = {
    # (a) 0-3 scale used by the models and the serving code
    "a": ([([7, 8], 3), ([10], 3), ([4, 5, 6, 12], 2), ([3, 9, 11], 1)], 0),
    # (b) text labels of the holiday script
    "b": ([([3, 11], "baja"), ([4, 5, 9, 12], "media"), ([6, 7, 8, 10], "alta")], "baja"),
    # (c) text labels of the final-table script
    "c": ([([7, 8], "alta"), ([12, 1, 2], "media")], "baja"),
    # (d) notebook 0-2
    "d": ([([4, 7, 8, 10, 12], 2), ([5, 6, 9, 11], 1)], 0),
    # (e) notebook 0-2, second mapping
    "e": ([([7, 8], 2), ([12, 1, 2], 1)], 0),
    # (f) notebook 0-2, simplified
    "f": ([([7, 8, 10], 2), ([4, 5, 6, 12], 1)], 0),
}
# Hour bands: serving definition (also the Spark script's) and the pandas training variant.
BANDS_SERVE = {"apertura": (10, 10), "pico": (11, 16), "valle_manana_lt": 10, "valle_tarde_gt": 18}
BANDS_TRAIN = {"apertura": (12, 12), "pico": (12, 16), "valle_manana_lt": 14, "valle_tarde_gt": 18}
# Name pattern of the featured ride that gets the October rules (substring match).
FEATURED_RIDE = "Batman"
# Notebook hour bands (inclusive ranges on the hour).
NOTEBOOK_BANDS = {"hora_pico_manana": (11, 14), "hora_pico_tarde": (15, 18),
                  "hora_almuerzo": (13, 15), "hora_noche": (19, 22)}
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_date(col) -> Column:
    """text/timestamp -> date, NULL on bad text (never raises under ANSI)."""
    c = _c(col)
    return F.coalesce(F.try_to_date(c.cast("string")), F.to_date(F.try_to_timestamp(c.cast("string"))))


def lenient_timestamp(col) -> Column:
    return F.try_to_timestamp(_c(col).cast("string"))


def utc_wall_clock(ts_ltz, session_tz: str) -> Column:
    """an instant (e.g. parsed from text with an offset) as its UTC wall-clock time
    (TIMESTAMP_NTZ), whatever the session time zone: the zone-strip of the reference."""
    return F.convert_timezone(F.lit(session_tz), F.lit("UTC"), _c(ts_ltz).cast("timestamp_ntz"))


def date_parts(fecha) -> dict[str, Column]:
    """month, day, weekday (Mon=0), ISO week, quarter, year."""
    d = _c(fecha)
    return {
        "mes": F.month(d),
        "dia_mes": F.dayofmonth(d),
        "dia_semana_num": F.weekday(d),
        "semana_anio": F.weekofyear(d),
        "trimestre": F.quarter(d),
        "anio": F.year(d),
    }


def day_name(fecha, lang: str = "en") -> Column:
    """day name, English or Spanish."""
    d = _c(fecha)
    if lang == "en":
        return F.date_format(d, "EEEE")
    return F.when(d.isNotNull(), F.element_at(F.array(*[F.lit(x) for x in DAYS_ES]), F.weekday(d) + 1))


def month_name(fecha, lang: str = "en") -> Column:
    d = _c(fecha)
    if lang == "en":
        return F.date_format(d, "MMMM")
    return F.when(d.isNotNull(), F.element_at(F.array(*[F.lit(x) for x in MONTHS_ES]), F.month(d)))


def season(mes, variant: str = "a") -> Column:
    """season from month number, one of the six reference variants."""
    rules, default = SEASONS[variant]
    m = _c(mes)
    out = None
    for months, value in rules:
        cond = m.isin(months)
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return out.otherwise(F.lit(default))


def weekday_flags(dow) -> dict[str, Column]:
    """F8: one-hot weekday x7, weekend, workday."""
    d = _c(dow)
    names = ["es_lunes", "es_martes", "es_miercoles", "es_jueves", "es_viernes", "es_sabado", "es_domingo"]
    out = {n: (d == i).cast("int") for i, n in enumerate(names)}
    out["es_fin_de_semana"] = d.isin(5, 6).cast("int")
    out["es_dia_laborable"] = d.isin(0, 1, 2, 3, 4).cast("int")
    return out


def month_flags(mes) -> dict[str, Column]:
    """one-hot month x12."""
    m = _c(mes)
    return {f"es_mes_{i}": (m == i).cast("int") for i in range(1, 13)}


def cyclic(hora, mes, dow, dia_mes, semana) -> dict[str, Column]:
    """sin/cos of hour/24, month/12, weekday/7, day/31, week/52."""
    two_pi = F.lit(2 * math.pi)
    out = {}
    for name, c, period in [("hora", hora, 24), ("mes", mes, 12), ("dia_semana", dow, 7),
                            ("dia_mes", dia_mes, 31), ("semana_anio", semana, 52)]:
        x = two_pi * _c(c) / F.lit(float(period))
        out[f"{name}_sin"] = F.sin(x)
        out[f"{name}_cos"] = F.cos(x)
    return out


def interactions(hora, mes, dow, finde, temporada) -> dict[str, Column]:
    """products of calendar features."""
    return {
        "hora_mes": _c(hora) * _c(mes),
        "hora_dia_semana": _c(hora) * _c(dow),
        "mes_dia_semana": _c(mes) * _c(dow),
        "fin_semana_mes": _c(finde) * _c(mes),
        "temporada_dia_semana": _c(temporada) * _c(dow),
    }


def weather_flags(codigo) -> dict[str, Column]:
    """good weather (codes 1-3) and bad weather (> 3)."""
    c = _c(codigo)
    return {"es_buen_clima": F.coalesce(c.isin(1, 2, 3), F.lit(False)).cast("int"),
            "es_mal_clima": F.coalesce(c > 3, F.lit(False)).cast("int")}


def hour_bands(hora_int, variant: str = "serve") -> dict[str, Column]:
    """opening / peak / valley bands (T4: serving definition by default)."""
    b = BANDS_SERVE if variant == "serve" else BANDS_TRAIN
    h = _c(hora_int)
    man = (h < b["valle_manana_lt"])
    tar = (h > b["valle_tarde_gt"])
    return {
        "es_hora_apertura": h.between(*b["apertura"]).cast("int"),
        "es_hora_pico": h.between(*b["pico"]).cast("int"),
        "es_hora_valle_manana": man.cast("int"),
        "es_hora_valle_tarde": tar.cast("int"),
        "es_hora_valle": (man | tar).cast("int"),
    }


def notebook_bands(hora) -> dict[str, Column]:
    h = _c(hora)
    return {k: h.between(lo, hi).cast("int") for k, (lo, hi) in NOTEBOOK_BANDS.items()}


def is_holiday(fecha) -> Column:
    """fixed public holiday."""
    d = _c(fecha)
    md = F.month(d) * 100 + F.dayofmonth(d)
    return md.isin([m * 100 + dd for m, dd in HOLIDAYS])


def is_bridge(fecha) -> Column:
    """holiday, Friday before a holiday, or Monday/Sunday after one."""
    d = _c(fecha)
    wd = F.weekday(d)
    return (is_holiday(d)
            | ((wd == 4) & is_holiday(F.date_add(d, 1)))
            | ((wd == 0) & is_holiday(F.date_sub(d, 1)))
            | ((wd == 6) & is_holiday(F.date_sub(d, 1))))


def bridge_interactions(apertura, pico, puente, finde) -> dict[str, Column]:
    return {
        "hora_apertura_fin_semana": _c(apertura) * _c(finde),
        "hora_pico_puente": _c(pico) * _c(puente),
        "puente_fin_semana": _c(puente) * _c(finde),
    }


def ride_month_flags(atraccion, mes, finde, featured: str = FEATURED_RIDE) -> dict[str, Column]:
    """featured-ride-in-October and month flags (the ride pattern is a parameter)."""
    a, m, w = _c(atraccion), _c(mes), _c(finde)
    hit = F.coalesce(a.contains(featured), F.lit(False))
    return {
        "is_featured_octubre": (hit & (m == 10)).cast("int"),
        "is_octubre": (m == 10).cast("int"),
        "is_noviembre": (m == 11).cast("int"),
        "is_octubre_fin_semana": ((m == 10) & (w == 1)).cast("int"),
        "is_noviembre_fin_semana": ((m == 11) & (w == 1)).cast("int"),
    }

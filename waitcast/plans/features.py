"""Feature layer: every calendar/hour/weather feature in one projection.

All features are built as one ``withColumns`` per dependency layer (three
layers), never a chain of ~60 ``withColumn`` calls, so the analyzer sees a
flat Project that Catalyst collapses and codegen compiles in one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitcast.functions import calendar as cal
from waitcast.functions.hours import hour_int as _hour_int


def calendar_features(df: DataFrame, fecha: str = "fecha", hora: str = "hora_num",
                      bands: str = "serve", featured: str = cal.FEATURED_RIDE) -> DataFrame:
    """Add F4, F7-F15, F17 features. ``hora`` must be a numeric (fractional) hour column."""
    parts = cal.date_parts(fecha)
    layer1 = dict(parts)
    layer1["hora_int"] = _hour_int(F.col(hora))
    df = df.withColumns(layer1)
    layer2 = {}
    layer2.update(cal.weekday_flags("dia_semana_num"))
    layer2.update(cal.month_flags("mes"))
    layer2["temporada"] = cal.season("mes", "a")
    layer2.update(cal.cyclic(hora, "mes", "dia_semana_num", "dia_mes", "semana_anio"))
    layer2.update(cal.hour_bands("hora_int", bands))
    layer2["es_festivo"] = cal.is_holiday(fecha).cast("int")
    layer2["es_puente"] = cal.is_bridge(fecha).cast("int")
    df = df.withColumns(layer2)
    layer3 = {}
    layer3.update(cal.interactions(hora, "mes", "dia_semana_num", "es_fin_de_semana", "temporada"))
    layer3.update(cal.bridge_interactions("es_hora_apertura", "es_hora_pico", "es_puente", "es_fin_de_semana"))
    if "atraccion" in df.columns:
        layer3.update(cal.ride_month_flags("atraccion", "mes", "es_fin_de_semana", featured))
    if "codigo_clima" in df.columns:
        layer3.update(cal.weather_flags("codigo_clima"))
    return df.withColumns(layer3)


def basic_calendar(df: DataFrame, fecha: str = "fecha") -> DataFrame:
    """Only the keys the histories need: mes, dia_semana_num (Mon=0)."""
    return df.withColumns({"mes": F.month(fecha), "dia_semana_num": F.weekday(fecha)})

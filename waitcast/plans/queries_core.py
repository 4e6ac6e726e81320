"""Flagship slice and history queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from waitcast.functions import calendar as cal
from waitcast.operators import history as H
from waitcast.operators import joins as J
from waitcast.plans.catalog import query, rounded
from waitcast.sources import tables as tb


def _events_features(spark, sf):
    r = tb.readings_events(spark, sf)
    r = r.withColumns({"mes": F.month("fecha"), "dia_semana_num": F.weekday("fecha")})
    r = r.withColumns(cal.weekday_flags("dia_semana_num"))
    return r.withColumns(cal.hour_bands("hora_int"))


@query("flagship_top_rides", """
with f as (select *, isodow(fecha) - 1 dow,
                  case when hora_int between 11 and 16 then 1 else 0 end pico,
                  case when isodow(fecha) - 1 in (5, 6) then 1 else 0 end finde
           from @RE),
h as (select atraccion, hora_int, count(*) count_hora, avg(tiempo_espera) mean_hora,
             quantile_cont(tiempo_espera, 0.75) p75_hora
      from f where tiempo_espera is not null group by 1, 2),
j as (select f.*, h.count_hora, h.mean_hora, h.p75_hora from f left join h using (atraccion, hora_int))
select atraccion, count(*) n, round(avg(tiempo_espera), 6) mean_wait,
       round(avg(pico), 6) peak_share, round(avg(finde), 6) weekend_share,
       round(avg(p75_hora), 6) mean_hist_p75
from j group by atraccion order by mean_wait desc, atraccion limit 10
""")
def flagship_top_rides(spark, sf):
    """events -> readings -> weekday/hour-band features -> ride x hour history (A2)
    -> attached to every reading (J1) -> top 10 rides by mean wait (K1)."""
    r = _events_features(spark, sf)
    hist = H.grain_history(r, "hora")
    j = J.size_checked_join(r, hist, ["atraccion", "hora_int"], "left", materialize=True)
    agg = j.groupBy("atraccion").agg(
        F.count(F.lit(1)).alias("n"), F.avg("tiempo_espera").alias("mean_wait"),
        F.avg("es_hora_pico").alias("peak_share"), F.avg("es_fin_de_semana").alias("weekend_share"),
        F.avg("p75_hora").alias("mean_hist_p75"))
    return rounded(agg).orderBy(F.desc("mean_wait"), "atraccion").limit(10)

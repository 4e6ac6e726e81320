"""Queries for cleaning, de-duplication and merges (P*, D*, U*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from waitcast.operators import clean as C
from waitcast.operators import dedup as D
from waitcast.plans.catalog import query, rounded
from waitcast.schema import READINGS_COLUMNS
from waitcast.sources import tables as tb

EV_KEYS = ["fecha", "hora_int", "atraccion"]


def _ev(spark, sf):
    return tb.readings_events(spark, sf)


def _ord(spark, sf):
    return tb.readings_orders(spark, sf)


@query("p1_drop_optional", "select row_id, zona, atraccion, round(tiempo_espera, 6) tiempo_espera, fecha, hora_int, hora from @RE")
def p1(spark, sf):
    return rounded(C.drop_optional(_ev(spark, sf), ["abierta", "ts", "sensacion_termica"]))


@query("p2_project_fixed", """
select zona, atraccion, tiempo_espera, abierta, cast(null as timestamp) ultima_actualizacion, fecha, hora,
       cast(null as varchar) dia_semana, cast(null as timestamp) "timestamp", cast(null as integer) mes,
       cast(null as boolean) fin_de_semana, temperatura, humedad, cast(null as double) sensacion_termica,
       codigo_clima from @RO""")
def p2(spark, sf):
    return C.project_fixed(_ord(spark, sf), READINGS_COLUMNS)


@query("p3_exclude_zones", "select row_id, zona, atraccion from @RE where zona not in ('error', 'Halloween', 'Warner Beach')")
def p3(spark, sf):
    return C.exclude_zones(_ev(spark, sf), ["error"] + C.EXCLUDED_ZONES).select("row_id", "zona", "atraccion")


@query("p4_drop_closed_zero", """
select row_id, tiempo_espera, abierta from @RO
where not coalesce(tiempo_espera = 0 and abierta = false, false)""")
def p4(spark, sf):
    return C.drop_closed_zero(_ord(spark, sf)).select("row_id", "tiempo_espera", "abierta")


@query("p5_domain_filter", """
select row_id, tiempo_espera, temperatura, humedad from @RO
where tiempo_espera >= 0 and temperatura between -10 and 45 and humedad between 0 and 100""")
def p5(spark, sf):
    return C.domain_filter(_ord(spark, sf)).select("row_id", "tiempo_espera", "temperatura", "humedad")


@query("p6_quantile_trim", """
with r as (select * from @RE),
b as (select quantile_cont(tiempo_espera, 0.01) lo, quantile_cont(tiempo_espera, 0.99) hi from r)
select row_id, round(tiempo_espera, 6) tiempo_espera from r, b where tiempo_espera >= lo and tiempo_espera <= hi""")
def p6(spark, sf):
    return rounded(C.quantile_trim(_ev(spark, sf), lo=0.01, hi=0.99).select("row_id", "tiempo_espera"))


def _trim_query(lo: float, hi: float, name: str):
    @query(name, f"""
with r as (select * from @RE),
b as (select quantile_cont(tiempo_espera, {lo}) lo, quantile_cont(tiempo_espera, {hi}) hi from r)
select row_id, round(tiempo_espera, 6) tiempo_espera from r, b where tiempo_espera >= lo and tiempo_espera <= hi""")
    def q(spark, sf):
        return rounded(C.quantile_trim(_ev(spark, sf), lo=lo, hi=hi).select("row_id", "tiempo_espera"))
    q.__doc__ = f"P6: keep events readings with the wait inside its [{lo}, {hi}] quantiles (inclusive)."
    return q


for _lo, _hi, _n in [(0.005, 0.995, "p6_quantile_trim_005_995"), (0.02, 0.995, "p6_quantile_trim_02_995")]:
    _trim_query(_lo, _hi, _n)


@query("p7_iqr_outliers", """
with r as (select * from @RE),
q as (select quantile_cont(tiempo_espera, 0.25) q1, quantile_cont(tiempo_espera, 0.75) q3 from r)
select zona, atraccion, round(tiempo_espera, 6) tiempo_espera from r, q
where tiempo_espera < q1 - 1.5 * (q3 - q1) or tiempo_espera > q3 + 1.5 * (q3 - q1)""")
def p7(spark, sf):
    return rounded(C.iqr_outliers(_ev(spark, sf)).select("zona", "atraccion", "tiempo_espera"))


@query("p8_cap_wait", "select row_id, round(tiempo_espera, 6) tiempo_espera from @RE where tiempo_espera <= 180")
def p8(spark, sf):
    return rounded(C.cap_wait(_ev(spark, sf)).select("row_id", "tiempo_espera"))


@query("p9_require_fields", "select row_id, hora, temperatura from @RO where hora is not null and temperatura is not null")
def p9(spark, sf):
    return C.require(_ord(spark, sf), ["hora", "temperatura"]).select("row_id", "hora", "temperatura")


@query("p10_non_blank_zone", "select row_id, zona from @RE where zona is not null and trim(zona) <> ''")
def p10(spark, sf):
    return C.non_blank_zone(_ev(spark, sf)).select("row_id", "zona")


@query("p11_only_open", "select row_id, atraccion, abierta from @RO where abierta = true")
def p11(spark, sf):
    return C.only_open(_ord(spark, sf)).select("row_id", "atraccion", "abierta")


@query("p12_day_slice", "select row_id, fecha, atraccion from @RE where fecha = date '2024-01-15'")
def p12(spark, sf):
    return C.day_slice(_ev(spark, sf), "2024-01-15").select("row_id", "fecha", "atraccion")


@query("p13_name_match", """
select row_id, atraccion, false exact from @RE where contains(atraccion, 'click')
union all select row_id, atraccion, true exact from @RE where atraccion = 'view_3'""")
def p13(spark, sf):
    ev = _ev(spark, sf)
    a = C.name_match(ev, "click", contains=True).select("row_id", "atraccion", F.lit(False).alias("exact"))
    b = C.name_match(ev, "view_3").select("row_id", "atraccion", F.lit(True).alias("exact"))
    return a.unionByName(b)


@query("p14_hour_slice", "select row_id, hora_int from @RE where hora_int between 11 and 14")
def p14(spark, sf):
    return C.hour_slice(_ev(spark, sf), 11, 14).select("row_id", "hora_int")


_P16_COLS = [n for n, _ in READINGS_COLUMNS]


def _p16_sql() -> str:
    parts = []
    for c in _P16_COLS:
        q = f'"{c}"'
        parts.append(f"select '{c}' column_name, count({q}) = 0 all_null, "
                     f"coalesce(min({q}) = max({q}), false) \"constant\" from p")
    inner = " union all ".join(parts)
    return f"""with p as (select zona, atraccion, tiempo_espera, abierta, cast(null as timestamp) ultima_actualizacion,
       fecha, hora, cast(null as varchar) dia_semana, cast(null as timestamp) "timestamp", cast(null as integer) mes,
       cast(null as boolean) fin_de_semana, temperatura, humedad, cast(null as double) sensacion_termica,
       codigo_clima from @RO) {inner}"""


@query("p16_degenerate_columns", _p16_sql())
def p16(spark, sf):
    return C.degenerate_columns(C.project_fixed(_ord(spark, sf), READINGS_COLUMNS))


@query("p17_numeric_columns", "select row_id, tiempo_espera, temperatura, humedad, codigo_clima from @RO")
def p17(spark, sf):
    return C.keep_numeric(_ord(spark, sf))


@query("p18_sample_rows", """
select row_id, zona, atraccion, round(tiempo_espera, 6) tiempo_espera, fecha, hora_int, hora, abierta, ts from @RE
order by (((row_id + 42) % 2147483648) * 2654435761) % 4294967296, row_id limit 100""")
def p18(spark, sf):
    """Repeatable 100-row sample of the events readings (the limit is the operator)."""
    return rounded(C.sample_rows(_ev(spark, sf), 100, ["row_id"]))


@query("p20_validate_requests", """
select row_id, missing, len(missing) = 0 valid from (
select row_id, list_filter([case when fecha is null then 'fecha' end,
                            case when hora is null or trim(hora) = '' then 'hora' end,
                            case when atraccion is null or trim(atraccion) = '' then 'atraccion' end,
                            case when zona is null or trim(zona) = '' then 'zona' end], lambda x: x is not null) missing
from @RO)""")
def p20(spark, sf):
    req = _ord(spark, sf).select("row_id", "fecha", "hora", "atraccion", "zona")
    return C.validate_requests(req).select("row_id", "missing", "valid")


# ---- de-duplication --------------------------------------------------------

@query("d1_dedup_keep_first", """
select row_id, fecha, hora_int, atraccion, round(tiempo_espera, 6) tiempo_espera from @RE
qualify row_number() over (partition by fecha, hora_int, atraccion order by row_id) = 1""")
def d1(spark, sf):
    ev = _ev(spark, sf).select("row_id", "fecha", "hora_int", "atraccion", "tiempo_espera")
    return rounded(D.keep_first(ev, EV_KEYS, ["row_id"]))


@query("d1_dedup_report", """
select count(*) rows_in, count(distinct (fecha, hora_int, atraccion)) rows_out,
       count(*) - count(distinct (fecha, hora_int, atraccion)) duplicates_removed from @RE""")
def d1r(spark, sf):
    return D.dedup_report(_ev(spark, sf), EV_KEYS)


@query("d2_dedup_keep_last", """
select row_id, fecha, hora_int, atraccion, round(tiempo_espera, 6) tiempo_espera from @RE
qualify row_number() over (partition by fecha, hora_int, atraccion order by row_id desc) = 1""")
def d2(spark, sf):
    ev = _ev(spark, sf).select("row_id", "fecha", "hora_int", "atraccion", "tiempo_espera")
    return rounded(D.keep_last(ev, EV_KEYS, ["row_id"]))


@query("d3_duplicate_members", """
select zona, atraccion, tiempo_espera, fecha, hora_int from
  (select *, count(*) over (partition by zona, atraccion, tiempo_espera, fecha, hora_int) c from @RL) where c > 1""")
def d3(spark, sf):
    return D.exact_duplicate_members(tb.readings_lineitem(spark, sf))


@query("d3_duplicate_count", """
select cast(count(*) - (select count(*) from (select distinct * from @RL)) as bigint) duplicate_rows from @RL""")
def d3c(spark, sf):
    return D.exact_duplicate_count(tb.readings_lineitem(spark, sf))


@query("d4_duplicate_groups", """
select zona, atraccion, tiempo_espera, fecha, hora_int, count(*) n from @RL group by all having count(*) > 1""")
def d4(spark, sf):
    return D.exact_duplicate_groups(tb.readings_lineitem(spark, sf))


@query("d5_ride_trace", """
select row_id, fecha, hora, round(tiempo_espera, 6) tiempo_espera from @RE where atraccion = 'click_3'
order by fecha, hora, row_id""")
def d5(spark, sf):
    ev = _ev(spark, sf).select("row_id", "fecha", "hora", "tiempo_espera", "atraccion")
    return rounded(D.ride_trace(ev, "click_3", ["fecha", "hora", "row_id"]).drop("atraccion"))


# ---- merges ----------------------------------------------------------------

@query("u1_union_aligned", """
select row_id, zona, atraccion, round(tiempo_espera, 6) tiempo_espera, fecha, hora, abierta,
       cast(null as double) temperatura, 'events' src from @RE
union all
select row_id, zona, atraccion, tiempo_espera, fecha, hora, abierta, temperatura, 'orders' src from @RO""")
def u1(spark, sf):
    a = _ev(spark, sf).select("row_id", "zona", "atraccion", "tiempo_espera", "fecha", "hora", "abierta",
                              F.lit("events").alias("src"))
    b = _ord(spark, sf).select("row_id", "zona", "atraccion", "tiempo_espera", "fecha", "hora", "abierta",
                               "temperatura", F.lit("orders").alias("src"))
    return rounded(D.union_aligned(a, b))


def _sources(spark, sf):
    ev = _ev(spark, sf).select("row_id", "fecha", "hora_int", "atraccion", "tiempo_espera")
    curated = ev.where(F.col("fecha") < F.lit("2024-01-21").cast("date"))
    pipeline = ev.where(F.col("fecha") >= F.lit("2024-01-11").cast("date")) \
        .withColumn("tiempo_espera", F.col("tiempo_espera") + 1)
    new = ev.where(F.col("fecha") >= F.lit("2024-01-21").cast("date")) \
        .withColumn("tiempo_espera", F.col("tiempo_espera") + 2)
    return curated, pipeline, new


_SRC_SQL = """with ev as (select row_id, fecha, hora_int, atraccion, tiempo_espera from @RE),
cur as (select * from ev where fecha < date '2024-01-21'),
pip as (select row_id, fecha, hora_int, atraccion, tiempo_espera + 1 tiempo_espera from ev where fecha >= date '2024-01-11'),
new as (select row_id, fecha, hora_int, atraccion, tiempo_espera + 2 tiempo_espera from ev where fecha >= date '2024-01-21')"""


@query("u2_append_keep_latest", _SRC_SQL + """,
u as (select *, 0 s from cur union all select *, 1 s from pip)
select row_id, fecha, hora_int, atraccion, round(tiempo_espera, 6) tiempo_espera from u
qualify row_number() over (partition by fecha, hora_int, atraccion order by s desc, row_id desc) = 1""")
def u2(spark, sf):
    cur, pip, _ = _sources(spark, sf)
    return rounded(D.append_keep_latest(cur, pip, EV_KEYS))


@query("u3_precedence_merge", _SRC_SQL + """,
u as (select *, 0 s from cur union all select *, 1 s from pip union all select *, 2 s from new)
select row_id, fecha, hora_int, atraccion, round(tiempo_espera, 6) tiempo_espera from u
qualify row_number() over (partition by fecha, hora_int, atraccion order by s desc, row_id desc) = 1""")
def u3(spark, sf):
    cur, pip, new = _sources(spark, sf)
    return rounded(D.precedence_merge([cur, pip, new], EV_KEYS))


@query("u4_columnwise_append", """
select r.row_id, r.fecha, w.temperatura w_temperatura, w.humedad w_humedad from @RO r left join @WD w using (fecha)""")
def u4(spark, sf):
    w = tb.weather_daily(spark, sf).select("fecha", F.col("temperatura").alias("w_temperatura"),
                                           F.col("humedad").alias("w_humedad"))
    return D.columnwise_append(_ord(spark, sf).select("row_id", "fecha"), w, ["fecha"])

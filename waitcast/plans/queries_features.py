"""Queries for scalar functions and calendar features."""

from __future__ import annotations

from pyspark.sql import functions as F

from waitcast.functions import calendar as cal
from waitcast.functions import fill as FL
from waitcast.functions import labels as L
from waitcast.functions import sql as SQLF
from waitcast.functions.hours import parse_hour, parse_hour_int
from waitcast.plans.catalog import query, rounded
from waitcast.plans.features import calendar_features
from waitcast.plans.sqlhelpers import pyround_sql as PR
from waitcast.sources import tables as tb
from waitcast.operators.scalars import with_scalars


def hour_sql(x: str) -> str:
    """DuckDB twin of :func:`parse_hour`."""
    t = f"trim({x})"
    return (f"(case when instr({t}, ':') > 0 then trunc(try_cast(split_part({t}, ':', 1) as double)) "
            f"+ trunc(try_cast(split_part({t}, ':', 2) as double)) / 60.0 "
            f"else trunc(try_cast({t} as double)) end)")


def season_sql(variant: str, m: str = "mes") -> str:
    rules, default = cal.SEASONS[variant]
    lit = (lambda v: f"'{v}'") if isinstance(default, str) else str
    whens = " ".join(f"when {m} in ({', '.join(map(str, ms))}) then {lit(v)}" for ms, v in rules)
    return f"(case {whens} else {lit(default)} end)"


HOL_SQL = ", ".join(str(m * 100 + d) for m, d in cal.HOLIDAYS)


def hol_sql(d: str) -> str:
    return f"((month({d}) * 100 + day({d})) in ({HOL_SQL}))"


def bridge_sql(d: str = "fecha") -> str:
    dow = f"(isodow({d}) - 1)"
    return (f"({hol_sql(d)} or ({dow} = 4 and {hol_sql(f'({d} + interval 1 day)')}) "
            f"or ({dow} in (0, 6) and {hol_sql(f'({d} - interval 1 day)')}))")


RO_H = f"(select *, coalesce({hour_sql('hora')}, 12.0) hora_num from @RO)"


def _ord_h(spark, sf):
    r = tb.readings_orders(spark, sf)
    return r.withColumn("hora_num", parse_hour("hora", default=12.0))


@query("f1_parse_hour", f"select row_id, hora, {hour_sql('hora')} hora_num from @RO")
def f1(spark, sf):
    r = tb.readings_orders(spark, sf)
    return rounded(r.select("row_id", "hora", parse_hour("hora").alias("hora_num")))


@query("f2_parse_hour_int", """
select row_id, hora, case when instr(trim(hora), ' ') > 0 then hour(try_cast(trim(hora) as timestamp))
       else cast(trunc(try_cast(split_part(trim(hora), ':', 1) as double)) as integer) end hora_int from @RO""")
def f2(spark, sf):
    r = tb.readings_orders(spark, sf)
    return r.select("row_id", "hora", parse_hour_int("hora").alias("hora_int"))


@query("f3_lenient_dates", """
select row_id, try_cast(case when hora = 'n/d' then '2001-13-45' else cast(fecha as varchar) end as date) fecha_d,
       try_cast(case when hora is null then 'not a time' else cast(fecha as varchar) || ' ' || hora end as timestamp) ts
from @RO""")
def f3(spark, sf):
    r = tb.readings_orders(spark, sf)
    txt = F.when(F.col("hora") == "n/d", F.lit("2001-13-45")).otherwise(F.col("fecha").cast("string"))
    ts_txt = F.when(F.col("hora").isNull(), F.lit("not a time")).otherwise(
        F.concat(F.col("fecha").cast("string"), F.lit(" "), F.col("hora")))
    return r.select("row_id", cal.lenient_date(txt).alias("fecha_d"), cal.lenient_timestamp(ts_txt).alias("ts"))


@query("f4_date_parts", """
select row_id, month(fecha) mes, day(fecha) dia_mes, isodow(fecha) - 1 dia_semana_num, week(fecha) semana_anio,
       quarter(fecha) trimestre, year(fecha) anio from @RO""")
def f4(spark, sf):
    r = tb.readings_orders(spark, sf)
    return r.select("row_id", *[c.alias(n) for n, c in cal.date_parts("fecha").items()])


_DAYS_SQL = "[" + ", ".join(f"'{d}'" for d in cal.DAYS_ES) + "]"
_MONTHS_SQL = "[" + ", ".join(f"'{m}'" for m in cal.MONTHS_ES) + "]"


@query("f5_day_month_names", f"""
select row_id, dayname(fecha) dia_en, {_DAYS_SQL}[isodow(fecha)] dia_es,
       monthname(fecha) mes_en, {_MONTHS_SQL}[month(fecha)] mes_es from @RO""")
def f5(spark, sf):
    r = tb.readings_orders(spark, sf)
    return r.select("row_id", cal.day_name("fecha").alias("dia_en"), cal.day_name("fecha", "es").alias("dia_es"),
                    cal.month_name("fecha").alias("mes_en"), cal.month_name("fecha", "es").alias("mes_es"))


@query("f6_utc_parse_compose", """
with r as (select row_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' ua, fecha, hora from @RE)
select row_id, cast(try_cast(ua as timestamp) as date) fecha_utc, strftime(try_cast(ua as timestamp), '%H:%M') hhmm,
       try_cast(cast(fecha as varchar) || ' ' || hora as timestamp) ts_compuesto from r""")
def f6(spark, sf):
    r = tb.readings_events(spark, sf)
    ua = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    ts = cal.utc_wall_clock(cal.lenient_timestamp(ua), spark.conf.get("spark.sql.session.timeZone"))
    return r.select("row_id", F.to_date(ts).alias("fecha_utc"), F.date_format(ts, "HH:mm").alias("hhmm"),
                    cal.lenient_timestamp(F.concat_ws(" ", F.col("fecha").cast("string"), F.col("hora")))
                    .cast("timestamp_ntz").alias("ts_compuesto"))


@query("f7_season_variants", f"""
select row_id, {season_sql('a', 'month(fecha)')} temporada_a, {season_sql('b', 'month(fecha)')} temporada_b,
       {season_sql('c', 'month(fecha)')} temporada_c, {season_sql('d', 'month(fecha)')} temporada_d,
       {season_sql('e', 'month(fecha)')} temporada_e, {season_sql('f', 'month(fecha)')} temporada_f from @RO""")
def f7(spark, sf):
    r = tb.readings_orders(spark, sf)
    return r.select("row_id", *[cal.season(F.month("fecha"), v).alias(f"temporada_{v}") for v in "abcdef"])


_WD = ["es_lunes", "es_martes", "es_miercoles", "es_jueves", "es_viernes", "es_sabado", "es_domingo"]


@query("f8_weekday_flags", "select row_id, " + ", ".join(
    f"cast(isodow(fecha) - 1 = {i} as integer) {n}" for i, n in enumerate(_WD)) +
    ", cast(isodow(fecha) - 1 in (5, 6) as integer) es_fin_de_semana,"
    " cast(isodow(fecha) - 1 in (0, 1, 2, 3, 4) as integer) es_dia_laborable from @RO")
def f8(spark, sf):
    r = tb.readings_orders(spark, sf)
    return r.select("row_id", *[c.alias(n) for n, c in cal.weekday_flags(F.weekday("fecha")).items()])


@query("f9_month_flags", "select row_id, " + ", ".join(
    f"cast(month(fecha) = {i} as integer) es_mes_{i}" for i in range(1, 13)) + " from @RO")
def f9(spark, sf):
    r = tb.readings_orders(spark, sf)
    return r.select("row_id", *[c.alias(n) for n, c in cal.month_flags(F.month("fecha")).items()])


def _cyc_sql():
    parts = []
    for name, expr, period in [("hora", "hora_num", 24), ("mes", "month(fecha)", 12),
                               ("dia_semana", "(isodow(fecha) - 1)", 7), ("dia_mes", "day(fecha)", 31),
                               ("semana_anio", "week(fecha)", 52)]:
        parts.append(f"round(sin(2 * pi() * {expr} / {period}.0), 6) {name}_sin")
        parts.append(f"round(cos(2 * pi() * {expr} / {period}.0), 6) {name}_cos")
    return ", ".join(parts)


@query("f10_cyclic_encodings", f"select row_id, {_cyc_sql()} from {RO_H}")
def f10(spark, sf):
    r = _ord_h(spark, sf)
    cols = cal.cyclic("hora_num", F.month("fecha"), F.weekday("fecha"), F.dayofmonth("fecha"), F.weekofyear("fecha"))
    return rounded(r.select("row_id", *[c.alias(n) for n, c in cols.items()]))


@query("f11_interactions", f"""
select row_id, round(hora_num * month(fecha), 6) hora_mes, round(hora_num * (isodow(fecha) - 1), 6) hora_dia_semana,
       month(fecha) * (isodow(fecha) - 1) mes_dia_semana,
       cast(isodow(fecha) - 1 in (5, 6) as integer) * month(fecha) fin_semana_mes,
       {season_sql('a', 'month(fecha)')} * (isodow(fecha) - 1) temporada_dia_semana from {RO_H}""")
def f11(spark, sf):
    r = _ord_h(spark, sf).withColumns({"mes": F.month("fecha"), "dow": F.weekday("fecha")})
    r = r.withColumns({"finde": F.col("dow").isin(5, 6).cast("int"), "temporada": cal.season("mes")})
    cols = cal.interactions("hora_num", "mes", "dow", "finde", "temporada")
    return rounded(r.select("row_id", *[c.alias(n) for n, c in cols.items()]))


@query("f12_weather_flags", """
select row_id, cast(coalesce(codigo_clima in (1, 2, 3), false) as integer) es_buen_clima,
       cast(coalesce(codigo_clima > 3, false) as integer) es_mal_clima from @RO""")
def f12(spark, sf):
    r = tb.readings_orders(spark, sf)
    return r.select("row_id", *[c.alias(n) for n, c in cal.weather_flags("codigo_clima").items()])


@query("f13_hour_bands", """
with r as (select row_id, cast(trunc(hora_num) as integer) h from @ROH)
select row_id, cast(h = 10 as integer) es_hora_apertura, cast(h between 11 and 16 as integer) es_hora_pico,
       cast(h < 10 as integer) es_hora_valle_manana, cast(h > 18 as integer) es_hora_valle_tarde,
       cast(h < 10 or h > 18 as integer) es_hora_valle,
       cast(h = 12 as integer) tr_apertura, cast(h between 12 and 16 as integer) tr_pico,
       cast(h < 14 as integer) tr_valle_manana, cast(h < 14 or h > 18 as integer) tr_valle,
       cast(h between 11 and 14 as integer) hora_pico_manana, cast(h between 15 and 18 as integer) hora_pico_tarde,
       cast(h between 13 and 15 as integer) hora_almuerzo, cast(h between 19 and 22 as integer) hora_noche
from r""".replace("@ROH", RO_H))
def f13(spark, sf):
    r = _ord_h(spark, sf).withColumn("h", F.col("hora_num").cast("int"))
    serve = cal.hour_bands("h")
    train = cal.hour_bands("h", "train")
    nb = cal.notebook_bands("h")
    return r.select("row_id", *[c.alias(n) for n, c in serve.items()],
                    train["es_hora_apertura"].alias("tr_apertura"), train["es_hora_pico"].alias("tr_pico"),
                    train["es_hora_valle_manana"].alias("tr_valle_manana"), train["es_hora_valle"].alias("tr_valle"),
                    *[c.alias(n) for n, c in nb.items()])


@query("f14_holiday_flag", f"select row_id, fecha, cast({hol_sql('fecha')} as integer) es_festivo from @RO")
def f14(spark, sf):
    r = tb.readings_orders(spark, sf)
    return r.select("row_id", "fecha", cal.is_holiday("fecha").cast("int").alias("es_festivo"))


@query("f15_bridge_day", f"""
with r as (select row_id, fecha, cast(trunc(hora_num) as integer) h, cast({bridge_sql()} as integer) es_puente,
                  cast(isodow(fecha) - 1 in (5, 6) as integer) finde from {RO_H})
select row_id, fecha, es_puente, cast(h = 10 as integer) * finde hora_apertura_fin_semana,
       cast(h between 11 and 16 as integer) * es_puente hora_pico_puente, es_puente * finde puente_fin_semana from r""")
def f15(spark, sf):
    r = _ord_h(spark, sf).withColumn("h", F.col("hora_num").cast("int"))
    b = cal.hour_bands("h")
    r = r.withColumns({"es_puente": cal.is_bridge("fecha").cast("int"),
                       "finde": F.weekday("fecha").isin(5, 6).cast("int"),
                       "ap": b["es_hora_apertura"], "pi": b["es_hora_pico"]})
    inter = cal.bridge_interactions("ap", "pi", "es_puente", "finde")
    return r.select("row_id", "fecha", "es_puente", *[c.alias(n) for n, c in inter.items()])


@query("f16_wait_class", """
select row_id, tiempo_espera,
       case when tiempo_espera between 5 and 15 then 'Corto' when tiempo_espera > 15 and tiempo_espera <= 45 then 'Medio'
            when tiempo_espera is not null then 'Largo' end clase_regla,
       case when tiempo_espera between 0 and 15 then 'Corto' when tiempo_espera > 15 and tiempo_espera <= 45 then 'Medio'
            when tiempo_espera > 45 then 'Largo' end clase_bins from @RO""")
def f16(spark, sf):
    r = tb.readings_orders(spark, sf)
    return r.select("row_id", "tiempo_espera", L.wait_class_rule("tiempo_espera").alias("clase_regla"),
                    L.wait_class_bins("tiempo_espera").alias("clase_bins"))


@query("f17_ride_month_flags", """
with r as (select row_id, atraccion, month(fecha) m, cast(isodow(fecha) - 1 in (5, 6) as integer) w from @RO)
select row_id, cast(coalesce(contains(atraccion, '1-URGENT'), false) and m = 10 as integer) is_featured_octubre,
       cast(m = 10 as integer) is_octubre, cast(m = 11 as integer) is_noviembre,
       cast(m = 10 and w = 1 as integer) is_octubre_fin_semana, cast(m = 11 and w = 1 as integer) is_noviembre_fin_semana
from r""")
def f17(spark, sf):
    r = tb.readings_orders(spark, sf).withColumns({"m": F.month("fecha"),
                                                   "w": F.weekday("fecha").isin(5, 6).cast("int")})
    return r.select("row_id", *[c.alias(n) for n, c in cal.ride_month_flags("atraccion", "m", "w", "1-URGENT").items()])


@query("f18_median_fill", """
with r as (select * from @RO), m as (select median(temperatura) mt, median(humedad) mh from r)
select row_id, coalesce(temperatura, mt) temperatura, coalesce(humedad, mh) humedad,
       coalesce(cast(case when row_id % 7 = 0 then null else codigo_clima end as varchar), 'Desconocido') codigo_clima,
       0 sensacion_termica
from r, m""")
def f18(spark, sf):
    r = tb.readings_orders(spark, sf).withColumn(
        "codigo_clima", F.when(F.col("row_id") % 7 == 0, F.lit(None)).otherwise(F.col("codigo_clima")))
    out = FL.median_fill(r.select("row_id", "temperatura", "humedad", "codigo_clima"),
                         ["temperatura", "humedad", "sensacion_termica"],
                         label_cols={"codigo_clima": FL.UNKNOWN_CODE_LABEL})
    return rounded(out)


@query("f20_typed_casts", """
select row_id, try_cast(hora as double) hora_d, try_cast(codigo_clima as varchar) codigo_txt,
       try_cast(split_part(hora, ':', 1) as integer) hh from @RO""")
def f20(spark, sf):
    r = tb.readings_orders(spark, sf).withColumn("hh", F.get(F.split("hora", ":"), 0))
    out = FL.typed_casts(r.withColumn("hora_d", F.col("hora")).withColumn("codigo_txt", F.col("codigo_clima")),
                         {"hora_d": "double", "codigo_txt": "string", "hh": "int"})
    return out.select("row_id", "hora_d", "codigo_txt", "hh")


@query("f21_label_codes", f"""
with r as (select row_id, {season_sql('b', 'month(fecha)')} lab,
                  case when tiempo_espera between 5 and 15 then 'Corto' when tiempo_espera > 15 and tiempo_espera <= 45
                       then 'Medio' when tiempo_espera is not null then 'Largo' end clase from @RO)
select row_id, lab, case lab when 'baja' then 0 when 'media' then 1 when 'alta' then 2 end temporada_code,
       clase, case clase when 'Corto' then 10 when 'Medio' then 30 when 'Largo' then 60 end clase_min from r""")
def f21(spark, sf):
    r = tb.readings_orders(spark, sf).select(
        "row_id", cal.season(F.month("fecha"), "b").alias("lab"), L.wait_class_rule("tiempo_espera").alias("clase"))
    return r.select("row_id", "lab", L.season_code("lab").alias("temporada_code"), "clase",
                    L.class_minutes("clase").alias("clase_min"))


@query("f22_clamp_round", f"""
with r as (select row_id, tiempo_espera - 20 x from @RE), m as (select median(tiempo_espera) gm from @RE)
select row_id, {PR('least(180, greatest(5, x))')} serve,
       {PR('least(180, greatest(1, case when x < 1 then greatest(gm * 0.5, 5) else x end))')} lambda_policy,
       {PR('least(120, greatest(5, x))')} notebook_a, {PR('least(180, greatest(0, x))')} notebook_b
from r, m""")
def f22(spark, sf):
    from waitcast.operators.history import column_percentiles
    ev = tb.readings_events(spark, sf)
    gm = column_percentiles(ev, ["tiempo_espera"], [0.5]).select(F.col("tiempo_espera__0").alias("gm"))
    r = with_scalars(ev.select("row_id", (F.col("tiempo_espera") - 20).alias("x")), gm)
    rescue = F.greatest(F.col("gm") * 0.5, F.lit(5.0))
    return rounded(r.select(
        "row_id", L.round_half_even(L.clamp("x", "serve")).alias("serve"),
        L.round_half_even(L.clamp("x", "lambda", rescue)).alias("lambda_policy"),
        L.round_half_even(L.clamp("x", "notebook_a")).alias("notebook_a"),
        L.round_half_even(L.clamp("x", "notebook_b")).alias("notebook_b")))


@query("f23_crowd_level", """
select row_id, case when tiempo_espera < 15 then 'Bajo' when tiempo_espera < 30 then 'Moderado'
                    when tiempo_espera < 60 then 'Alto' when tiempo_espera is not null then 'Muy Alto' end nivel from @RO""")
def f23(spark, sf):
    r = tb.readings_orders(spark, sf)
    return r.select("row_id", L.crowd_level("tiempo_espera").alias("nivel"))


@query("f24_advice", f"""
with r as (select row_id, tiempo_espera t, cast(trunc(hora_num) as integer) between 11 and 16 pico,
                  isodow(fecha) - 1 in (5, 6) finde from {RO_H})
select row_id, list_filter([case when t < 15 then 'excelente_momento' when t < 30 then 'buen_momento'
                                 when t < 60 then 'espera_alta' else 'espera_muy_alta' end,
                            case when pico then 'hora_pico' end, case when finde then 'fin_de_semana' end],
                           lambda x: x is not null) consejos from r""")
def f24(spark, sf):
    r = _ord_h(spark, sf).withColumns({"pico": F.col("hora_num").cast("int").between(11, 16),
                                       "finde": F.weekday("fecha").isin(5, 6)})
    return r.select("row_id", L.advice("tiempo_espera", "pico", "finde").alias("consejos"))


@query("f25_prediction_range", f"""
select row_id, greatest(5, {PR('tiempo_espera - 6.1')}) rango_min, {PR('tiempo_espera + 6.1')} rango_max,
       greatest(0, {PR('tiempo_espera - 20 - 6.1')}) rango_min_0, {PR('tiempo_espera - 20 + 6.1')} rango_max_0
from @RE""")
def f25(spark, sf):
    """prediction range +-MAE with the two floors of the reference (5 and 0)."""
    r = tb.readings_events(spark, sf)
    a = L.prediction_range("tiempo_espera", F.lit(6.1))
    b = L.prediction_range(F.col("tiempo_espera") - 20, F.lit(6.1), floor=0.0)
    return rounded(r.select("row_id", a["rango_min"].alias("rango_min"), a["rango_max"].alias("rango_max"),
                            b["rango_min"].alias("rango_min_0"), b["rango_max"].alias("rango_max_0")))


@query("f26_request_defaults", f"""
with r as (select *, {hour_sql('hora')} hn from @RO),
m as (select median(temperatura) mt, median(humedad) mh from r)
select row_id, coalesce(temperatura, mt) temperatura, coalesce(humedad, mh) humedad, coalesce(codigo_clima, 3) codigo_clima,
       coalesce(temperatura, mt) sensacion_termica, coalesce(hn, 12.0) hora_num from r, m""")
def f26(spark, sf):
    from waitcast.operators.history import column_percentiles
    r = tb.readings_orders(spark, sf).withColumn("hora_num", parse_hour("hora"))
    med = column_percentiles(r, ["temperatura", "humedad"], [0.5]).select(
        F.col("temperatura__0").alias("temperatura"), F.col("humedad__0").alias("humedad"))
    out = FL.request_defaults(r, med)
    return rounded(out.select("row_id", "temperatura", "humedad", "codigo_clima", "sensacion_termica", "hora_num"))


@query("f27_bool_int", "select row_id, cast(abierta as integer) abierta from @RO")
def f27(spark, sf):
    return tb.readings_orders(spark, sf).select("row_id", L.bool_int("abierta").alias("abierta"))


@query("f28_weather_label", """
select row_id, case codigo_clima when 1 then 'Soleado' when 2 then 'Parcialmente nublado' when 3 then 'Nublado'
       when 4 then 'Lluvia ligera' when 5 then 'Lluvia fuerte/Tormenta' end clima from @RO""")
def f28(spark, sf):
    return tb.readings_orders(spark, sf).select("row_id", L.weather_label("codigo_clima").alias("clima"))


@query("g4_sql_functions", f"""
select row_id, {hour_sql('hora')} hora_num, {season_sql('a', 'month(fecha)')} temporada,
       {hol_sql('fecha')} festivo, {bridge_sql()} puente from @RO""")
def g4(spark, sf):
    SQLF.register(spark)
    r = tb.readings_orders(spark, sf)
    return rounded(r.selectExpr("row_id", "wc_parse_hour(hora) AS hora_num", "wc_season(month(fecha)) AS temporada",
                                "wc_is_holiday(fecha) AS festivo", "wc_is_bridge(fecha) AS puente"))


def _full_layer_sql() -> str:
    h = "cast(trunc(hora_num) as integer)"
    dow, m = "(isodow(fecha) - 1)", "month(fecha)"
    finde = f"cast({dow} in (5, 6) as integer)"
    ap, pico = f"cast({h} between 10 and 10 as integer)", f"cast({h} between 11 and 16 as integer)"
    puente = f"cast({bridge_sql()} as integer)"
    temporada = season_sql("a", m)
    cols = ["row_id", "zona", "atraccion", "round(tiempo_espera, 6) tiempo_espera", "fecha", "hora",
            "round(temperatura, 6) temperatura", "round(humedad, 6) humedad", "codigo_clima", "abierta",
            "round(hora_num, 6) hora_num", f"{m} mes", "day(fecha) dia_mes", f"{dow} dia_semana_num",
            "week(fecha) semana_anio", "quarter(fecha) trimestre", "year(fecha) anio", f"{h} hora_int"]
    cols += [f"cast({dow} = {i} as integer) {n}" for i, n in enumerate(_WD)]
    cols += [f"{finde} es_fin_de_semana", f"cast({dow} in (0, 1, 2, 3, 4) as integer) es_dia_laborable"]
    cols += [f"cast({m} = {i} as integer) es_mes_{i}" for i in range(1, 13)]
    cols += [f"{temporada} temporada", _cyc_sql()]
    cols += [f"{ap} es_hora_apertura", f"{pico} es_hora_pico", f"cast({h} < 10 as integer) es_hora_valle_manana",
             f"cast({h} > 18 as integer) es_hora_valle_tarde", f"cast({h} < 10 or {h} > 18 as integer) es_hora_valle",
             f"cast({hol_sql('fecha')} as integer) es_festivo", f"{puente} es_puente"]
    cols += [f"round(hora_num * {m}, 6) hora_mes", f"round(hora_num * {dow}, 6) hora_dia_semana",
             f"{m} * {dow} mes_dia_semana", f"{finde} * {m} fin_semana_mes", f"{temporada} * {dow} temporada_dia_semana"]
    cols += [f"{ap} * {finde} hora_apertura_fin_semana", f"{pico} * {puente} hora_pico_puente",
             f"{puente} * {finde} puente_fin_semana"]
    cols += [f"cast(coalesce(contains(atraccion, '1-URGENT'), false) and {m} = 10 as integer) is_featured_octubre",
             f"cast({m} = 10 as integer) is_octubre", f"cast({m} = 11 as integer) is_noviembre",
             f"cast({m} = 10 and {finde} = 1 as integer) is_octubre_fin_semana",
             f"cast({m} = 11 and {finde} = 1 as integer) is_noviembre_fin_semana"]
    cols += ["cast(coalesce(codigo_clima in (1, 2, 3), false) as integer) es_buen_clima",
             "cast(coalesce(codigo_clima > 3, false) as integer) es_mal_clima"]
    return f"select {', '.join(cols)} from {RO_H}"


@query("features_full_layer", _full_layer_sql())
def features_full(spark, sf):
    """All calendar/hour/weather features of the orders readings in one projection."""
    return rounded(calendar_features(_ord_h(spark, sf), featured="1-URGENT"))

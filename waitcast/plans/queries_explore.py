"""Exploration, top-k, metrics and encoding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from waitcast.functions import calendar as cal
from waitcast.functions.hours import parse_hour
from waitcast.functions.labels import wait_class_bins, wait_class_rule
from waitcast.operators import encode as E
from waitcast.operators import explore as X
from waitcast.operators import metrics as M
from waitcast.plans.catalog import query, rounded
from waitcast.plans.queries_features import hour_sql, season_sql
from waitcast.plans.queries_history import SPLIT_SQL
from waitcast.sources import tables as tb

FEATURED = "1-URGENT"
RIDE = "1-URGENT_3"
ROC = (f"(select *, coalesce({hour_sql('hora')}, 12.0) hora_num, cast(trunc(coalesce({hour_sql('hora')}, 12.0)) as integer) hora_int, "
       f"month(fecha) mes, isodow(fecha) - 1 dia_semana_num, year(fecha) anio, day(fecha) dia_mes, "
       f"{season_sql('a', 'month(fecha)')} temporada, "
       f"cast(((month(fecha) * 100 + day(fecha)) in (101, 106, 501, 1012, 1101, 1206, 1208, 1225)) as integer) es_festivo "
       f"from @RO)")


def _oc(spark, sf):
    r = tb.readings_orders(spark, sf).withColumn("hora_num", parse_hour("hora", default=12.0))
    return r.withColumns({"hora_int": F.col("hora_num").cast("int"), "mes": F.month("fecha"),
                          "dia_semana_num": F.weekday("fecha"), "anio": F.year("fecha"), "dia_mes": F.dayofmonth("fecha"),
                          "temporada": cal.season(F.month("fecha")), "es_festivo": cal.is_holiday("fecha").cast("int")})


_DESC_COLS = ["tiempo_espera", "temperatura", "humedad"]


@query("a10_describe", " union all ".join(
    f"select '{c}' column_name, count({c}) count, avg({c}) mean, stddev_samp({c}) std, cast(min({c}) as double) min, "
    f"quantile_cont({c}, 0.25) p25, quantile_cont({c}, 0.5) p50, quantile_cont({c}, 0.75) p75, cast(max({c}) as double) max "
    f"from @RO" for c in _DESC_COLS).replace(" from @RO", " from @RO"))
def a10(spark, sf):
    return rounded(X.describe(tb.readings_orders(spark, sf), _DESC_COLS))


_A11_COLS = ["row_id", "zona", "atraccion", "tiempo_espera", "fecha", "hora", "temperatura", "humedad",
             "codigo_clima", "abierta"]


@query("a11_null_counts", " union all ".join(
    f"select '{c}' column_name, count(*) filter (where {c} is null) nulls from @RO" for c in _A11_COLS))
def a11(spark, sf):
    return X.null_counts(tb.readings_orders(spark, sf).select(*_A11_COLS))


@query("a12_quality_report", "with k as (select * from @RO qualify row_number() over (partition by zona, fecha order by row_id) = 1), "
       "rm as (select count(*) - (select count(*) from (select distinct zona, fecha from @RO)) removed from @RO) " +
       " union all ".join(
           f"select '{c}' column_name, (select count(*) filter (where {c} is null) from k) nulls, "
           f"{'(select removed from rm)' if c == 'tiempo_espera' else '0'} duplicates_removed"
           for c in _A11_COLS))
def a12(spark, sf):
    return X.quality_report(tb.readings_orders(spark, sf).select(*_A11_COLS), ["zona", "fecha"])


@query("a13_value_counts", "select codigo_clima, count(*) n from @RO group by codigo_clima")
def a13(spark, sf):
    return X.value_counts(tb.readings_orders(spark, sf), "codigo_clima")


_A14 = {"ride": ["atraccion"], "date": ["fecha"], "ride_date": ["atraccion", "fecha"], "zone_ride": ["zona", "atraccion"],
        "hour": ["hora_int"], "weekday": ["dia_semana_num"], "date_weather": ["fecha", "codigo_clima"]}


def _a14(name, keys):
    k = ", ".join(keys)

    @query(f"a14_mean_by_{name}", f"select {k}, round(avg(tiempo_espera), 6) mean_wait from {ROC} group by {k}")
    def q(spark, sf):
        return rounded(X.mean_by(_oc(spark, sf), keys))
    q.__doc__ = f"A14/K3: mean wait by {k}, ordered by the mean."
    return q


for _n, _k in _A14.items():
    _a14(_n, _k)


@query("a15_mean_weekday_holiday",
       f"select dia_semana_num, es_festivo, round(avg(tiempo_espera), 6) mean_wait from {ROC} group by all")
def a15(spark, sf):
    return rounded(X.mean_by(_oc(spark, sf), ["dia_semana_num", "es_festivo"]))


@query("a15_mean_weekday_holiday_pivot",
       f"select dia_semana_num, round(avg(tiempo_espera) filter (where es_festivo = 0), 6) \"0\", "
       f"round(avg(tiempo_espera) filter (where es_festivo = 1), 6) \"1\" from {ROC} group by dia_semana_num")
def a15p(spark, sf):
    return rounded(X.mean_pivot(_oc(spark, sf), "dia_semana_num", "es_festivo", [0, 1]))


_CORR = ["tiempo_espera", "temperatura", "humedad", "codigo_clima", "hora_num"]


@query("a16_correlation", " union all ".join(
    f"select '{a}' col_a, '{b}' col_b, round(corr({a}, {b}), 6) corr from {ROC}"
    for i, a in enumerate(_CORR) for b in _CORR[i + 1:]))
def a16(spark, sf):
    return rounded(X.correlation_pairs(_oc(spark, sf), _CORR))


@query("a17_histogram", """
with r as (select tiempo_espera x from @RE where tiempo_espera is not null),
b as (select min(x) mn, max(x) mx from r),
h as (select cast(least(floor((x - mn) / (mx - mn) * 20), 19) as integer) bin, mn, mx from r, b)
select bin, round(mn + bin * ((mx - mn) / 20), 6) lo, round(mn + (bin + 1) * ((mx - mn) / 20), 6) hi, count(*) n
from h group by bin, mn, mx""")
def a17(spark, sf):
    return rounded(X.histogram(tb.readings_events(spark, sf), "tiempo_espera", 20))


def _box_sql(keys: list[str]) -> str:
    k = ", ".join(keys)
    kc = (k + ", ") if keys else ""
    gb = f" group by {k}" if keys else ""
    on = " and ".join(f"r.{x} = q.{x}" for x in keys) or "true"
    return f"""with r as (select * from @RE where tiempo_espera is not null),
q as (select {kc}quantile_cont(tiempo_espera, 0.25) q1, median(tiempo_espera) median, quantile_cont(tiempo_espera, 0.75) q3
      from r{gb})
select {', '.join('q.' + x for x in keys) + ', ' if keys else ''}round(q1, 6) q1, round(median, 6) median, round(q3, 6) q3,
       round(min(case when tiempo_espera >= q1 - 1.5 * (q3 - q1) and tiempo_espera <= q3 + 1.5 * (q3 - q1) then tiempo_espera end), 6) whisker_lo,
       round(max(case when tiempo_espera >= q1 - 1.5 * (q3 - q1) and tiempo_espera <= q3 + 1.5 * (q3 - q1) then tiempo_espera end), 6) whisker_hi,
       count(*) filter (where not (tiempo_espera >= q1 - 1.5 * (q3 - q1) and tiempo_espera <= q3 + 1.5 * (q3 - q1))) n_outliers
from r join q on {on} group by {', '.join('q.' + x for x in keys) + ', ' if keys else ''}q1, median, q3"""


@query("a18_box_summary_global", _box_sql([]))
def a18g(spark, sf):
    return rounded(X.box_summary(tb.readings_events(spark, sf)))


@query("a18_box_summary_by_ride", _box_sql(["atraccion"]))
def a18r(spark, sf):
    return rounded(X.box_summary(tb.readings_events(spark, sf), ["atraccion"]))


@query("a19_month_comparison", """
select atraccion, count(tiempo_espera) n, round(avg(tiempo_espera), 6) mean_wait, max(tiempo_espera) max_wait,
       min(tiempo_espera) min_wait, count(distinct fecha) n_dates
from @RO where month(fecha) = 10 group by atraccion order by mean_wait desc, atraccion limit 10""")
def a19(spark, sf):
    return rounded(X.month_comparison(tb.readings_orders(spark, sf), 10, 10))


@query("a20_weekend_vs_weekday", f"""
select cast(isodow(fecha) - 1 in (5, 6) as integer) es_fin_de_semana, count(tiempo_espera) n,
       round(avg(tiempo_espera), 6) mean_wait, round(stddev_samp(tiempo_espera), 6) std_wait,
       min(tiempo_espera) min_wait, max(tiempo_espera) max_wait
from @RO where contains(atraccion, '{FEATURED}') and month(fecha) = 10 group by 1""")
def a20(spark, sf):
    r = tb.readings_orders(spark, sf).where(F.col("atraccion").contains(FEATURED) & (F.month("fecha") == 10))
    return rounded(X.weekend_vs_weekday(r))


def _np_round_sql(x: str) -> str:
    y = f"(({x}) * 10)"
    return f"((case when abs({y} - trunc({y})) = 0.5 then 2 * round({y} / 2) else round({y}) end) / 10)"


def _profile(by: str, name: str):
    @query(f"a21_ride_profile_{name}", f"select {by}, {_np_round_sql('avg(tiempo_espera)')} mean_wait, count(tiempo_espera) n "
           f"from {ROC} where atraccion = '{RIDE}' group by {by}")
    def q(spark, sf):
        return rounded(X.ride_profile(_oc(spark, sf), RIDE, by))
    q.__doc__ = f"A21/A23: one ride by {by}: mean (pandas rounding) and count."
    return q


_profile("dia_semana_num", "weekday")
_profile("hora_int", "hour")
_profile("dia_mes", "day_of_month")


@query("a23_ride_describe", " union all ".join(
    f"select '{c}' column_name, count({c}) count, avg({c}) mean, stddev_samp({c}) std, cast(min({c}) as double) min, "
    f"quantile_cont({c}, 0.25) p25, quantile_cont({c}, 0.5) p50, quantile_cont({c}, 0.75) p75, cast(max({c}) as double) max "
    f"from (select * from {ROC} where atraccion = '{RIDE}')" for c in ["tiempo_espera", "dia_mes"]))
def a23(spark, sf):
    """Describe (count, mean, std, min, quartiles, max) of one ride's wait and day of month."""
    r = _oc(spark, sf).where(F.col("atraccion") == RIDE).withColumn("dia_mes", F.col("dia_mes").cast("double"))
    return rounded(X.describe(r, ["tiempo_espera", "dia_mes"]))


@query("a22_month_profile", f"select mes, min(temporada) temporada, round(avg(tiempo_espera), 6) mean_wait from {ROC} group by mes")
def a22(spark, sf):
    return rounded(X.month_profile(_oc(spark, sf)))


@query("a24_data_volume", f"""
select atraccion, anio, mes, count(*) n, case when count(*) < 10 then 'limited' else 'sufficient' end volumen
from {ROC} group by atraccion, anio, mes""")
def a24(spark, sf):
    g = _oc(spark, sf).groupBy("atraccion", "anio", "mes").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("volumen", X.volume_rule(F.col("n")))


@query("a25_headline_counts", "select count(distinct atraccion) n_rides, count(distinct zona) n_zones, count(*) n_rows from @RO")
def a25(spark, sf):
    return X.headline_counts(tb.readings_orders(spark, sf))


@query("a26_distinct_rides", "select distinct atraccion from @RO where atraccion is not null order by 1")
def a26r(spark, sf):
    return X.distinct_sorted(tb.readings_orders(spark, sf), "atraccion")


@query("a26_distinct_zones", "select distinct zona from @RO where zona is not null order by 1")
def a26z(spark, sf):
    return X.distinct_sorted(tb.readings_orders(spark, sf), "zona")


@query("a26_distinct_dates", "select distinct fecha from @RE where fecha is not null order by 1")
def a26d(spark, sf):
    return X.distinct_sorted(tb.readings_events(spark, sf), "fecha")


@query("a28_class_distribution", """
select case when tiempo_espera between 5 and 15 then 'Corto' when tiempo_espera > 15 and tiempo_espera <= 45 then 'Medio'
            when tiempo_espera is not null then 'Largo' end clase, count(*) n from @RO group by 1""")
def a28(spark, sf):
    return X.class_distribution(tb.readings_orders(spark, sf))


@query("k1_top_rides_by_mean", """
select atraccion, round(avg(tiempo_espera), 6) mean_wait from @RO group by atraccion order by mean_wait desc, atraccion limit 10""")
def k1(spark, sf):
    g = rounded(X.mean_by(tb.readings_orders(spark, sf), ["atraccion"]))
    return X.top_k(g, [F.desc("mean_wait"), F.asc("atraccion")], 10)


@query("k4_head_ordered", "select row_id, fecha, atraccion from @RO order by fecha, row_id limit 5")
def k4(spark, sf):
    return X.top_k(tb.readings_orders(spark, sf).select("row_id", "fecha", "atraccion"), [F.col("fecha"), F.col("row_id")], 5)


# ---- splits and encodings ---------------------------------------------------

@query("m1_hash_split", f"""
select row_id, {SPLIT_SQL} is_train,
       case when not {SPLIT_SQL} then 'test'
            when ((((row_id + 7919) % 2147483648) * 2654435761) % 4294967296 < 0.8 * 4294967296) then 'fit' else 'val' end part
from @RO""")
def m1(spark, sf):
    o = tb.readings_orders(spark, sf).select("row_id")
    tr = E.hash_split_flag("row_id", 0.8)
    fit = E.hash_split_flag("row_id", 0.8, seed=7919)
    return o.select("row_id", tr.alias("is_train"),
                    F.when(~tr, F.lit("test")).when(fit, F.lit("fit")).otherwise(F.lit("val")).alias("part"))


@query("m2_stratified_split", f"""
with r as (select row_id, {season_sql('a', 'month(fecha)')} temporada, month(fecha) mes,
                  ((row_id % 2147483648) * 2654435761) % 4294967296 u from @RO)
select row_id, row_number() over (partition by temporada, mes order by u, row_id)
       <= ceil(0.8 * count(*) over (partition by temporada, mes)) is_train from r""")
def m2(spark, sf):
    """M2: exact 80/20 per (season, month) stratum without a window over whole strata."""
    o = tb.readings_orders(spark, sf).select("row_id", cal.season(F.month("fecha")).alias("temporada"),
                                             F.month("fecha").alias("mes"))
    return E.stratified_split(o, "row_id", ["temporada", "mes"]).select("row_id", "is_train")


def _strat_query(name: str, strata_sql: str, strata_cols, doc: str):
    @query(name, f"""
with r as (select row_id, {strata_sql}, ((row_id % 2147483648) * 2654435761) % 4294967296 u from @RO)
select row_id, row_number() over (partition by {', '.join(c for c in strata_cols)} order by u, row_id)
       <= ceil(0.8 * count(*) over (partition by {', '.join(strata_cols)})) is_train from r""")
    def q(spark, sf):
        o = tb.readings_orders(spark, sf)
        cols = {"atraccion": F.col("atraccion"), "mes": F.month("fecha"),
                "clase": wait_class_rule("tiempo_espera"), "temporada": cal.season(F.month("fecha"))}
        o = o.select("row_id", *[cols[c].alias(c) for c in strata_cols])
        return E.stratified_split(o, "row_id", list(strata_cols)).select("row_id", "is_train")
    q.__doc__ = doc
    return q


_CLASS_SQL = ("case when tiempo_espera between 5 and 15 then 'Corto' when tiempo_espera > 15 and tiempo_espera <= 45 "
              "then 'Medio' when tiempo_espera is not null then 'Largo' end clase")
_strat_query("m2_stratified_split_ride_month", "atraccion, month(fecha) mes", ["atraccion", "mes"],
             "M2: exact 80/20 per (ride, month) stratum.")
_strat_query("m2_stratified_split_class", _CLASS_SQL, ["clase"], "M2: exact 80/20 per wait class.")
_strat_query("m2_stratified_split_season", f"{season_sql('a', 'month(fecha)')} temporada", ["temporada"],
             "M2: exact 80/20 per season.")


_TE_SQL = f"""with o as (select * from @RO), tr as (select * from o where {SPLIT_SQL} and tiempo_espera is not null),
te as (select * from o where not {SPLIT_SQL}), g as (select avg(tiempo_espera) g from tr)"""


@query("m3_target_encoding", _TE_SQL + """,
ez as (select zona, avg(tiempo_espera) m from tr group by zona), ea as (select atraccion, avg(tiempo_espera) m from tr group by atraccion)
select te.row_id, round(coalesce(ez.m, g.g), 6) zona_enc, round(coalesce(ea.m, g.g), 6) atraccion_enc
from te left join ez using (zona) left join ea using (atraccion) cross join g""")
def m3(spark, sf):
    o = tb.readings_orders(spark, sf)
    tr, te = E.hash_split(o, "row_id")
    out = E.target_mean_encoding(te, tr, "zona")
    out = E.target_mean_encoding(out, tr, "atraccion")
    return rounded(out.select("row_id", "zona_enc", "atraccion_enc"))


@query("m4_smoothed_target_encoding", _TE_SQL + """,
ez as (select zona, (count(*) * avg(tiempo_espera) + 10 * (select g from g)) / (count(*) + 10) m from tr group by zona),
ea as (select atraccion, (count(*) * avg(tiempo_espera) + 10 * (select g from g)) / (count(*) + 10) m from tr group by atraccion)
select te.row_id, round(coalesce(ez.m, g.g), 6) zona_enc, round(coalesce(ea.m, g.g), 6) atraccion_enc
from te left join ez using (zona) left join ea using (atraccion) cross join g""")
def m4(spark, sf):
    o = tb.readings_orders(spark, sf)
    tr, te = E.hash_split(o, "row_id")
    out = E.target_mean_encoding(te, tr, "zona", smoothing=E.SMOOTHING)
    out = E.target_mean_encoding(out, tr, "atraccion", smoothing=E.SMOOTHING)
    return rounded(out.select("row_id", "zona_enc", "atraccion_enc"))


@query("m5_ride_hour_encoding", f"""with o as {ROC}, tr as (select * from o where {SPLIT_SQL} and tiempo_espera is not null),
te as (select * from o where not {SPLIT_SQL}),
e as (select atraccion, hora_int, avg(tiempo_espera) m from tr where contains(atraccion, '{FEATURED}') group by all)
select te.row_id, round(e.m, 6) featured_hora_enc from te left join e using (atraccion, hora_int)""")
def m5(spark, sf):
    o = _oc(spark, sf)
    tr, te = E.hash_split(o, "row_id")
    return rounded(E.ride_hour_encoding(te, tr, FEATURED).select("row_id", "featured_hora_enc"))


@query("m6_frequency_encoding", _TE_SQL + """,
fz as (select zona, count(*) zona_freq from tr group by zona), fa as (select atraccion, count(*) atraccion_freq from tr group by atraccion)
select te.row_id, coalesce(zona_freq, 0) zona_freq, coalesce(atraccion_freq, 0) atraccion_freq
from te left join fz using (zona) left join fa using (atraccion)""")
def m6(spark, sf):
    from waitcast.operators.joins import frequency_lookup
    o = tb.readings_orders(spark, sf)
    tr, te = E.hash_split(o, "row_id")
    tr = tr.where(F.col("tiempo_espera").isNotNull())
    out = frequency_lookup(frequency_lookup(te, tr, "zona"), tr, "atraccion")
    return out.select("row_id", "zona_freq", "atraccion_freq")


@query("m7_one_hot", _TE_SQL + " select te.row_id, " + ", ".join(
    f"cast(coalesce(zona = '{z}', false) as integer) zona_{z.replace('-', '_').replace(' ', '_')}"
    for z in ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]) + " from te")
def m7(spark, sf):
    """M7: one-hot of the zone, categories learned from the train rows."""
    o = tb.readings_orders(spark, sf)
    tr, te = E.hash_split(o, "row_id")
    out = E.one_hot(te, tr, "zona")
    return out.select("row_id", *[c for c in out.columns if c.startswith("zona_")])


# ---- metrics over the stand-in predictions ----------------------------------

PRED_SQL = _TE_SQL + """, enc as (select atraccion, avg(tiempo_espera) m from tr group by atraccion),
pr as (select te.row_id, te.atraccion, month(te.fecha) mes, te.tiempo_espera y, coalesce(enc.m, g.g) pred
       from te left join enc using (atraccion) cross join g where te.tiempo_espera is not null)"""


def predictions(spark, sf):
    """Test rows with the stand-in model's prediction (ride mean over train rows)."""
    o = tb.readings_orders(spark, sf)
    tr, te = E.hash_split(o, "row_id")
    p = E.target_mean_encoding(te.where(F.col("tiempo_espera").isNotNull()), tr, "atraccion", name="pred")
    return p.select("row_id", "atraccion", F.month("fecha").alias("mes"), F.col("tiempo_espera").alias("y"), "pred")


@query("m14_regression_metrics", PRED_SQL + """
select count(*) n, round(avg((y - pred) * (y - pred)), 6) mse, round(sqrt(avg((y - pred) * (y - pred))), 6) rmse,
       round(avg(abs(y - pred)), 6) mae,
       round(1 - sum((y - pred) * (y - pred)) / sum((y - (select avg(y) from pr)) * (y - (select avg(y) from pr))), 6) r2,
       round(avg(cast(abs(y - pred) <= 5 as double)) * 100, 6) within_5,
       round(avg(cast(abs(y - pred) <= 10 as double)) * 100, 6) within_10,
       round(avg(cast(abs((y - pred) / greatest(y, 1)) <= 0.15 as double)) * 100, 6) within_15pct,
       round(avg(cast(abs((y - pred) / greatest(y, 1)) <= 0.2 as double)) * 100, 6) within_20pct,
       round(avg(abs((y - pred) / greatest(y, 1))) * 100, 6) mape from pr""")
def m14(spark, sf):
    """M14 + M15: regression and tolerance metrics in one aggregate."""
    return rounded(M.regression_metrics(predictions(spark, sf)))


@query("m16_per_ride_errors", PRED_SQL + """
select atraccion, count(*) n, round(avg(y), 6) mean_real, round(avg(pred), 6) mean_pred, round(avg(abs(y - pred)), 6) mae
from pr group by atraccion having count(*) > 3""")
def m16(spark, sf):
    return rounded(M.per_group_errors(predictions(spark, sf), ["atraccion"]))


@query("m16_per_ride_month_errors", PRED_SQL + """
select atraccion, mes, count(*) n, round(avg(y), 6) mean_real, round(avg(pred), 6) mean_pred, round(avg(abs(y - pred)), 6) mae
from pr group by atraccion, mes having count(*) > 3""")
def m16m(spark, sf):
    return rounded(M.per_group_errors(predictions(spark, sf), ["atraccion", "mes"]))


@query("m16_high_wait_cases", PRED_SQL + f"""
select row_id, y, round(pred, 6) pred from pr where contains(atraccion, '{FEATURED}') and y > 40""")
def m16h(spark, sf):
    p = predictions(spark, sf).where(F.col("atraccion").contains(FEATURED))
    return rounded(M.high_wait_cases(p).select("row_id", "y", "pred"))


@query("m17_error_by_bins", PRED_SQL + """,
b as (select min(y) mn, max(y) mx from pr),
k as (select cast(greatest(1, ceil((y - mn) / ((mx - mn) / 5))) as integer) bin, mn, mx, abs(y - pred) ae from pr, b)
select bin, round(mn + (bin - 1) * ((mx - mn) / 5), 6) lo, round(mn + bin * ((mx - mn) / 5), 6) hi, count(*) n,
       round(avg(ae), 6) mean_abs_error from k group by bin, mn, mx""")
def m17(spark, sf):
    return rounded(M.error_by_target_bins(predictions(spark, sf)))


_CLS_SQL = PRED_SQL + """,
cm as (select case when y between 5 and 15 then 'Corto' when y > 15 and y <= 45 then 'Medio' else 'Largo' end actual,
              case when pred between 0 and 15 then 'Corto' when pred > 15 and pred <= 45 then 'Medio' when pred > 45 then 'Largo' end predicted
       from pr),
conf as (select actual, predicted, count(*) n from cm group by all),
cls as (select actual k from conf union select predicted from conf),
rep as (select k clase,
               coalesce((select sum(n) from conf where actual = k and predicted = k), 0) tp,
               coalesce((select sum(n) from conf where actual = k), 0) support,
               coalesce((select sum(n) from conf where predicted = k), 0) n_pred from cls),
rep2 as (select clase, case when n_pred > 0 then tp / n_pred else 0.0 end "precision",
                case when support > 0 then tp / support else 0.0 end recall, support from rep),
rep3 as (select *, case when "precision" + recall > 0 then 2 * "precision" * recall / ("precision" + recall) else 0.0 end f1 from rep2)"""


@query("m19_confusion_matrix", _CLS_SQL + " select actual, predicted, n from conf")
def m19(spark, sf):
    p = predictions(spark, sf)
    return M.confusion(p, wait_class_rule("y"), wait_class_bins("pred"))


@query("m20_per_class_report", _CLS_SQL +
       ' select clase, round("precision", 6) "precision", round(recall, 6) recall, round(f1, 6) f1, support from rep3')
def m20(spark, sf):
    p = predictions(spark, sf)
    return rounded(M.per_class_report(M.confusion(p, wait_class_rule("y"), wait_class_bins("pred"))))


@query("m18_classification_metrics", _CLS_SQL + """,
tot as (select sum(n) n, sum(n) filter (where actual = predicted) tp from conf),
pe as (select sum(a.ra * b.ca) pe from (select actual k, sum(n) ra from conf group by 1) a
       join (select predicted k, sum(n) ca from conf group by 1) b using (k))
select round(tp / n, 6) accuracy, round((select avg("precision") from rep3), 6) macro_precision,
       round((select avg(recall) from rep3), 6) macro_recall, round((select avg(f1) from rep3), 6) macro_f1,
       round((tp / n - pe / (n * n)) / (1 - pe / (n * n)), 6) kappa from tot, pe""")
def m18(spark, sf):
    p = predictions(spark, sf)
    return rounded(M.classification_metrics(M.confusion(p, wait_class_rule("y"), wait_class_bins("pred"))))


@query("m24_residuals", PRED_SQL + " select row_id, round(y - pred, 6) residual, round(abs(y - pred), 6) abs_error from pr")
def m24(spark, sf):
    return rounded(M.residuals(predictions(spark, sf)).select("row_id", "residual", "abs_error"))

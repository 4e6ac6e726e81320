"""History queries (A1-A9) and history/encoding lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from waitcast.functions.hours import parse_hour
from waitcast.operators import encode as E
from waitcast.operators import history as H
from waitcast.operators import joins as J
from waitcast.plans.catalog import query, rounded
from waitcast.plans.features import basic_calendar
from waitcast.sources import files as FS
from waitcast.sources import tables as tb
from waitcast.operators.scalars import with_scalars
from waitcast.streaming import histories as HS

RL_CAL = "(select *, month(fecha) mes, isodow(fecha) - 1 dia_semana_num from @RL)"
_AGG_SQL = {
    "count": "count(tiempo_espera)",
    "mean": "round(avg(tiempo_espera), 6)",
    "median": "round(median(tiempo_espera), 6)",
    "std": "round(stddev_samp(tiempo_espera), 6)",
    "p25": "round(quantile_cont(tiempo_espera, 0.25), 6)",
    "p75": "round(quantile_cont(tiempo_espera, 0.75), 6)",
    "p90": "round(quantile_cont(tiempo_espera, 0.9), 6)",
    "p95": "round(quantile_cont(tiempo_espera, 0.95), 6)",
}


def history_sql(keys: list[str], stats: list[str], suffix: str, src: str = RL_CAL) -> str:
    cols = ", ".join(f"{_AGG_SQL[s]} {s}_{suffix}" if suffix else f"{_AGG_SQL[s]} {s}" for s in stats)
    k = ", ".join(keys)
    if keys:
        return f"select {k}, {cols} from {src} where tiempo_espera is not null group by {k}"
    return f"select {cols} from {src} where tiempo_espera is not null"


def _rl(spark, sf):
    return basic_calendar(tb.readings_lineitem(spark, sf))


def _grain_query(grain: str, aid: str):
    keys, stats = H.GRAINS[grain]

    @query(f"{aid}_history_{'_'.join(['ride'] + [k.replace('hora_int', 'hour').replace('dia_semana_num', 'weekday').replace('mes', 'month') for k in keys[1:]])}",
           history_sql(keys, stats, grain))
    def q(spark, sf):
        return rounded(H.grain_history(_rl(spark, sf), grain))
    q.__doc__ = f"{aid.upper()}: history by {' x '.join(keys)} over the lineitem readings."
    return q


for _g, _aid in [("mes", "a1"), ("hora", "a2"), ("dia", "a3"), ("mes_dia", "a4"), ("hora_dia", "a5"), ("mes_hora", "a6")]:
    _grain_query(_g, _aid)


def _a7_sql() -> str:
    parts = []
    for g, keys in H.CASCADE_GRAINS.items():
        sel = ", ".join(k if k in keys else f"cast(null as {'varchar' if k == 'atraccion' else 'integer'}) {k}"
                        for k in H.KEYS)
        stats = ", ".join(f"{_AGG_SQL[s]} {n}" for s, n in
                          [("count", "n"), ("mean", "mean"), ("std", "std"), ("p25", "p25"), ("median", "p50"),
                           ("p75", "p75"), ("p90", "p90"), ("p95", "p95")])
        gb = f" group by {', '.join(keys)}" if keys else ""
        parts.append(f"select '{g}' grain, {sel}, {stats} from {RL_CAL} where tiempo_espera is not null{gb}")
    return " union all ".join(parts)


@query("a7_history_all_grains", _a7_sql())
def a7(spark, sf):
    """All nine cascade grains in one pass (pre-count + GROUPING SETS)."""
    return rounded(H.all_histories(_rl(spark, sf)))


@query("a7_history_from_batches", _a7_sql())
def a7b(spark, sf):
    """A1-A9 kept up to date: the readings come in three batches, the second one twice, and each merges its counts into the
    persisted ones; histories of touched parts are derived anew. Equal to the histories of all readings at once."""
    state = HS.HistoryState(FS.staging_dir(spark, "histories"), buckets=8)
    rows = _rl(spark, sf).select("fecha", *H.KEYS, H.WAIT)
    for batch in (0, 1, 1, 2):
        state(rows.where(F.pmod(F.xxhash64("fecha", "hora_int"), F.lit(3)) == batch), batch)
    return rounded(HS.read_histories(spark, state.path))


@query("a8_reduced_history_month", history_sql(["atraccion", "mes"], ["count", "median", "p75", "p90"], "mes"))
def a8m(spark, sf):
    return rounded(H.reduced_histories(_rl(spark, sf))["mes"])


@query("a8_reduced_history_hour", history_sql(["atraccion", "hora_int"], ["count", "median", "p75"], "hora"))
def a8h(spark, sf):
    return rounded(H.reduced_histories(_rl(spark, sf))["hora"])


@query("a9_global_stats", "select count(tiempo_espera) n, " + ", ".join(
    f"{_AGG_SQL[s]} {s}" for s in ["mean", "median", "std", "p75", "p90", "p95"]) +
    f" from {RL_CAL} where tiempo_espera is not null")
def a9(spark, sf):
    return rounded(H.global_stats(_rl(spark, sf)))


# ---- leakage-free history features: fit on train rows, attach to test rows ----

SPLIT_SQL = "(((row_id % 2147483648) * 2654435761) % 4294967296 < 0.8 * 4294967296)"
RO_FEAT_SQL = f"""(select *, cast(trunc(coalesce(case when instr(trim(hora), ':') > 0 then
      trunc(try_cast(split_part(trim(hora), ':', 1) as double)) + trunc(try_cast(split_part(trim(hora), ':', 2) as double)) / 60.0
      else trunc(try_cast(trim(hora) as double)) end, 12.0)) as integer) hora_int,
      month(fecha) mes, isodow(fecha) - 1 dia_semana_num, {SPLIT_SQL} is_train from @RO)"""


_HN = ("(case when instr(trim(hora), ':') > 0 then trunc(try_cast(split_part(trim(hora), ':', 1) as double)) "
       "+ trunc(try_cast(split_part(trim(hora), ':', 2) as double)) / 60.0 else trunc(try_cast(trim(hora) as double)) end)")
_RO_HN = f"(select *, {_HN} hn, {SPLIT_SQL} is_train, month(fecha) mes, isodow(fecha) - 1 dia_semana_num from @RO)"
# training rows: unparsable hours -> median hour of the train rows
RO_TRAINFEAT_SQL = (f"(select o.*, cast(trunc(coalesce(hn, m.med)) as integer) hora_int from {_RO_HN} o, "
                    f"(select median(hn) med from {_RO_HN} where is_train and tiempo_espera is not null) m)")


def orders_split(spark, sf, hours: str = "training"):
    """Orders readings with the hash split flag. ``hours="training"``: unparsable hours take
    the median hour of the train rows; ``"requests"``: 12.0, as for prediction requests."""
    r = basic_calendar(tb.readings_orders(spark, sf)).withColumn("is_train", E.hash_split_flag("row_id", 0.8))
    r = r.withColumn("hora_num", parse_hour("hora"))
    if hours == "requests":
        r = r.withColumn("hora_num", F.coalesce(F.col("hora_num"), F.lit(12.0)))
    else:
        from waitcast.operators.history import column_percentiles
        med = column_percentiles(r.where("is_train and tiempo_espera is not null"), ["hora_num"], [0.5],
                                 "_m_").checkpoint(eager=True)          # one row, computed once
        r = with_scalars(r, med).withColumn(
            "hora_num", F.coalesce(F.col("hora_num"), F.col("_m_hora_num__0"))).drop("_m_hora_num__0")
    return r.withColumn("hora_int", F.col("hora_num").cast("int")).drop("hora_num")


def _j1_sql(all_rows: bool = False) -> str:
    te = f"te as (select * from {RO_FEAT_SQL})" if all_rows else "te as (select * from o where not is_train)"
    ctes = [f"o as {RO_TRAINFEAT_SQL}", "tr as (select * from o where is_train)", te,
            "g as (select avg(tiempo_espera) mean, median(tiempo_espera) median, stddev_samp(tiempo_espera) std, "
            "quantile_cont(tiempo_espera, 0.75) p75, quantile_cont(tiempo_espera, 0.9) p90, "
            "quantile_cont(tiempo_espera, 0.95) p95 from tr where tiempo_espera is not null)"]
    joins, cols = [], []
    raw = {"count": "count(tiempo_espera)", "mean": "avg(tiempo_espera)", "median": "median(tiempo_espera)",
           "std": "stddev_samp(tiempo_espera)", "p75": "quantile_cont(tiempo_espera, 0.75)",
           "p90": "quantile_cont(tiempo_espera, 0.9)", "p95": "quantile_cont(tiempo_espera, 0.95)"}
    for g, (keys, stats) in H.GRAINS.items():
        k = ", ".join(keys)
        ctes.append(f"h_{g} as (select {k}, " + ", ".join(f"{raw[s]} {s}_{g}" for s in stats) +
                    f" from tr where tiempo_espera is not null group by {k})")
        joins.append(f"left join h_{g} using ({k})")
        for s in stats:
            c = f"{s}_{g}"
            cols.append(f"coalesce({c}, 0) {c}" if s == "count" else f"round(coalesce({c}, g.{s}), 6) {c}")
    return ("with " + ", ".join(ctes) + " select te.row_id, " + ", ".join(cols) +
            " from te " + " ".join(joins) + " cross join g")


@query("j1_attach_histories", _j1_sql())
def j1(spark, sf):
    """J1 + F19: six ride histories fitted on train rows, attached to test rows, and
    missing values filled by column family from train-wide statistics."""
    o = orders_split(spark, sf)
    tr, te = o.where("is_train"), o.where("not is_train")
    out = J.attach_and_fill(te, tr)
    stat_cols = [f"{s}_{g}" for g, (_, stats) in H.GRAINS.items() for s in stats]
    return rounded(out.select("row_id", *stat_cols))


@query("j10_ride_zone_lookup", "select atraccion, min(zona) zona from @RE where zona is not null group by atraccion")
def j10(spark, sf):
    return J.ride_zone_lookup(tb.readings_events(spark, sf))


@query("j11_frequency_lookup", f"""
with o as {RO_FEAT_SQL}, f as (select atraccion, count(*) atraccion_freq from o where is_train group by atraccion)
select row_id, atraccion, coalesce(atraccion_freq, 0) atraccion_freq from o left join f using (atraccion) where not is_train""")
def j11(spark, sf):
    o = orders_split(spark, sf)
    tr, te = o.where("is_train"), o.where("not is_train")
    return J.frequency_lookup(te.select("row_id", "atraccion"), tr, "atraccion")


@query("j9_request_history_features", _j1_sql(all_rows=True))
def j9(spark, sf):
    """Every orders row as a prediction request (bad hour -> 12): the six history
    feature groups fitted on train rows, with family defaults (F19) where a request has no history."""
    o = orders_split(spark, sf, hours="requests")
    tr = orders_split(spark, sf).where("is_train")
    out = J.attach_and_fill(o, tr)
    stat_cols = [f"{s}_{g}" for g, (_, stats) in H.GRAINS.items() for s in stats]
    return rounded(out.select("row_id", *stat_cols))


@query("j2_target_encoding_lookup", f"""
with o as {RO_FEAT_SQL}, tr as (select * from o where is_train and tiempo_espera is not null),
g as (select avg(tiempo_espera) g from tr),
ez as (select zona, (count(*) * avg(tiempo_espera) + 10 * (select g from g)) / (count(*) + 10) m from tr group by zona),
ea as (select atraccion, (count(*) * avg(tiempo_espera) + 10 * (select g from g)) / (count(*) + 10) m from tr group by atraccion)
select o.row_id, round(coalesce(ez.m, g.g), 6) zona_enc, round(coalesce(ea.m, g.g), 6) atraccion_enc
from o left join ez using (zona) left join ea using (atraccion) cross join g""")
def j2(spark, sf):
    """Attach the smoothed target encodings (fitted on train rows) to every request;
    unseen or NULL categories fall back to the train mean."""
    o = orders_split(spark, sf)
    tr = o.where("is_train")
    out = E.target_mean_encoding(o, tr, "zona", smoothing=E.SMOOTHING)
    out = E.target_mean_encoding(out, tr, "atraccion", smoothing=E.SMOOTHING)
    return rounded(out.select("row_id", "zona_enc", "atraccion_enc"))

"""History cascade over a table of requests (J6, J7, J8 inputs).

For each request (ride, month, hour, weekday) pick the most specific history
level that has rows, in this order:

    mes_hora_dia -> hora_dia -> mes_hora -> hora -> mes_dia -> dia -> mes -> global

* Nearest hour (J6, T7): when the ride has no rows at the request hour and the
  hour is > 0, hour-1 is tried, then hour+1 (within [0, 24)); the moved hour
  replaces ``hora_int`` for the ride-hour level *and* for the hour band used
  later. Finer levels are not re-tested at the moved hour.
* "Has rows" is ``n > 0`` of the grain in the one-pass history table
  (:func:`waitcast.operators.history.all_histories`). ``pair_check=True``
  reproduces the serving code's test for the top level (ride-month-hour and
  ride-month-weekday both exist) instead of the true triple (T6); the
  statistics then come from the triple, which may be empty.

Each level is a left equi-join of the requests with one grain slice of the
history table (at most one row per key, so no row multiplication). ``hist``
should be materialised (the saved artifact, or a checkpoint — see
``waitcast.plans.scoring.materialized_histories``): the nine slices then scan
it instead of re-running the aggregation nine times. Rows per grain are
counted once (one small aggregate of the materialised table); each slice is
broadcast only when its rows x row width fit the broadcast limit, otherwise
that level stays a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitcast.operators import history as H
from waitcast.operators.joins import grain_counts, size_checked_join
from waitcast.operators.scalars import with_scalars

LEVELS = ["mes_hora_dia", "hora_dia", "mes_hora", "hora", "mes_dia", "dia", "mes"]
HOURLY = ["mes_hora_dia", "hora_dia", "mes_hora", "hora"]
STATS = ["n", "p25", "p50", "p75", "p90"]
_PFX = {"mes_hora_dia": "mhd", "hora_dia": "hd", "mes_hora": "mh", "hora": "h0", "mes_dia": "md", "dia": "d", "mes": "m"}


def _slice(hist: DataFrame, grain: str, prefix: str, hour_key: str = "hora_int") -> DataFrame:
    keys = H.CASCADE_GRAINS[grain]
    s = H.grain_slice(hist, grain)
    cols = [F.col(k).alias(hour_key if k == "hora_int" else k) for k in keys]
    return s.select(*cols, *[F.col(st).alias(f"{prefix}_{st}") for st in STATS])


def _join(df: DataFrame, sl: DataFrame, keys: list[str], n_rows: int | None = None) -> DataFrame:
    if n_rows is None:
        return df.join(sl, on=keys, how="left")
    return size_checked_join(df, sl, keys, "left", n_rows=n_rows)


def global_median(hist: DataFrame) -> DataFrame:
    return hist.where(F.col("grain") == "global").select(F.col("p50").alias("global_median"),
                                                        F.col("mean").alias("global_mean"))


def cascade(requests: DataFrame, hist: DataFrame, pair_check: bool = False, size_check: bool = True) -> DataFrame:
    """Attach per-level statistics and choose the level.

    ``requests`` needs atraccion, mes, hora_int, dia_semana_num. Adds
    ``hora_eff``, ``especificidad`` and ``n_hist, p25_hist, p50_hist, p75_hist,
    p90_hist`` (global median for every statistic and n = 0 at the global level),
    plus ``md_*``/``m_*`` columns reused by the low-history fallback (J8).

    ``size_check``: count rows per grain of the (materialised) history once and
    broadcast each slice only when it fits the broadcast limit; the requests
    then stream through nine hash probes without being shuffled.
    """
    r = requests
    counts = grain_counts(hist) if size_check else {}
    for lvl in LEVELS:
        keys = H.CASCADE_GRAINS[lvl]
        r = _join(r, _slice(hist, lvl, _PFX[lvl]), keys, counts.get(lvl, 0) if size_check else None)
    # neighbour hours of the ride-hour level
    r = r.withColumns({"_hm1": F.col("hora_int") - 1, "_hp1": F.col("hora_int") + 1})
    nh = counts.get("hora", 0) if size_check else None
    r = _join(r, _slice(hist, "hora", "hm1", "_hm1"), ["atraccion", "_hm1"], nh)
    r = _join(r, _slice(hist, "hora", "hp1", "_hp1"), ["atraccion", "_hp1"], nh)
    r = with_scalars(r, global_median(hist))

    h = F.col("hora_int")
    has = {p: F.col(f"{p}_n").isNotNull() for p in ["mhd", "hd", "mh", "h0", "md", "d", "m", "hm1", "hp1"]}
    use_m1 = ~has["h0"] & (h > 0) & has["hm1"]
    use_p1 = ~has["h0"] & (h > 0) & ~has["hm1"] & ((h + 1) < 24) & has["hp1"]
    hour_any = has["h0"] | use_m1 | use_p1
    top = (has["mh"] & has["md"]) if pair_check else has["mhd"]

    espec = (F.when(top, F.lit("mes_hora_dia")).when(has["hd"], F.lit("hora_dia"))
             .when(has["mh"], F.lit("mes_hora")).when(hour_any, F.lit("hora"))
             .when(has["md"], F.lit("mes_dia")).when(has["d"], F.lit("dia"))
             .when(has["m"], F.lit("mes")).otherwise(F.lit("global")))

    def pick(st: str) -> Column:
        hour_val = (F.when(has["h0"], F.col(f"h0_{st}")).when(use_m1, F.col(f"hm1_{st}"))
                    .when(use_p1, F.col(f"hp1_{st}")))
        out = (F.when(F.col("especificidad") == "mes_hora_dia",
                      F.coalesce(F.col(f"mhd_{st}"), F.lit(0) if st == "n" else F.col("global_median")))
               .when(F.col("especificidad") == "hora_dia", F.col(f"hd_{st}"))
               .when(F.col("especificidad") == "mes_hora", F.col(f"mh_{st}"))
               .when(F.col("especificidad") == "hora", hour_val)
               .when(F.col("especificidad") == "mes_dia", F.col(f"md_{st}"))
               .when(F.col("especificidad") == "dia", F.col(f"d_{st}"))
               .when(F.col("especificidad") == "mes", F.col(f"m_{st}")))
        return out.otherwise(F.lit(0) if st == "n" else F.col("global_median"))

    r = r.withColumns({
        "hora_eff": F.when(use_m1, h - 1).when(use_p1, h + 1).otherwise(h),
        "n_hora": F.when(has["h0"], F.col("h0_n")).when(use_m1, F.col("hm1_n")).when(use_p1, F.col("hp1_n")),
        "especificidad": espec,
    })
    r = r.withColumns({f"{st}_hist": pick(st) for st in STATS})
    r = r.withColumn("n_hist", F.col("n_hist").cast("long"))
    drop = [f"{p}_{st}" for p in ["mhd", "hd", "mh", "h0", "d", "hm1", "hp1"] for st in STATS] + ["_hm1", "_hp1"]
    return r.drop(*drop)

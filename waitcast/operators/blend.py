"""Blended prediction: history base and weights, calendar ladder, clamps.

Everything is an ordered ``when`` chain over columns produced by the cascade,
so a whole table of requests is scored in one projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitcast.functions import calendar as cal
from waitcast.functions.labels import clamp, round_half_even
from waitcast.operators.cascade import HOURLY

# ---------------------------------------------------------------------------
# Fixed values of the reference's scoring rules.
# ---------------------------------------------------------------------------
# (history weight, model weight) per case of B1/B2
W_OPENING = (0.80, 0.20)
W_PEAK = (0.70, 0.30)
W_OTHER = (0.75, 0.25)
W_EMPTY = (0.60, 0.40)
W_NO_HOURLY = (0.40, 0.60)
W_LOW_STILL_LOW = (0.30, 0.70)
W_LOW_RESCUED = (0.50, 0.50)
LOW_P75, LOW_N, OPENING_MIN_N = 15, 20, 10
# Calendar ladder multipliers
OPENING_MULT = {"weekend": 0.50, "workday": 0.60}
BRIDGE_MULT = {"weekend": 1.15, "workday": 1.10}
OCT_SUNDAY_PEAK, NOV_SUNDAY_PEAK, PEAK_MULT, VALLEY_MULT = 1.10, 1.08, 1.05, 0.90
# Featured ride in its month: the largest of these multiples of the model, the blend, the history
# base and the p75, and a floor in minutes. "low" rules hold below the thresholds.
FEATURED_LOW_PEAK, FEATURED_LOW_OTHER = 15, 10
FEATURED_WEEKEND_PEAK_LOW = {"pred": 1.50, "comb": 1.40, "floor": 25.0}
FEATURED_WEEKEND_PEAK = {"comb": 1.30, "p75": 1.25, "base": 1.35, "pred": 1.25}
FEATURED_WEEKEND_LOW = {"pred": 1.30, "comb": 1.20, "floor": 15.0}
FEATURED_WEEKEND = {"comb": 1.20, "base": 1.25}
FEATURED_WORKDAY_PEAK_LOW = {"pred": 1.35, "comb": 1.25, "floor": 20.0}
FEATURED_WORKDAY_PEAK = {"comb": 1.15, "base": 1.20}
FEATURED_WORKDAY = {"comb": 1.10, "base": 1.15}
FEATURED_TRAIN_PEAK = {"comb": 1.0, "base": 1.20}
FEATURED_TRAIN = {"comb": 1.0, "base": 1.10}
# Serverless variant: a result under 1 minute becomes this share of the global median, or the floor
RESCUE_SHARE, RESCUE_FLOOR = 0.5, 5.0
# Share of p90 for the featured ride; p90 above this multiple of the model is averaged in
SIMPLE_FEATURED_SHARE, SIMPLE_RATIO = 0.8, 1.5
FEATURED_LABEL = "batman_octubre"     # label prefix the reference uses for the featured-ride rule
# ---------------------------------------------------------------------------


def _band_cols(hour: Column) -> dict[str, Column]:
    return {"es_hora_apertura": (hour >= 10) & (hour < 11),
            "es_hora_pico": (hour >= 11) & (hour <= 16),
            "es_hora_valle": (hour < 10) | (hour > 18)}


def history_base(df: DataFrame, low_fallback: bool = True) -> DataFrame:
    """B1 + J8 + B2: base history value, history/model weights, final specificity label.

    ``low_fallback=False`` is the training script's form, which has no rule for suspiciously low
    histories: a peak hour always takes p75.

    Needs the cascade columns and ``pred_base``. Adds ``hist_base``, ``w_hist``,
    ``w_model``, ``pred_combinada`` and rewrites ``especificidad`` when the
    low-history fallback fires (the cascade's own label is kept in ``_espec0``).
    """
    d = df.withColumns(_band_cols(F.col("hora_eff"))).withColumn("_espec0", F.col("especificidad"))
    n, p25, p50, p75 = F.col("n_hist"), F.col("p25_hist"), F.col("p50_hist"), F.col("p75_hist")
    hourly = F.col("especificidad").isin(HOURLY)
    ap, pico = F.col("es_hora_apertura"), F.col("es_hora_pico")
    filled = hourly & (n > 0)
    low = filled & ~ap & pico & (p75 < LOW_P75) & (n < LOW_N) & F.lit(low_fallback)
    md_ok, m_ok = F.col("md_n").isNotNull(), F.col("m_n").isNotNull()
    alt_md = md_ok & (F.col("md_p75") > p75)
    alt_m = ~md_ok & m_ok & (F.col("m_p75") > p75)
    low_base = F.when(alt_md, F.col("md_p75")).when(alt_m, F.col("m_p75")).otherwise(p75)

    base = (F.when(filled & ap, F.when(n > OPENING_MIN_N, p25).otherwise(p50))
            .when(low, low_base)
            .when(filled & pico, p75)
            .when(filled, p50)
            .when(hourly, p50)
            .when(pico, p75)
            .otherwise(p50))
    d = d.withColumn("hist_base", base)
    wh = (F.when(filled & ap, W_OPENING[0])
          .when(low, F.when(F.col("hist_base") < LOW_P75, W_LOW_STILL_LOW[0]).otherwise(W_LOW_RESCUED[0]))
          .when(filled & pico, W_PEAK[0])
          .when(filled, W_OTHER[0])
          .when(hourly, W_EMPTY[0])
          .otherwise(W_NO_HOURLY[0]))
    wm = (F.when(filled & ap, W_OPENING[1])
          .when(low, F.when(F.col("hist_base") < LOW_P75, W_LOW_STILL_LOW[1]).otherwise(W_LOW_RESCUED[1]))
          .when(filled & pico, W_PEAK[1])
          .when(filled, W_OTHER[1])
          .when(hourly, W_EMPTY[1])
          .otherwise(W_NO_HOURLY[1]))
    espec = (F.when(low & alt_md, F.lit("mes_dia_fallback")).when(low & alt_m, F.lit("mes_fallback"))
             .otherwise(F.col("especificidad")))
    d = d.withColumns({"w_hist": wh, "w_model": wm, "especificidad": espec})
    return d.withColumn("pred_combinada", F.col("pred_base") * F.col("w_model") + F.col("hist_base") * F.col("w_hist"))


def calendar_ladder(df: DataFrame, variant: str = "predict", featured: str = cal.FEATURED_RIDE,
                    global_median: Column | None = None) -> DataFrame:
    """B4 (``predict``), B5 (``train``: milder featured rule) and the serverless ladder
    (``lambda``: the rules of ``predict``, but clamp [1,180] with rescue).

    Needs ``pred_base``, ``pred_combinada``, ``hist_base``, ``p75_hist``, ``hora_eff``,
    ``especificidad``, ``fecha``, ``atraccion``. First matching rule wins; adds
    ``minutos_raw``, ``minutos_predichos`` (clamped, Python-rounded to 0.1) and
    ``ajuste_aplicado``.
    """
    d = df.withColumns(_band_cols(F.col("hora_eff")))
    d = d.withColumns({"_dow": F.weekday("fecha"), "_mes": F.month("fecha")})
    d = d.withColumns({"_finde": F.col("_dow").isin(5, 6), "_puente": cal.is_bridge("fecha"),
                       "_feat": F.coalesce(F.col("atraccion").contains(featured), F.lit(False)) & (F.col("_mes") == 10)})
    comb, pred, base, p75 = F.col("pred_combinada"), F.col("pred_base"), F.col("hist_base"), F.col("p75_hist")
    ap, pico, valle, finde = F.col("es_hora_apertura"), F.col("es_hora_pico"), F.col("es_hora_valle"), F.col("_finde")
    esp = F.col("especificidad")
    lab = lambda p: F.concat(F.lit(p), esp)

    rules: list[tuple[Column, Column, Column]] = [
        (ap, F.when(finde, comb * OPENING_MULT["weekend"]).otherwise(comb * OPENING_MULT["workday"]), lab("apertura_"))]
    def largest(factors: dict[str, float]) -> Column:
        of = {"pred": pred, "comb": comb, "base": base, "p75": p75}
        return F.greatest(*[F.lit(f) if k == "floor" else of[k] * f for k, f in factors.items()])

    if variant == "train":
        rules.append((F.col("_feat"), F.when(pico, largest(FEATURED_TRAIN_PEAK)).otherwise(largest(FEATURED_TRAIN)), lab(FEATURED_LABEL + "_")))
    else:
        low_peak = base < FEATURED_LOW_PEAK
        feat_val = (F.when(finde & pico & ((p75 < FEATURED_LOW_PEAK) | low_peak), largest(FEATURED_WEEKEND_PEAK_LOW))
                    .when(finde & pico, largest(FEATURED_WEEKEND_PEAK))
                    .when(finde & (base < FEATURED_LOW_OTHER), largest(FEATURED_WEEKEND_LOW))
                    .when(finde, largest(FEATURED_WEEKEND))
                    .when(pico & low_peak, largest(FEATURED_WORKDAY_PEAK_LOW))
                    .when(pico, largest(FEATURED_WORKDAY_PEAK))
                    .otherwise(largest(FEATURED_WORKDAY)))
        feat_lab = F.concat(F.lit(FEATURED_LABEL + "_"),
                            F.when(finde, F.lit("fin_semana_")).otherwise(F.lit("laborable_")), esp)
        rules.append((F.col("_feat"), feat_val, feat_lab))
    rules += [
        (F.col("_puente"), F.when(finde, comb * BRIDGE_MULT["weekend"]).otherwise(comb * BRIDGE_MULT["workday"]), lab("puente_")),
        ((F.col("_mes") == 10) & (F.col("_dow") == 6), F.when(pico, comb * OCT_SUNDAY_PEAK).otherwise(comb), lab("octubre_domingo_")),
        ((F.col("_mes") == 11) & (F.col("_dow") == 6), F.when(pico, comb * NOV_SUNDAY_PEAK).otherwise(comb), lab("noviembre_domingo_")),
    ]
    rules += [(pico, comb * PEAK_MULT, lab("hora_pico_")),
              (valle, comb * VALLEY_MULT, lab("hora_valle_")),
              (finde, comb, lab("fin_semana_"))]
    val, label = None, None
    for cond, v, lb in rules:
        val = F.when(cond, v) if val is None else val.when(cond, v)
        label = F.when(cond, lb) if label is None else label.when(cond, lb)
    val, label = val.otherwise(comb), label.otherwise(lab("laborable_"))
    d = d.withColumns({"minutos_raw": val, "ajuste_aplicado": label})
    if variant == "lambda":
        rescue = F.greatest((global_median if global_median is not None else F.col("global_median")) * RESCUE_SHARE, F.lit(RESCUE_FLOOR))
        final = clamp("minutos_raw", "lambda", rescue)
    else:
        final = clamp("minutos_raw", "serve")
    d = d.withColumn("minutos_predichos", round_half_even(final, 1))
    return d.drop("_dow", "_mes", "_finde", "_puente", "_feat")


def simple_adjust(df: DataFrame, featured: str = cal.FEATURED_RIDE) -> DataFrame:
    """Featured ride in October -> max(pred, 0.8 * p90_mes); elif p90_mes > 1.5 * pred
    -> mean of the two; else the model. Clamp [5, 180]. ``p90_mes`` may be NULL."""
    pred, p90 = F.col("pred_base"), F.col("p90_mes")
    feat = F.coalesce(F.col("atraccion").contains(featured), F.lit(False)) & (F.month("fecha") == 10)
    val = (F.when(feat & p90.isNotNull(), F.greatest(pred, p90 * SIMPLE_FEATURED_SHARE))
           .when(p90.isNotNull() & (p90 > pred * SIMPLE_RATIO), (pred + p90) / 2)
           .otherwise(pred))
    lab = (F.when(feat & p90.isNotNull(), F.lit(FEATURED_LABEL + "_p90"))
           .when(p90.isNotNull() & (p90 > pred * SIMPLE_RATIO), F.lit("blend_p90_mes"))
           .otherwise(F.lit("modelo_base")))
    return df.withColumns({"minutos_predichos": round_half_even(clamp(val, "serve"), 1), "ajuste_aplicado": lab})


RESULT_COLUMNS = ["minutos_predichos", "prediccion_base", "p75_historico", "median_historico", "ajuste_aplicado",
                  "especificidad_historico", "hora", "hora_int", "es_hora_apertura", "es_hora_pico", "es_hora_valle",
                  "es_puente", "es_batman_octubre", "mes", "dia_mes", "dia_semana", "es_fin_de_semana",
                  "count_historico"]


def result_record(df: DataFrame, keep: list[str] | None = None, featured: str = cal.FEATURED_RIDE) -> DataFrame:
    """The 18-column result record (values rounded like the reference)."""
    d = df.withColumns(_band_cols(F.col("hora_eff")))
    return d.select(
        *(keep or []),
        F.col("minutos_predichos"),
        round_half_even(F.col("pred_base"), 1).alias("prediccion_base"),
        round_half_even(F.col("p75_hist"), 1).alias("p75_historico"),
        round_half_even(F.col("p50_hist"), 1).alias("median_historico"),
        F.col("ajuste_aplicado"),
        F.col("especificidad").alias("especificidad_historico"),
        round_half_even(F.col("hora_num"), 2).alias("hora"),
        F.col("hora_eff").alias("hora_int"),
        F.col("es_hora_apertura"), F.col("es_hora_pico"), F.col("es_hora_valle"),
        cal.is_bridge("fecha").alias("es_puente"),
        (F.coalesce(F.col("atraccion").contains(featured), F.lit(False)) & (F.month("fecha") == 10)).alias("es_batman_octubre"),
        F.month("fecha").alias("mes"), F.dayofmonth("fecha").alias("dia_mes"),
        cal.day_name("fecha", "es").alias("dia_semana"),
        F.weekday("fecha").isin(5, 6).alias("es_fin_de_semana"),
        F.col("n_hist").alias("count_historico"))

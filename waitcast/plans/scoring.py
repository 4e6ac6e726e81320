"""Batch scoring plan (M23): requests table -> features -> model -> cascade -> blend -> ladder.

A request table of any size is scored with joins and one projection per
stage; no data rows reach the driver (only the history table's row counts per
grain, for the broadcast decision). ``predict`` is any function adding ``pred_base``
(the fitted MLlib pipeline, or the deterministic stand-in model used by the
oracle checks).
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitcast.functions import calendar as cal
from waitcast.functions.hours import parse_hour
from waitcast.operators import blend as B
from waitcast.operators import cascade as CA
from waitcast.operators import encode as E
from waitcast.operators import history as H
from waitcast.operators.scalars import with_scalars


def prepare_requests(requests: DataFrame, today: str | None = None, hour_default: float = 12.0) -> DataFrame:
    """F26 for requests: lenient date (bad -> ``today`` if given), hour text -> hours
    (bad -> 12.0), then the cascade keys (month, weekday Mon=0, integer hour)."""
    fecha = cal.lenient_date(F.col("fecha"))
    if today is not None:
        fecha = F.coalesce(fecha, F.to_date(F.lit(today)))
    r = requests.withColumns({"fecha": fecha, "hora_num": parse_hour("hora", default=hour_default)})
    return r.withColumns({"hora_int": F.col("hora_num").cast("int"), "mes": F.month("fecha"),
                          "dia_semana_num": F.weekday("fecha")})


def fill_hours(df: DataFrame, fill: float | str = "median") -> DataFrame:
    """Fill unparsable hours (T10): ``"median"`` = exact median of the parsed hours of
    ``df`` (one-row aggregate over distinct values, broadcast), or a constant."""
    if fill == "median":
        # one row, computed once: every later materialisation of ``df`` reuses it
        med = H.column_percentiles(df, ["hora_num"], [0.5], prefix="_med_").checkpoint(eager=True)
        df = with_scalars(df, med).withColumn(
            "hora_num", F.coalesce(F.col("hora_num"), F.col("_med_hora_num__0"))).drop("_med_hora_num__0")
    else:
        df = df.withColumn("hora_num", F.coalesce(F.col("hora_num"), F.lit(float(fill))))
    return df.withColumn("hora_int", F.col("hora_num").cast("int"))


def prepare_training(readings: DataFrame, hour_fill: float | str = "median") -> DataFrame:
    """Training rows keyed like requests; rows without a wait are dropped and unparsable
    hours take the median hour of the training rows (requests take 12.0 instead)."""
    r = prepare_requests(readings, hour_default=None).where(F.col("tiempo_espera").isNotNull())
    return fill_hours(r, hour_fill)


def stand_in_model(train: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Deterministic model for oracle checks: the ride's mean wait over train rows,
    the global mean for unseen rides (a plain target encoding, M3)."""
    def predict(req: DataFrame) -> DataFrame:
        return E.target_mean_encoding(req, train, "atraccion", name="pred_base")
    return predict


def materialized_histories(train: DataFrame) -> DataFrame:
    """The one-pass history table, computed once and checkpointed.

    The cascade reads nine slices of it; without materialisation each slice's
    ``grain = ...`` filter is pushed into its own copy of the aggregation and
    the whole history is recomputed per slice. The table is an aggregate
    bounded by the key domain; the reliable checkpoint lives in the shared
    ``spark.checkpoint.dir`` (in production it is the saved S10 artifact).
    """
    return H.all_histories(train).checkpoint(eager=True)


def score(requests: DataFrame, train: DataFrame, predict: Callable[[DataFrame], DataFrame] | None = None,
          variant: str = "predict", featured: str = cal.FEATURED_RIDE, pair_check: bool = False,
          hist: DataFrame | None = None, today: str | None = None) -> DataFrame:
    """Score every request. ``train`` must hold prepared rows (see :func:`prepare_training`);
    ``hist`` is a materialised history table (artifact); computed and checkpointed when absent.
    ``today`` replaces bad dates (F26); without it they stay NULL."""
    req = prepare_requests(requests, today=today)
    hist = hist if hist is not None else materialized_histories(train)
    predict = predict or stand_in_model(train)
    c = CA.cascade(predict(req), hist, pair_check=pair_check)
    b = B.history_base(c, low_fallback=variant != "train")
    return B.calendar_ladder(b, variant=variant, featured=featured)


def score_from_artifacts(spark, requests: DataFrame, root: str, featured: str = cal.FEATURED_RIDE,
                         variant: str = "predict", today: str | None = None, version: int | None = None) -> DataFrame:
    """Serving path re-aimed to tables (M23 with S12/S11): open the newest version (or ``version``) of the artifacts
    published by :func:`waitcast.plans.training.run_training`, build the request features from the saved tables, align them
    to the saved column list (M22), predict with the saved pipeline, then cascade, blend and ladder. No training row is read; only
    the manifest and the column list (one row per feature) come to the driver. A version without encodings or medians serves
    defaults. Request defaults are F26's: a bad date becomes ``today`` (by default the
    day of the call), a bad hour 12.0, a missing weather code 3, missing feels-like the temperature."""
    from waitcast.operators import joins as J
    from waitcast.operators import model as MD
    from waitcast.plans import training as TR
    from waitcast.sources import artifacts as A

    saved = A.open_version(spark, root, version)
    fitted = {name: saved.table(name) for name in ("medians", "histories", "target", "enc_zona", "enc_atraccion") if name in saved.entries}
    hist = fitted["histories"]
    cols = [r["feature"] for r in saved.table("columns").orderBy("pos").collect()]
    model = saved.pipeline("pipeline")
    req = prepare_requests(requests, today=today or str(datetime.date.today()))
    feats = TR.apply_features(req, fitted, featured, serving=True)
    feats = MD.align_columns(feats, cols, J.global_row(hist))
    scored = model.transform(feats).drop("features_raw", "features")
    c = CA.cascade(scored, hist)
    return B.calendar_ladder(B.history_base(c, low_fallback=variant != "train"), variant=variant, featured=featured)

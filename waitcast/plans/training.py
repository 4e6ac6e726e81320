"""Training plan: feature table -> MLlib pipeline -> evaluation.

Leakage-free by default (T5): histories, encodings and fill values are fitted
on the train rows and applied to both splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitcast.operators import encode as E
from waitcast.operators import joins as J
from waitcast.operators import model as MD
from waitcast.plans.features import calendar_features
from waitcast.operators.scalars import with_scalars
from waitcast.functions.calendar import FEATURED_RIDE
from waitcast.session import spread

NON_FEATURES = {"tiempo_espera", "row_id", "clase_min", "request_id", "is_train"}
WEATHER = ["temperatura", "humedad", "codigo_clima"]
_NUM = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def fit_features(train: DataFrame, featured: str = FEATURED_RIDE) -> dict[str, DataFrame]:
    """Everything that :func:`apply_features` takes from the training rows, as tables to save (S10):
    ``medians`` (one row: weather columns that ``train`` has), ``histories`` (A7, with the global grain), ``target`` (one row: the mean
    wait), and for zone and ride ``enc_<column>``: category, smoothed target mean (M4) and rows with a wait (M6)."""
    from waitcast.operators import history as H
    in_train = [c for c in WEATHER if c in train.columns]
    fitted = {"medians": H.column_percentiles(train, in_train, [0.5])} if in_train else {}
    fitted["histories"] = H.all_histories(calendar_features(train, hora="hora_num", featured=featured))
    known = train.where(F.col("tiempo_espera").isNotNull())
    target = known.agg(F.avg("tiempo_espera").alias("mean_wait"))
    fitted["target"] = target
    for col in ("zona", "atraccion"):
        if col in train.columns:
            stats = known.where(F.col(col).isNotNull()).groupBy(col).agg(F.avg("tiempo_espera").alias("_m"), F.count(F.lit(1)).alias(f"{col}_freq"))
            n = F.col(f"{col}_freq")
            smooth = (n * F.col("_m") + F.lit(float(E.SMOOTHING)) * F.col("mean_wait")) / (n + F.lit(float(E.SMOOTHING)))
            fitted[f"enc_{col}"] = with_scalars(stats, target).select(col, smooth.alias(f"{col}_enc"), f"{col}_freq")
    return fitted


def apply_features(df: DataFrame, fitted: dict[str, DataFrame], featured: str = FEATURED_RIDE, serving: bool = False) -> DataFrame:
    """All model features for ``df`` (prepared rows with fecha, hora_num, atraccion, zona, weather columns) from the tables
    of :func:`fit_features`, materialised or saved. ``serving``: rows are requests, whose missing weather code takes the fixed
    default, not the median (F26). Missing feels-like is the temperature. A weather column that the training rows lacked takes the
    fixed default; an unseen or NULL category the mean wait and frequency 0."""
    from waitcast.functions.fill import REQUEST_DEFAULTS
    d = df.withColumns({c: F.lit(None).cast("double") for c in WEATHER if c not in df.columns})
    medians = fitted.get("medians")
    in_train = [c for c in WEATHER if medians is not None and f"{c}__0" in medians.columns]
    if in_train:
        d = with_scalars(d, medians.select(*[F.col(f"{c}__0").alias(f"_m_{c}__0") for c in in_train]))
    fills = {c: F.coalesce(F.col(c).cast("double"),
                           F.col(f"_m_{c}__0") if c in in_train and not (serving and c == "codigo_clima") else F.lit(float(REQUEST_DEFAULTS[c])))
             for c in WEATHER}
    d = d.withColumns(fills).drop(*[f"_m_{c}__0" for c in in_train])
    felt = [F.col("sensacion_termica").cast("double")] if "sensacion_termica" in d.columns else []
    d = d.withColumn("sensacion_termica", F.coalesce(*felt, F.col("temperatura")))
    d = calendar_features(d, hora="hora_num", featured=featured)
    hist = fitted["histories"]
    d = J.fill_by_family(J.attach_histories(d, None, hist=hist), None, hist=hist)
    for col in ("zona", "atraccion"):
        if col not in d.columns:
            d = d.withColumn(col, F.lit(None).cast("string"))
        if f"enc_{col}" in fitted:
            d = J.size_checked_join(d, fitted[f"enc_{col}"], col, "left")
        else:
            d = d.withColumns({f"{col}_enc": F.lit(None).cast("double"), f"{col}_freq": F.lit(None).cast("long")})
        d = with_scalars(d, fitted["target"])
        d = d.withColumns({f"{col}_enc": F.coalesce(f"{col}_enc", "mean_wait"), f"{col}_freq": F.coalesce(f"{col}_freq", F.lit(0))}).drop("mean_wait")
    return d


def materialised(fitted: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The fitted tables, each computed once (reliable checkpoint)."""
    return {name: df.checkpoint(eager=True) for name, df in fitted.items()}


def build_features(df: DataFrame, train: DataFrame, featured: str = FEATURED_RIDE, serving: bool = False) -> DataFrame:
    """:func:`apply_features` with every data-dependent piece fitted on ``train``."""
    return apply_features(df, materialised(fit_features(train, featured)), featured, serving)


def feature_columns(features: DataFrame) -> list[str]:
    """M22's saved column list: numeric columns except ids and targets, in table order."""
    return [f.name for f in features.schema.fields
            if isinstance(f.dataType, _NUM) and f.name not in NON_FEATURES]


def fitted_gbt(spark: SparkSession, train_features: DataFrame, cols: list[str], config: str = "spark_100_005_8", iterations: int | None = None,
               held: bool = False):
    """Fit the M8+M9+M10 pipeline on the rows that have a wait. ``held``: the rows are written and spread already."""
    tr = train_features.where(F.col("tiempo_espera").isNotNull())
    return MD.fit_pipeline(spark, tr, cols, MD.gbt(config, iterations=iterations), held)


def run_training(spark: SparkSession, readings: DataFrame, root: str, featured: str = FEATURED_RIDE,
                 config: str = "spark_100_005_8") -> DataFrame:
    """End-to-end training job (the reference's training script as one Spark plan).

    Hash split (M1) -> training rows (median hour fill) / held-out rows -> features fitted on the train rows
    -> M8+M9+GBT pipeline -> a published version of the artifact store at ``root`` (S10/S11): the tables of
    :func:`fit_features`, ``columns`` (M22 column list with positions), ``train_rows`` (the processed training table,
    which serving does not read) and ``pipeline``. Returns the held-out regression metrics (M14/M15) as a one-row frame.
    """
    from waitcast.operators.metrics import regression_metrics
    from waitcast.plans import scoring as S
    from waitcast.sources import artifacts as A

    raw_tr, raw_te = E.hash_split(spread(readings), "row_id")
    # the training rows feed several materialisations (histories, encodings, fills, features):
    # checkpoint them once instead of re-deriving them from the source each time
    tr, te = S.prepare_training(raw_tr).checkpoint(eager=True), S.prepare_requests(raw_te)
    fitted = materialised(fit_features(tr, featured))
    ftr, fte = apply_features(tr, fitted, featured), apply_features(te, fitted, featured)
    cols = feature_columns(ftr)
    model = fitted_gbt(spark, ftr, cols, config)
    colframe = spark.createDataFrame(list(enumerate(cols)), "pos int, feature string")
    A.publish(spark, root, {**fitted, "train_rows": tr, "columns": colframe}, {"pipeline": model})
    pred = model.transform(fte).select(F.col("tiempo_espera").alias("y"), F.col("pred_base").alias("pred"))
    return regression_metrics(pred)

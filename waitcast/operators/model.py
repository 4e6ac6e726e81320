"""Model stages on MLlib.

MLlib estimators run their own jobs; the training table is checkpointed once
and spread over all cores before fitting. The forest checkpoints its node-id
cache, boosting its errors, every 10 iterations into the cluster's checkpoint
folder (``spark.checkpoint.dir``), so a lost executor costs at most 10
iterations of lineage, never the job. Boosting keeps no node-id cache: to walk
one tree of few levels costs less than a new cached table a level.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitcast.functions.labels import CLASS_MINUTES, wait_class_rule
from waitcast.operators import histogram_trees as HT
from waitcast.operators.encode import hash_split_flag, hash_u32
from waitcast.operators.joins import size_checked_join
from waitcast.session import spread
from waitcast.operators.scalars import with_scalars

# Boosted-tree configurations of the reference, mapped onto GBTRegressor
# (iterations, step, depth, subsampling, feature subset, min instances per node).
# L1/L2/gamma regularisation has no GBTRegressor counterpart and is not emulated.
GBT_CONFIGS = {
    "spark_100_005_8": dict(maxIter=100, stepSize=0.05, maxDepth=8, subsamplingRate=1.0, featureSubsetStrategy="all",
                            minInstancesPerNode=1),
    "xgb_1000_005_8": dict(maxIter=1000, stepSize=0.05, maxDepth=8, subsamplingRate=0.85, featureSubsetStrategy="0.85",
                           minInstancesPerNode=5),
    "xgb_1500_002_10": dict(maxIter=1500, stepSize=0.02, maxDepth=10, subsamplingRate=1.0, featureSubsetStrategy="all",
                            minInstancesPerNode=1),
    "xgb_500_01_8": dict(maxIter=500, stepSize=0.1, maxDepth=8, subsamplingRate=1.0, featureSubsetStrategy="all",
                         minInstancesPerNode=1),
    "xgb_500_01_6": dict(maxIter=500, stepSize=0.1, maxDepth=6, subsamplingRate=1.0, featureSubsetStrategy="all",
                         minInstancesPerNode=1),
}
RF_CONFIG = dict(numTrees=300, maxDepth=10, seed=42)


def assembler(cols: list[str], out: str = "features_raw") -> VectorAssembler:
    """M8: numeric columns -> one vector (NULL/NaN kept as NaN; fills happen upstream)."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep")


def scaler(inp: str = "features_raw", out: str = "features") -> StandardScaler:
    """M9: centre and scale (T13: MLlib does not centre by default)."""
    return StandardScaler(inputCol=inp, outputCol=out, withMean=True, withStd=True)


def gbt(config: str = "spark_100_005_8", label: str = "tiempo_espera", seed: int = 42, iterations: int | None = None) -> GBTRegressor:
    """Gradient-boosted trees with one of the reference's configurations; ``iterations``
    replaces its number of trees."""
    params = GBT_CONFIGS[config] | ({"maxIter": iterations} if iterations else {})
    return GBTRegressor(featuresCol="features", labelCol=label, predictionCol="pred_base", seed=seed,
                        checkpointInterval=10, **params)


def random_forest(label: str = "clase_min") -> RandomForestRegressor:
    """Random forest regressor on class representative minutes."""
    return RandomForestRegressor(featuresCol="features", labelCol=label, predictionCol="pred_base",
                                 cacheNodeIds=True, checkpointInterval=10, **RF_CONFIG)


def fit_pipeline(spark: SparkSession, train: DataFrame, cols: list[str], estimator, held: bool = False) -> PipelineModel:
    """M8 + M9 + estimator in one Pipeline fitted on the train rows.

    The training table is checkpointed (reliable checkpoint in the shared
    ``spark.checkpoint.dir``) before fitting: the feature plan (history joins,
    encodings) runs once instead of once per estimator pass, and a lost
    executor re-reads the checkpoint instead of recomputing the whole lineage.
    Trees go over it once a level, so it is spread over all cores. ``held``: ``train``
    comes from :func:`waitcast.session.spread`, so that several fits share one copy. Boosted trees
    with squared loss are grown by :mod:`waitcast.operators.histogram_trees`, as MLlib grows them.
    """
    data = train.select(*cols, *[c for c in (estimator.getLabelCol(),) if c not in cols])
    data = data if held else spread(data)
    if not HT.supported(estimator):
        return Pipeline(stages=[assembler(cols), scaler(), estimator]).fit(data)
    scaled = Pipeline(stages=[assembler(cols), scaler()]).fit(data)
    return PipelineModel([*scaled.stages, HT.fit(estimator, scaled.transform(data))])


def fit_validated(spark: SparkSession, train: DataFrame, cols: list[str], key: str, estimator: GBTRegressor, val_frac: float = 0.2,
                  tolerance: float = 0.01) -> tuple[PipelineModel, DataFrame]:
    """M1 + M10/M11: boosted trees fitted with a validation part of the train rows, and the loss curve.

    A hash of ``key`` sets ``val_frac`` of the rows aside (the nested split of :func:`waitcast.operators.encode.nested_split`). Assembler and
    scaler see all train rows, as the reference scales before it splits. Trees are added while the validation loss falls by more than
    ``tolerance`` (MLlib's rule), up to the estimator's number; those up to the least loss are kept. Returns the pipeline and (trees,
    loss_fit, loss_validation): mean squared errors after each kept tree.
    """
    label = estimator.getLabelCol()
    part = ~hash_split_flag(key, 1 - val_frac, seed=7919)
    data = spread(train.select(*cols, *[c for c in (label,) if c not in cols], part.alias("_validation")))
    estimator = estimator.copy({estimator.validationIndicatorCol: "_validation", estimator.validationTol: tolerance})
    model = Pipeline(stages=[assembler(cols), scaler(), estimator]).fit(data)
    features = data
    for stage in model.stages[:-1]:
        features = stage.transform(features)
    losses = [model.stages[-1].evaluateEachIteration(features.where(which), "squared") for which in ("NOT _validation", "_validation")]
    # a model property: one row per tree
    curve = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(*losses, strict=True), 1)]
    return model, spark.createDataFrame(curve, "trees int, loss_fit double, loss_validation double")


def as_array(df: DataFrame, col: str = "features", out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, vector_to_array(F.col(col)))


def class_targets(df: DataFrame, value: str = "tiempo_espera") -> DataFrame:
    """Rule class of the wait and its representative minutes (F16 + F21)."""
    m = F.create_map(*[x for k, v in CLASS_MINUTES.items() for x in (F.lit(k), F.lit(float(v)))])
    return df.withColumn("clase", wait_class_rule(value)).withColumn("clase_min", m[F.col("clase")])


def balance_classes(df: DataFrame, key: str, label: str = "clase") -> DataFrame:
    """M13 (re-aimed): balance classes by deterministic oversampling.

    Every class is brought to about the size of the largest one: each row of a
    class with n_c rows is emitted floor(r) times plus once more when its key
    hash falls below frac(r), with r = n_max / n_c. Copies carry ``synthetic``
    = true. Counts are one aggregate; copies are generated with ``explode``,
    so no class is gathered into one task. (The reference interpolates
    between in-class neighbours; this keeps the rows as they are.)
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    mx = counts.agg(F.max("_nc").alias("_nmax"))
    ratios = with_scalars(counts, mx).select(label, (F.col("_nmax") / F.col("_nc")).alias("_r"))
    j = size_checked_join(df, ratios, label, "inner", materialize=True, null_safe=True)
    u = hash_u32(key, seed=104729) / F.lit(4294967296.0)
    copies = F.floor(F.col("_r")).cast("int") + (u < (F.col("_r") - F.floor(F.col("_r")))).cast("int")
    out = j.withColumn("_i", F.explode(F.sequence(F.lit(1), F.greatest(copies, F.lit(1)))))
    return out.withColumn("synthetic", F.col("_i") > 1).drop("_r", "_i")


def importances(spark: SparkSession, model: PipelineModel, cols: list[str]) -> DataFrame:
    """Feature importances of the fitted tree model, one row per feature.

    The vector has one entry per feature column (a model property, not data),
    so it is built into a small DataFrame directly.
    """
    imp = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(cols, [float(x) for x in imp])), "feature string, importance double")


FAMILY_DEFAULTS = ("count_",)


def align_columns(df: DataFrame, train_cols: list[str], family_fill: DataFrame | None = None) -> DataFrame:
    """Select the training columns in training order; absent columns are
    filled by family (``count_*`` -> 0, other history statistics from the one-row
    ``family_fill`` frame of global statistics when given), else 0."""
    have = set(df.columns)
    out = df
    if family_fill is not None:
        out = with_scalars(out, family_fill.select([F.col(c).alias(f"_g_{c}") for c in family_fill.columns]))
    cols = []
    for c in train_cols:
        if c in have:
            cols.append(F.col(c))
            continue
        fill = F.lit(0.0)
        if family_fill is not None and not c.startswith(FAMILY_DEFAULTS):
            for fam in ("mean", "median", "std", "p75", "p90", "p95"):
                if fam in c and fam in family_fill.columns:
                    fill = F.col(f"_g_{fam}")
                    break
        cols.append(fill.cast("double").alias(c))
    keep = [c for c in df.columns if c not in train_cols]
    return out.select(*keep, *cols)

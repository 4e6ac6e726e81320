"""Boosted trees on blocks of binned rows are those that MLlib fits, and every configuration is fitted with all its trees."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from waitcast.operators import histogram_trees as HT
from waitcast.operators import model as MD
from waitcast.plans import queries_ml as Q
from waitcast.plans import training as TR

COLUMNS = ["a", "b", "c", "month", "season", "one"]


@pytest.fixture(scope="module")
def scaled(spark):
    r = np.random.default_rng(3)
    n = 3000
    a, b, c, month = r.random(n), r.normal(0, 3, n), np.round(r.random(n), 1), r.integers(1, 13, n).astype(float)
    y = 20 * a + np.where(b > 0, 15, 0) * (c > 0.4) + 3 * month + r.normal(0, 4, n)
    rows = [tuple(map(float, x)) for x in zip(a, b, c, month, month // 4, np.ones(n), y, strict=True)]
    data = spark.createDataFrame(rows, ", ".join(f"{x} double" for x in [*COLUMNS, "tiempo_espera"])).repartition(2).checkpoint(eager=True)
    return Pipeline(stages=[MD.assembler(COLUMNS), MD.scaler()]).fit(data).transform(data).select("features", "tiempo_espera").checkpoint(eager=True)


def _estimator(**params):
    return GBTRegressor(featuresCol="features", labelCol="tiempo_espera", predictionCol="pred_base", seed=42, **{"checkpointInterval": 2, "maxIter": 5, "maxDepth": 4, "stepSize": 0.3} | params)


def _trees(model):
    return [t.toDebugString.split("\n", 1)[1] for t in model.trees]


@pytest.mark.parametrize("params", [{}, {"maxDepth": 7, "minInstancesPerNode": 20}, {"maxIter": 2, "maxDepth": 1, "minInfoGain": 0.5}])
def test_trees_equal_those_of_mllib(scaled, params):
    est = _estimator(**params)
    got, want = HT.fit(est, scaled), est.fit(scaled)
    assert _trees(got) == _trees(want) and got.treeWeights == want.treeWeights
    assert got.featureImportances == want.featureImportances and got.getMaxDepth() == want.getMaxDepth()


def test_grouped_spread_rows_give_the_same_predictions(scaled, monkeypatch):
    """Codes shared by features, siblings derived, a job a level, several blocks a task, groups over the bound divided, checkpoints."""
    for name, value in (("EXACT", 0), ("ALONE", 0), ("UNGROUPED", 0), ("BLOCK", 400), ("CODES", 40), ("CELLS", 500)):
        monkeypatch.setattr(HT, name, value)
    est = _estimator()
    got, want = HT.fit(est, scaled), est.fit(scaled)
    assert [t.numNodes for t in got.trees] == [t.numNodes for t in want.trees]
    # splits of month and season at the same rows gain the same: either may be taken
    got_shares, want_shares = ([*m.featureImportances.toArray()[:3], sum(m.featureImportances.toArray()[3:])] for m in (got, want))
    assert got_shares == pytest.approx(want_shares, abs=1e-6)
    wrong = got.transform(scaled).withColumnRenamed("pred_base", "got")
    assert want.transform(wrong).agg(F.max(F.abs(F.col("got") - F.col("pred_base")))).first()[0] < 1e-9


def test_drawn_rows_and_columns(scaled):
    model = HT.fit(_estimator(subsamplingRate=0.5, featureSubsetStrategy="0.5"), scaled)
    assert len(model.trees) == 5
    p = model.transform(scaled).agg(F.avg(F.pow(F.col("pred_base") - F.col("tiempo_espera"), 2)), F.var_pop("tiempo_espera")).first()
    assert p[0] < 0.5 * p[1]


def test_a_feature_that_is_no_number_is_refused(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "x double, tiempo_espera double")
    with pytest.raises(Exception, match="NaN"):
        TR.fitted_gbt(spark, rows, ["x"])


def test_configurations_are_fitted_with_all_their_trees(spark, monkeypatch):
    counts = {"spark_100_005_8": 4, "xgb_500_01_6": 5}
    monkeypatch.setattr(MD, "GBT_CONFIGS", {c: MD.GBT_CONFIGS[c] | {"maxIter": n, "maxDepth": 2} for c, n in counts.items()})
    fitted, real = [], TR.fitted_gbt

    def noted(*args, **kwargs):
        model = real(*args, **kwargs)
        fitted.append(len(model.stages[-1].trees))
        return model

    monkeypatch.setattr(TR, "fitted_gbt", noted)
    out = Q.m11(spark, SF_SMALL).collect()
    assert sorted(fitted) == [4, 5] and [r.config for r in out] == sorted(counts) and all(r.finite for r in out)

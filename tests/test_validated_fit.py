"""Validation during the fit, its curve recounted from the trees."""

import random

import pytest
from pyspark.ml.regression import GBTRegressor

from waitcast.operators import encode as E
from waitcast.operators import model as MD


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(4)
    data = [(i, float(r.randint(0, 9)), r.random(), 0.0) for i in range(600)]
    data = [(i, a, b, 5 * a + (20 if b > 0.5 else 0) + r.gauss(0, 8)) for i, a, b, _ in data]
    return spark.createDataFrame(data, "row_id long, a double, b double, tiempo_espera double")


def test_curve_and_kept_trees(spark, rows):
    est = GBTRegressor(featuresCol="features", labelCol="tiempo_espera", predictionCol="pred_base", maxIter=60, maxDepth=1, stepSize=0.5, seed=1)
    model, curve = MD.fit_validated(spark, rows, ["a", "b"], "row_id", est)
    gbt, curve = model.stages[-1], curve.orderBy("trees").collect()
    assert [r.trees for r in curve] == list(range(1, len(gbt.trees) + 1)) and 1 < len(curve) < 60  # noise: more trees only overfit
    losses = [r.loss_validation for r in curve]
    assert losses[-1] == min(losses) and curve[-1].loss_fit < curve[0].loss_fit
    # recount: every tree's prediction on every row, summed up by hand
    scaled = model.stages[1].transform(model.stages[0].transform(rows)).withColumn("fit", E.hash_split_flag("row_id", 0.8, seed=7919)).collect()
    assert sum(r.fit for r in scaled) == E.nested_split(rows, "row_id", train_frac=1.0)[0].count()
    total, weights = [0.0] * len(scaled), gbt.treeWeights
    for tree, weight, want in zip(gbt.trees, weights, curve, strict=True):
        total = [t + weight * tree.predict(r.features) for t, r in zip(total, scaled, strict=True)]
        for part, loss in ((True, want.loss_fit), (False, want.loss_validation)):
            wrong = [(t - r.tiempo_espera) ** 2 for t, r in zip(total, scaled, strict=True) if r.fit == part]
            assert sum(wrong) / len(wrong) == pytest.approx(loss)


def test_the_estimator_given_stays_as_it_is(spark, rows):
    est = MD.gbt("xgb_500_01_6", iterations=2)
    MD.fit_validated(spark, rows, ["a", "b"], "row_id", est)
    assert not est.isSet("validationIndicatorCol")

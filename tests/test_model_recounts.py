"""Feature importances (M21, K2) recounted from the nodes of the saved trees; the model's error against the group means."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from waitcast.operators import explore, model
from waitcast.plans import training
from waitcast.sources import files
from waitcast.sources import tables as tb

COLUMNS = ["mes", "dia_semana_num", "temperatura", "humedad", "codigo_clima", "zona_num"]


@pytest.fixture(scope="module")
def fitted(spark):
    rows = tb.readings_orders(spark, SF_SMALL).where("tiempo_espera IS NOT NULL")
    rows = rows.select("row_id", (F.col("tiempo_espera") + 10 * F.weekday("fecha")).alias("tiempo_espera"), F.month("fecha").alias("mes"), F.weekday("fecha").alias("dia_semana_num"),
                       F.coalesce("temperatura", F.lit(0.0)).alias("temperatura"), "humedad", "codigo_clima", F.substring("zona", 1, 1).cast("int").alias("zona_num"))
    rows = rows.checkpoint(eager=True)
    return rows, training.fitted_gbt(spark, rows, COLUMNS, "xgb_500_01_6", iterations=8)


def test_importances_equal_a_recount_from_the_trees(spark, fitted):
    _, pipeline = fitted
    path = files.staging_dir(spark, "trees")
    pipeline.stages[-1].write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("nodeData.*").where("leftChild >= 0").collect()
    gains = [0.0] * len(COLUMNS)
    for n in nodes:
        gains[n.split.featureIndex] += n.gain * n.rawCount
    want = {c: g / sum(gains) for c, g in zip(COLUMNS, gains, strict=True)}
    got = model.importances(spark, pipeline, COLUMNS)
    found = {r.feature: r.importance for r in got.collect()}
    assert set(found) == set(COLUMNS) and all(found[c] == pytest.approx(want[c], abs=1e-9) for c in COLUMNS)
    top = [r.feature for r in explore.top_k(got, [F.desc("importance"), F.asc("feature")], 3).collect()]
    assert top == sorted(COLUMNS, key=lambda c: (-want[c], c))[:3] and top[0] == "dia_semana_num"


def test_trees_fit_better_than_the_mean_of_all(fitted):
    rows, pipeline = fitted
    p = pipeline.transform(rows).select(F.col("tiempo_espera").alias("y"), F.col("pred_base").alias("p"))
    r = p.agg(F.avg(F.pow(F.col("y") - F.col("p"), 2)).alias("mse"), F.var_pop("y").alias("var"), F.corr("y", "p").alias("corr")).first()
    assert r.mse < r["var"] and r["corr"] > 0.3

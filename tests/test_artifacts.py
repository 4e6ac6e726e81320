"""The artifact store: versions, cut-short writes, missing tables; serving reads no training row."""

import pytest
from pyspark.sql import functions as F

from waitcast.plans import scoring as S
from waitcast.plans import training as TR
from waitcast.sources import artifacts as A
from waitcast.sources import files as FS


def _table(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v double")


def test_versions_are_published_whole_and_never_changed(spark):
    root = FS.staging_dir(spark, "store")
    assert A.versions(spark, root) == []
    with pytest.raises(FileNotFoundError):
        A.open_version(spark, root)
    assert A.publish(spark, root, {"a": _table(spark, ("x", 1.0)), "b": _table(spark)}) == 1
    first = A.open_version(spark, root)
    assert A.publish(spark, root, {"a": _table(spark, ("x", 2.0))}) == 2
    assert A.versions(spark, root) == [1, 2]
    assert first.table("a").first().v == 1.0 and A.open_version(spark, root).table("a").first().v == 2.0
    assert A.open_version(spark, root, 1).table("b").schema == _table(spark).schema
    assert A.open_version(spark, root).table("b", "k string").count() == 0  # S12: a missing table is an empty frame
    with pytest.raises(KeyError):
        A.open_version(spark, root).table("b")
    with pytest.raises(FileNotFoundError):
        A.open_version(spark, root, 7)
    with pytest.raises(ValueError, match="nothing"):
        A.publish(spark, root, {})


def test_a_version_cut_short_is_never_seen(spark):
    root = FS.staging_dir(spark, "store")
    A.publish(spark, root, {"a": _table(spark, ("x", 1.0))})
    broken = _table(spark, ("x", 2.0)).withColumn("v", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        A.publish(spark, root, {"a": _table(spark, ("x", 9.0)), "b": broken})
    assert A.versions(spark, root) == [1] and A.open_version(spark, root).table("a").first().v == 1.0
    # a manifest with fewer rows than it names does not count either
    spark.createDataFrame([(2, 3, "a", "table", "{}")], A.MANIFEST).coalesce(1).write.json(f"{root}/manifests/v=2.json")
    assert A.versions(spark, root) == [1]
    assert A.publish(spark, root, {"a": _table(spark, ("x", 3.0))}) == 2  # writes over both leftovers
    assert A.open_version(spark, root).table("a").first().v == 3.0


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [(i, f"z{i % 3}" if i % 11 else None, f"r{i % 5}", f"2024-{1 + i % 12:02d}-{1 + i % 28:02d}", f"{9 + i % 10}:15" if i % 13 else "n/d", float(5 * (i % 17)),
          float(i % 30) if i % 7 else None, float(i % 90), 1 + i % 4) for i in range(400)],
        "row_id long, zona string, atraccion string, fecha string, hora string, tiempo_espera double, temperatura double, humedad double, codigo_clima int")


def test_serving_reads_no_training_row(spark, rows, monkeypatch):
    root = FS.staging_dir(spark, "store")
    monkeypatch.setattr(TR, "fitted_gbt", lambda s, f, c, config="spark_100_005_8", iterations=None, real=TR.fitted_gbt: real(s, f, c, config, 3))
    TR.run_training(spark, rows, root).collect()
    saved = A.open_version(spark, root)
    assert {"medians", "histories", "target", "enc_zona", "enc_atraccion", "columns", "train_rows", "pipeline"} == set(saved.entries)
    requests = rows.drop("tiempo_espera").unionByName(spark.createDataFrame(
        [(9000, "new", "unseen", "bad", None, None, None, None)], rows.drop("tiempo_espera").schema))
    out = S.score_from_artifacts(spark, requests, root, today="2024-05-01")
    files = {f for f in out.select("row_id", "pred_base", "minutos_predichos").inputFiles()}
    assert not any("/train_rows/" in f for f in files)
    got = {r.row_id: r.pred_base for r in out.collect()}
    train = saved.table("train_rows")
    feats = TR.build_features(S.prepare_requests(requests, today="2024-05-01"), train, serving=True)
    want = {r.row_id: r.pred_base for r in saved.pipeline("pipeline").transform(feats).collect()}
    assert len(got) == 401 and got == pytest.approx(want)

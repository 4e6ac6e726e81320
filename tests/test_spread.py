"""Small files are one task; work that goes over a table many times is spread over the cores, rows as they are."""

from __future__ import annotations

from pyspark.sql import functions as F

from waitcast import session
from waitcast.operators import boosting as BO
from waitcast.operators import model as MD
from waitcast.sources import files as FS


def _one_task(spark, rows):
    return spark.range(0, rows, 1, 1).select("id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 7 * 3).cast("double").alias("tiempo_espera"))


def test_one_large_partition_is_spread_over_the_cores(spark):
    rows = 5 * session.ROWS_EACH
    out = session.spread(_one_task(spark, rows).unionByName(_one_task(spark, 3)).coalesce(1))
    assert out.rdd.getNumPartitions() == min(spark.sparkContext.defaultParallelism, 6)
    assert out.agg(F.count("*"), F.countDistinct("id"), F.sum("x")).first() == (rows + 3, rows, sum(i % 7 for i in range(rows)) + 3)


def test_few_rows_stay_in_one_task(spark):
    assert session.spread(_one_task(spark, 10)).rdd.getNumPartitions() == 1
    assert session.spread(_one_task(spark, 10).where("id < 0")).count() == 0


def test_trees_are_fitted_on_spread_rows(spark, monkeypatch):
    """Every pass of both tree learners goes over as many tasks as there are cores."""
    seen = []
    whole = session.spread

    def noted(df, *args):
        out = whole(df, *args)
        seen.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(MD, "spread", noted)
    monkeypatch.setattr(BO, "spread", noted)
    rows = _one_task(spark, 2 * session.ROWS_EACH)
    model = MD.fit_pipeline(spark, rows, ["x"], MD.gbt(iterations=1))
    assert model.transform(rows).agg(F.max(F.abs(F.col("pred_base") - F.col("tiempo_espera")))).first()[0] < 1e-9
    BO.fit(rows, ["x"], "tiempo_espera", "id", BO.Config(1, 1.0, 1))
    assert seen == [min(spark.sparkContext.defaultParallelism, 2)] * 2


def test_header_lines_are_found_without_sorting_lines(spark, tmp_path):
    (tmp_path / "a").mkdir()
    for name, text in (("1.csv", "b,a\n1,2\n0,0\n"), ("2.csv", "b,a\n"), ("3.csv", "z,a\n!,!\n"), ("4.csv", "")):
        (tmp_path / "a" / name).write_text(text)
    found = {h: sorted(f.rsplit("/", 1)[1] for f in files) for h, files in FS.file_headers(spark, [str(tmp_path / "a")]).items()}
    assert found == {"b,a": ["1.csv", "2.csv"], "z,a": ["3.csv"]}
    plan = FS.first_rows(spark.range(3).select(F.lit("f").alias("f"), F.col("id").alias("i")))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan

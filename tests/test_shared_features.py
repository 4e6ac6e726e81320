"""What the features take from the train rows is fitted once for both parts; fits share one written copy of their rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from waitcast.operators import model as MD
from waitcast.plans import queries_ml as Q
from waitcast.plans import training as TR


def _rows(df):
    return sorted(map(str, df.collect()))


def test_features_of_both_parts_come_from_one_fit(spark, monkeypatch):
    fits, real = [], TR.fit_features

    def counted(*args):
        fits.append(args)
        return real(*args)

    monkeypatch.setattr(TR, "fit_features", counted)
    tr, ftr, fte, cols = Q._features(spark, SF_SMALL)
    assert len(fits) == 1 and cols == TR.feature_columns(ftr)
    _, te = Q._split(spark, SF_SMALL)
    for got, part in ((ftr, tr), (fte, te)):
        want = TR.build_features(part, tr, Q.FEATURED)
        assert got.columns == want.columns
        rounded = [F.round(c, 9).alias(c) if got.schema[c].dataType.typeName() == "double" else F.col(c) for c in got.columns]
        assert _rows(got.select(*rounded)) == _rows(want.select(*rounded))


def test_configurations_share_one_spread_copy(spark, monkeypatch):
    spreads, real = [], MD.spread

    def counted(df, *args):
        spreads.append(df)
        return real(df, *args)

    monkeypatch.setattr(MD, "spread", counted)
    rows = spark.range(200).select((F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 7 * 3).cast("double").alias("tiempo_espera"))
    rows = rows.unionByName(rows.limit(1).select("x", F.lit(None).cast("double").alias("tiempo_espera"))).checkpoint(eager=True)
    for config in ("xgb_500_01_6", "xgb_500_01_8"):
        model = TR.fitted_gbt(spark, rows, ["x"], config, iterations=1, held=True)
        assert model.transform(rows.where("tiempo_espera IS NOT NULL")).agg(F.max(F.abs(F.col("pred_base") - F.col("tiempo_espera")))).first()[0] < 1e-9
    assert not spreads

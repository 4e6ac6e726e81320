"""Statistics that choose their way by a measured size: both ways give the same rows as pandas."""

import numpy as np
import pandas as pd
import pytest

from waitcast.operators import explore as X
from waitcast.operators import history as H


@pytest.fixture(scope="module")
def waits(spark):
    r = np.random.default_rng(8)
    pdf = pd.DataFrame({"atraccion": r.choice(["a", "b", "c"], 4000, p=[0.7, 0.2, 0.1]), "tiempo_espera": np.round(r.gamma(2, 20, 4000), 2)})
    pdf.loc[:5, "tiempo_espera"] = 1e6 + np.arange(6)
    return spark.createDataFrame(pdf).repartition(5).unionByName(spark.createDataFrame([("a", None), (None, 3.0), (None, 4.0)], "atraccion string, tiempo_espera double")), pdf


@pytest.mark.parametrize("group_values", [1 << 20, 10])
def test_whole_history(waits, group_values):
    df, pdf = waits
    v = np.concatenate([pdf.tiempo_espera, [3.0, 4.0]])
    (got,) = H.whole_history(df, ["count", "mean", "std", "p25", "median", "p75", "p90", "p95"], group_values=group_values).collect()
    want = [len(v), v.mean(), v.std(ddof=1), *np.percentile(v, [25, 50, 75, 90, 95])]
    assert np.allclose(list(got), want, rtol=1e-9)


def test_whole_history_of_nothing(waits):
    (got,) = H.whole_history(waits[0].where("tiempo_espera IS NULL"), ["count", "mean", "median"]).collect()
    assert tuple(got) == (0, None, None)
    assert H.all_histories(waits[0].limit(0).selectExpr("*", "1 AS mes", "1 AS hora_int", "1 AS dia_semana_num")).count() == 0


@pytest.mark.parametrize("group_values", [1 << 20, 10])
def test_box_summary_by_group(waits, group_values):
    df, pdf = waits
    pdf = pd.concat([pdf, pd.DataFrame({"atraccion": ["?", "?"], "tiempo_espera": [3.0, 4.0]})])
    got = {r.atraccion or "?": r for r in X.box_summary(df, ["atraccion"], group_values=group_values).collect()}
    assert set(got) == {"a", "b", "c", "?"}
    for name, v in pdf.groupby("atraccion").tiempo_espera:
        q1, median, q3 = np.percentile(v, [25, 50, 75])
        inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
        r = got[name]
        assert np.allclose([r.q1, r.median, r.q3, r.whisker_lo, r.whisker_hi], [q1, median, q3, inside.min(), inside.max()])
        assert r.n_outliers == len(v) - len(inside)

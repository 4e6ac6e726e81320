"""Regularised boosted trees against a plain Python version."""

import math
import random

import pytest
from pyspark.sql import functions as F

from waitcast.operators import boosting as B

COLUMNS = ["a", "b", "c"]
SCHEMA = "id long, a double, b double, c double, y double, extra string"


def table(n, seed=5):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = float(r.randint(0, 6)), r.choice([None, math.nan, r.random(), r.random()]), r.gauss(0, 1)
        missing = b is None or math.isnan(b)
        rows.append((i, a, b, c, 4 * a + (9 if missing else 20 * (b > 0.5)) + r.gauss(0, 1), "x"))
    return rows


def plain_trees(rows, cuts, keys, config, seed):
    """Trees as {node: (feature, bin, missing left)} and {leaf: value}, grown with loops over rows."""
    def bin_of(v, c):
        return B.BINS if v is None or math.isnan(v) else sum(x < v for x in c)

    bins = [[bin_of(r[1 + f], cuts[f]) for f in range(3)] for r in rows]
    base = sum(round(r[4] * B.UNIT) for r in rows) / len(rows) / B.UNIT
    said, out = [base] * len(rows), []

    def score(g, n):
        return max(abs(g / B.UNIT) - config.l1, 0.0) ** 2 / (n + config.l2)

    for number in range(config.trees):
        seen = B.sampled_rows(keys, seed, number, config.rows)
        gradient = [round((p - r[4]) * B.UNIT) for p, r in zip(said, rows, strict=True)]
        splits, inside = {}, {0: list(range(len(rows)))}
        for level in range(config.depth):
            for node in [x for x in inside if x >= (1 << level) - 1 and x not in splits]:
                here, best = [i for i in inside[node] if seen[i]], None
                for f in B.sampled_columns(3, seed, number, level, config):
                    for b in sorted({bins[i][f] for i in here} - {B.BINS}):
                        for missing_left in (True, False):
                            left = [i for i in here if (missing_left if bins[i][f] == B.BINS else bins[i][f] <= b)]
                            right = [i for i in here if i not in set(left)]
                            if min(len(left), len(right)) < config.least_weight:
                                continue
                            gl, gr = sum(gradient[i] for i in left), sum(gradient[i] for i in right)
                            gain = score(gl, len(left)) + score(gr, len(right)) - score(gl + gr, len(here))
                            if gain > 0 and gain >= config.gamma:
                                best = max(best or (0,), (gain, -f, -b, missing_left))
                if best:
                    f, b, missing_left = -best[1], -best[2], best[3]
                    splits[node] = (f, b, missing_left)
                    goes = [(missing_left if bins[i][f] == B.BINS else bins[i][f] <= b) for i in inside[node]]
                    inside[2 * node + 1] = [i for i, g in zip(inside[node], goes, strict=True) if g]
                    inside[2 * node + 2] = [i for i, g in zip(inside[node], goes, strict=True) if not g]
        leaves = {}
        for node in set(inside) - set(splits):
            at = [i for i in inside[node] if seen[i]]
            g = sum(gradient[i] for i in at) / B.UNIT
            leaves[node] = -config.step * math.copysign(max(abs(g) - config.l1, 0.0), g) / (len(at) + config.l2)
            for i in inside[node]:
                said[i] += leaves[node]
        out.append((splits, leaves))
    return out, said


@pytest.mark.parametrize("config", [
    B.Config(4, 0.3, 3, l1=0.5, l2=2.0, gamma=0.1, least_weight=3, rows=0.85, tree_columns=0.85, level_columns=0.85),
    B.Config(3, 0.5, 2, l1=0.0, l2=0.0, gamma=5.0),
    B.Config(2, 0.1, 2, l1=1e9),
])
def test_equals_plain_version(spark, config, monkeypatch):
    monkeypatch.setattr(B, "INTERVAL", 2)  # so that the predictions are written anew on the way
    rows = table(70)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    model = B.fit(df, COLUMNS, "y", "id", config, seed=3)
    keys = df.orderBy("id").select(F.xxhash64("id")).toPandas().iloc[:, 0].to_numpy()
    want, said = plain_trees(rows, model.cuts, keys, config, 3)
    assert len(model.trees) == config.trees
    for tree, (splits, leaves) in zip(model.trees, want, strict=True):
        assert {int(i): (int(tree.feature[i]), int(tree.bin[i]), bool(tree.missing_left[i])) for i in (tree.feature >= 0).nonzero()[0]} == splits
        assert {i: tree.value[i] for i in leaves} == pytest.approx(leaves)
    got = B.predict(df, model).orderBy("id").toPandas()["pred_base"].tolist()
    assert got == pytest.approx(said)
    wrong = sum((p - r[4]) ** 2 for p, r in zip(said, rows, strict=True)) / len(rows)
    assert model.losses[-1][1] == pytest.approx(wrong, abs=1e-3) and model.losses[-1][2] is None


def test_cuts_and_bins(spark):
    rows = [(i, float(i % 4), None, float(i), 1.0, "x") for i in range(1000)]
    cuts = B._cuts(spark.createDataFrame(rows, SCHEMA), COLUMNS)
    assert cuts[0].tolist() == [0.0, 1.0, 2.0] and cuts[1].tolist() == [] and len(cuts[2]) == B.BINS - 1
    import numpy as np
    assert B.binned([np.array([0.0, 0.5, 2.0, 9.0, math.nan])], cuts[:1])[:, 0].tolist() == [0, 1, 2, 3, B.BINS]


def test_validation_ends_the_fit_and_held_out_rows_are_predicted(spark):
    df = spark.createDataFrame(table(600), SCHEMA)
    config = B.Config(40, 0.5, 4, least_weight=5, rows=0.85)
    model = B.fit(df, COLUMNS, "y", "id", config, validation=F.col("id") % 5 == 0, patience=3)
    after = [x[2] for x in model.losses]
    assert after[len(model.trees)] == min(after) and len(model.losses) <= 40
    assert all((t.n[(t.feature < 0) & (t.n > 0)] >= 5).all() for t in model.trees)
    fresh = spark.createDataFrame(table(300, seed=9), SCHEMA)
    p = B.predict(fresh, model).toPandas()
    assert ((p.y - p.pred_base) ** 2).mean() < 0.2 * p.y.var()
    used = model.importances()
    assert used["a"] and used["b"]


def test_no_rows_null_labels_and_one_value(spark):
    with pytest.raises(ValueError):
        B.fit(spark.createDataFrame([(1, 1.0, 1.0, 1.0, None, "x")], SCHEMA), COLUMNS, "y", "id", B.Config(2, 0.1, 2))
    rows = [(None, None, None, None, 7.0, None)] * 5 + [(1, 1.0, 1.0, 1.0, math.nan, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    model = B.fit(df, COLUMNS, "y", "id", B.Config(2, 0.1, 2, rows=0.9))
    assert set(B.predict(df, model).toPandas()["pred_base"]) == {7.0}

"""In-class neighbours and balancing by interpolation against brute force."""

import collections
import random

import numpy as np
import pytest

from waitcast.operators import neighbours as N

SCHEMA = "row_id long, clase string, a double, b double, c int, note string"


def _rows(seed=5, n=900):
    r = random.Random(seed)
    rows = [(i, r.choices("xyz", [6, 2, 1])[0], float(r.randint(0, 12)), r.gauss(0, 3), r.randint(0, 6), f"n{i}") for i in range(n)]
    rows += [(10_000 + i, "y", 1.0, 2.0, 3, "same") for i in range(200)]  # a hot place
    return rows + [(20_000, "x", None, 1.0, 1, "null"), (20_001, "x", float("nan"), 1.0, 1, "nan"), (20_002, None, 1.0, 1.0, 1, "no label"), (20_003, "alone", 1.0, 1.0, 1, "")]


def _places(rows, scale):
    out = {}
    for i, label, *f, _ in rows:
        if label is not None and all(v is not None and v == v for v in f):
            place = (label, *[v / s for v, s in zip(f, scale, strict=True)])
            out[place] = min(i, out.get(place, i))
    return out


def _brute(rows, k, scale):
    by_label = collections.defaultdict(list)
    for (label, *f), i in _places(rows, scale).items():
        by_label[label].append((i, f))
    out = []
    for label, places in by_label.items():
        for i, f in places:
            near = sorted((((f[0] - g[0]) ** 2 + (f[1] - g[1]) ** 2) + (f[2] - g[2]) ** 2, j) for j, g in places if j != i)[:k]
            out += [(label, i, rank, j, d) for rank, (d, j) in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("leaf", [128, 8])
def test_neighbours_equal_brute_force(spark, leaf):
    rows, scale = _rows(), [2.0, 1.0, 0.5]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = N.class_neighbours(df, "row_id", "clase", ["a", "b", "c"], 5, scale, leaf).collect()
    want = _brute(rows, 5, scale)
    assert sorted((r.clase, r.row_id, r["rank"], r.neighbour) for r in got) == [w[:4] for w in want]
    assert np.allclose([r.distance2 for r in sorted(got, key=lambda r: (r.clase, r.row_id, r["rank"]))], [w[4] for w in want], rtol=1e-12)


def test_balancing_lies_between_neighbours(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA)
    got = N.balance_by_neighbours(df, "row_id", "clase", ["a", "b", "c"], scale=[2.0, 1.0, 0.5]).collect()
    before, after = collections.Counter(r[1] for r in rows), collections.Counter(r.clase for r in got)
    top = max(n for c, n in before.items() if c)
    assert after[None] == 1 and all(abs(after[c] - top) <= 0.1 * top for c in before if c and before[c] > 1)
    near = collections.defaultdict(set)
    for _, i, _, j, _ in _brute(rows, 5, [2.0, 1.0, 0.5]):
        near[i].add(j)
    place, raw = _places(rows, [2.0, 1.0, 0.5]), {r[0]: r for r in rows}
    synthetic = [r for r in got if r.synthetic]
    assert len({(r.row_id, r.synthetic) for r in got}) == len(got) and sorted(r.row_id for r in got if not r.synthetic) == sorted(raw)
    for r in synthetic:
        base = raw[r.row_id]
        assert (r.clase, r.note) == (base[1], base[5])
        if r.neighbour is None:  # without a place, or alone
            assert r.clase == "alone" or base[2] is None or base[2] != base[2]
            continue
        assert 0 <= r.gap < 1 and r.neighbour in near[place[(base[1], base[2] / 2, base[3], base[4] / 0.5)]]
        end = raw[r.neighbour]
        assert np.allclose([r.a, r.b, r.c], [base[i] + r.gap * (end[i] - base[i]) for i in (2, 3, 4)])
    again = N.balance_by_neighbours(df.repartition(3), "row_id", "clase", ["a", "b", "c"], scale=[2.0, 1.0, 0.5])
    assert {(r.row_id, r.synthetic, r.neighbour) for r in again.collect()} == {(r.row_id, r.synthetic, r.neighbour) for r in got}


def test_default_scale_and_small_classes(spark):
    df = spark.createDataFrame([(1, "x", 0.0, 5.0), (2, "x", 1.0, 5.0), (3, "x", 3.0, 5.0), (4, "y", 0.0, 5.0)], "row_id long, clase string, a double, b double")
    got = {(r.row_id, r["rank"]): r.neighbour for r in N.class_neighbours(df, "row_id", "clase", ["a", "b"]).collect()}
    assert got == {(1, 1): 2, (1, 2): 3, (2, 1): 1, (2, 2): 3, (3, 1): 2, (3, 2): 1}
    assert N.class_neighbours(df.limit(0), "row_id", "clase", ["a", "b"]).count() == 0
    assert N.balance_by_neighbours(df.limit(0), "row_id", "clase", ["a", "b"]).count() == 0


def test_few_positions_are_compared_with_each(spark):
    r = random.Random(3)
    rows = sorted({(r.randint(0, 40) / 8, r.randint(0, 100) / 16, float(r.randint(1, 5)), r.randint(1, 12) / 2, r.randint(0, 6) / 2) for _ in range(8000)})
    df = spark.createDataFrame([(i, "x", *f) for i, f in enumerate(rows)], "row_id long, clase string, a double, b double, c double, d double, e double")
    places = N.positions(df, "row_id", "clase", list("abcde"), [1.0] * 5)
    cells, counts, _, _, _ = N._in_cells(places, 5, 128)
    held = [x["count"] for x in cells.groupBy(*[f"_c{a}" for a in range(5)]).count().collect()]
    assert len(held) == counts.count() and sum(held) == len(rows) and max(held) < 512 and len(held) >= len(rows) / 512
    near = N.class_neighbours(df, "row_id", "clase", list("abcde"), 5, [1.0] * 5)
    far = max(x.distance2 for x in near.where("rank = 5").collect()) ** 0.5
    # a position's cell is little longer than the distances looked for, in every direction
    sides = cells.groupBy(*[f"_c{a}" for a in range(5)]).agg(*[(N.F.max(f"_f{a}") - N.F.min(f"_f{a}")).alias(f"s{a}") for a in range(5)])
    assert max(max(x[f"s{a}"] for a in range(5)) for x in sides.collect()) <= 4 * far

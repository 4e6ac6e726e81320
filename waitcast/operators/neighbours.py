"""Nearest neighbours inside classes, and class balancing by interpolation between them.

Exact k nearest neighbours without comparing all pairs and without a cap on candidates:

1. Rows of a class at the same place count as one position, so a place that holds a third of all rows costs one.
2. Each position gets up to five coordinates, the features that differ most. Two positions are at least
   as far apart as in any of their coordinates.
3. Coordinates are cut at the class's percentiles, the widest ones into the most parts, so that cells are about as long as
   wide and hold ``leaf`` positions; one part of each is a cell. A cell with many positions is split into blocks of about ``leaf``.
4. The k-th distance to positions of the own cell, or to a bounded sample of the class, bounds the wanted ones. Only
   cells that reach into that bound are searched, all of them, so the result is proven.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitcast.operators.encode import hash_u32
from waitcast.operators.joins import size_checked_join
from waitcast.operators.scalars import with_scalars
from waitcast.session import spread

#: Coordinates at most, and parts of each by their number (powers of two; with more coordinates, the last).
AXES = 5
PARTS = (1024, 128, 32)
#: Positions of a block, and the mean number of positions of a cell aimed at.
LEAF = 128
#: Positions of a class that bound the distance where a cell holds too few.
SAMPLE = 32
#: Distances carry rounding errors; bounds are widened by this share.
SLACK = 1e-9


def _square(a: list[Column], b: list[Column]) -> Column:
    return reduce(add, [(x - y) * (x - y) for x, y in zip(a, b, strict=True)])


def _columns(prefix: str, n: int) -> list[Column]:
    return [F.col(f"{prefix}{i}") for i in range(n)]


def positions(df: DataFrame, key: str, label: str, features: list[str], scale: list[float] | None = None) -> DataFrame:
    """(_label, _key, _f0 ...): one row per place of a class, with its smallest key. A row with a NULL or NaN feature, label or
    key has no place. Features are divided by ``scale``, by default their standard deviations."""
    values = [F.col(c).cast("double") for c in features]
    known = reduce(lambda a, b: a & b, [v.isNotNull() & ~F.isnan(v) for v in values], F.col(label).isNotNull() & F.col(key).isNotNull())
    rows = df.where(known)
    if scale is None:
        deviations = rows.agg(*[F.stddev_samp(v).alias(f"_s{i}") for i, v in enumerate(values)])
        rows = with_scalars(rows, deviations)
        divisors = [F.when(F.col(f"_s{i}") > 0, F.col(f"_s{i}")).otherwise(1.0) for i in range(len(values))]
    else:
        divisors = [F.lit(float(s)) for s in scale]
    placed = rows.select(F.col(label).alias("_label"), F.col(key).alias("_key"),
                         *[(v / d + F.lit(0.0)).alias(f"_f{i}") for i, (v, d) in enumerate(zip(values, divisors, strict=True))])
    return placed.groupBy("_label", *[f"_f{i}" for i in range(len(values))]).agg(F.min("_key").alias("_key"))


def _axes(places: DataFrame, n: int) -> list[int]:
    """The features that serve as coordinates: all, or those AXES that differ most."""
    if n <= AXES:
        return list(range(n))
    found = places.agg(*[F.coalesce(F.stddev_pop(c), F.lit(0.0)).alias(f"_s{i}") for i, c in enumerate(_columns("_f", n))]).first()
    return sorted(sorted(range(n), key=lambda i: -found[i])[:AXES])


def _parts(widths: Column, halvings: Column) -> Column:
    """Into how many parts to cut coordinates of such widths: the widest part is cut in two, ``halvings`` times."""
    def halve(now: Column, _: Column) -> Column:
        return F.transform(now, lambda w, i: F.when(i + 1 == F.array_position(now, F.array_max(now)), w / 2).otherwise(w))
    after = F.aggregate(F.array_repeat(F.lit(0), halvings), widths, halve)
    return F.transform(F.arrays_zip(widths.alias("a"), after.alias("b")), lambda w: F.when(w["b"] > 0, F.round(w["a"] / w["b"])).otherwise(1.0))


def _part(bounds: Column, x: Column, m: Column, parts: int) -> Column:
    """The part that a coordinate lies in: percentiles up to it, of ``parts``, brought down to ``m`` parts."""
    return F.floor(F.size(F.filter(bounds, lambda b: b <= x)) * m / parts).cast("int")


def _in_cells(places: DataFrame, n: int, leaf: int) -> tuple[DataFrame, DataFrame, DataFrame, int, int]:
    """``places`` with coordinates _a0 ..., the cell _c0 ... and the block; (cell, _blocks); the cuts of each class; number of coordinates and of
    percentiles."""
    chosen = _axes(places, n)
    axes = range(len(chosen))
    parts = PARTS[min(len(chosen), len(PARTS)) - 1]
    places = places.withColumns({f"_a{a}": F.col(f"_f{i}") for a, i in enumerate(chosen)})
    # one row per class: percentiles of the coordinates, and parts
    probabilities = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    widths = F.array(*[F.coalesce(F.stddev_pop(f"_a{a}"), F.lit(0.0)) for a in axes])
    classes = places.groupBy("_label").agg(F.count("*").alias("_n"), widths.alias("_w"),
                                           *[F.percentile_approx(f"_a{a}", probabilities, F.lit(max(2000, 4 * parts))).alias(f"_b{a}") for a in axes])
    halvings = F.floor(F.log2(F.greatest(F.col("_n") / F.lit(float(leaf)), F.lit(1.0)))).cast("int")
    classes = classes.withColumn("_m", _parts(F.col("_w"), halvings))
    classes = classes.withColumns({f"_m{a}": F.least(F.col("_m")[a], F.lit(float(parts))) for a in axes}).drop("_m", "_w").checkpoint(eager=True)
    rows = size_checked_join(places, classes, "_label", "inner")
    rows = rows.withColumns({f"_c{a}": _part(F.col(f"_b{a}"), F.col(f"_a{a}"), F.col(f"_m{a}"), parts) for a in axes})
    # the cuts are long: they do not travel with the rows
    rows = rows.drop("_n", *[f"_{x}{a}" for x in "bm" for a in axes])
    cell = ["_label", *[f"_c{a}" for a in axes]]
    counts = rows.groupBy(*cell).agg(F.ceil(F.count("*") / leaf).alias("_blocks")).checkpoint(eager=True)
    rows = size_checked_join(rows, counts, cell, "inner").withColumn("_block", F.pmod(F.xxhash64("_key"), F.col("_blocks")))
    return rows.checkpoint(eager=True), counts, classes, len(chosen), parts


def class_neighbours(df: DataFrame, key: str, label: str, features: list[str], k: int = 5, scale: list[float] | None = None,
                     leaf: int = LEAF) -> DataFrame:
    """(label, key, rank, neighbour, distance2): the k nearest other positions of the class for each position.

    Positions are places of a class (see :func:`positions`), named by the smallest key of the rows there; rank is from 1, nearest
    first, the smaller key first at the same distance. A class with fewer other positions gives all of them.
    """
    n = len(features)
    f, g = _columns("_f", n), _columns("_g", n)
    places = spread(positions(df, key, label, features, scale))
    rows, counts, classes, n_axes, parts = _in_cells(places, n, leaf)
    axes = range(n_axes)
    cell = ["_label", *[f"_c{a}" for a in axes]]

    others = rows.select(*cell, "_block", F.col("_key").alias("_other"),
                         *[F.col(f"_a{a}").alias(f"_x{a}") for a in axes], *[F.col(f"_f{i}").alias(f"_g{i}") for i in range(n)])
    square = _square(f, g)

    # a bound on the k-th distance: own block, and a sample of the class of a fixed size
    near = rows.select(*cell, "_block", "_key", *f).join(others.select(*cell, "_block", "_other", *g), [*cell, "_block"]).where("_key <> _other")
    own = _kth(near.select("_label", "_key", "_block", square.alias("_d2")), k).select("_label", "_key", F.col("_kth").alias("_own"))
    drawn = F.row_number().over(Window.partitionBy("_label", "_salt").orderBy(F.xxhash64("_key"), "_key"))
    sample = others.withColumn("_salt", F.pmod(F.xxhash64("_other"), F.lit(64))).withColumnRenamed("_other", "_key").withColumn("_i", drawn).where(F.col("_i") <= SAMPLE)
    drawn = F.row_number().over(Window.partitionBy("_label").orderBy(F.xxhash64("_key"), "_key"))
    sample = sample.withColumn("_i", drawn).where(F.col("_i") <= SAMPLE).select("_label", F.col("_key").alias("_other"), *g)
    far = size_checked_join(rows.select("_label", "_key", *f), sample, "_label", "inner", materialize=True).where("_key <> _other")
    far = _kth(far.select("_label", "_key", F.lit(0).alias("_block"), square.alias("_d2")), k)
    bounds = far.join(own, ["_label", "_key"], "full").select("_label", "_key", F.least("_kth", "_own").alias("_bound2"))

    # cells that reach into the bound
    asked = rows.drop("_block", "_blocks", *[f"_c{a}" for a in axes]).join(bounds, ["_label", "_key"], "left")
    reach = F.coalesce(F.sqrt("_bound2"), F.lit(float("inf")))
    asked = asked.withColumn("_reach", reach * (1 + SLACK) + SLACK)
    asked = size_checked_join(asked, classes, "_label", "inner")
    for a in axes:
        x, b, m = F.col(f"_a{a}"), F.col(f"_b{a}"), F.col(f"_m{a}")
        width = SLACK * (1 + F.abs(x)) + F.col("_reach")
        asked = asked.withColumns({f"_lo{a}": _part(b, x - width, m, parts), f"_hi{a}": _part(b, x + width, m, parts)})
    for a in axes:
        asked = asked.withColumn(f"_c{a}", F.explode(F.sequence(f"_lo{a}", f"_hi{a}")))
    asked = size_checked_join(asked.select(*cell, "_key", "_reach", *[f"_a{a}" for a in axes], *f), counts, cell, "inner")
    asked = asked.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    found = asked.join(others, [*cell, "_block"]).where("_key <> _other")
    for a in axes:  # cheap test before the distance
        found = found.where(F.abs(F.col(f"_a{a}") - F.col(f"_x{a}")) <= F.col("_reach") + SLACK * (1 + F.abs(F.col(f"_a{a}"))))
    found = found.select("_label", "_key", *[f"_c{a}" for a in axes], "_block", "_other", "_reach", square.alias("_d2")).where(F.col("_d2") <= F.col("_reach") * F.col("_reach"))
    least = F.slice(F.sort_array(F.collect_list(F.struct("_d2", "_other"))), 1, k)
    in_block = found.groupBy("_label", "_key", *[f"_c{a}" for a in axes], "_block").agg(least.alias("_l"))  # a block's positions at most
    merged = F.slice(F.sort_array(F.flatten(F.collect_list("_l"))), 1, k)
    best = in_block.groupBy("_label", "_key").agg(merged.alias("_l")).select("_label", "_key", F.posexplode("_l").alias("_rank", "_e"))
    return best.select(F.col("_label").alias(label), F.col("_key").alias(key), (F.col("_rank") + 1).alias("rank"), F.col("_e._other").alias("neighbour"),
                       F.col("_e._d2").alias("distance2"))


def _kth(pairs: DataFrame, k: int) -> DataFrame:
    """(_label, _key, _kth): the k-th smallest _d2, where there are so many; pairs of a key come from one block."""
    least = F.slice(F.sort_array(F.collect_list("_d2")), k, 1)
    kth = pairs.groupBy("_label", "_key").agg(least.alias("_l"))
    return kth.where(F.size("_l") == 1).select("_label", "_key", F.col("_l")[0].alias("_kth"))


def balance_by_neighbours(df: DataFrame, key: str, label: str, features: list[str], k: int = 5, scale: list[float] | None = None,
                          seed: int = 42) -> DataFrame:
    """Bring every class to about the size of the largest one by rows between in-class neighbours.

    A row of a class with n_c rows gets floor(r) - 1 synthetic rows and one more with the chance frac(r), r = n_max / n_c, by a hash of
    its key, so reruns agree. A synthetic row has the label and the other columns of its base row, and features at
    base + u * (neighbour - base): u in [0, 1) and the neighbour, one of the k nearest positions, follow from the key, the
    copy and ``seed``. Adds ``synthetic`` (copy number, 0 for the rows of ``df``), ``neighbour`` (its key) and ``gap`` (u). A row without a
    place, or alone in its class, is repeated as it is. Rows without label stay single.
    """
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    ratios = with_scalars(counts, counts.agg(F.max("_nc").alias("_nmax"))).select(label, (F.col("_nmax") / F.col("_nc")).alias("_r"))
    rows = size_checked_join(df, ratios, label, "left", materialize=True)
    share = hash_u32(key, seed=104729) / F.lit(4294967296.0)
    more = F.coalesce(F.floor("_r").cast("int") - 1 + (share < F.col("_r") - F.floor("_r")).cast("int"), F.lit(0))
    made = rows.withColumn("_more", more).where("_more > 0").withColumn("synthetic", F.explode(F.sequence(F.lit(1), "_more")))

    near = class_neighbours(df, key, label, features, k, scale).checkpoint(eager=True)
    # every row finds the position that it stands at, by its features
    place = positions(df, key, label, features, scale)
    at = made.select("*", *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(features)])
    raw = df.select(F.col(key).alias("_key"), F.col(label).alias("_plabel"), *[F.col(c).cast("double").alias(f"_q{i}") for i, c in enumerate(features)])
    raw = raw.join(place.select("_key"), "_key", "left_semi")
    same = reduce(lambda a, b: a & b, [F.col(f"_v{i}") == F.col(f"_q{i}") for i in range(len(features))], F.col(label) == F.col("_plabel"))
    at = at.join(raw, same, "left").drop("_plabel", *[f"_q{i}" for i in range(len(features))])
    listed = near.groupBy(F.col(key).alias("_key")).agg(F.array_sort(F.collect_list(F.struct("rank", "neighbour"))).alias("_near"))  # k entries
    at = at.join(listed, "_key", "left")
    draw = F.xxhash64(F.lit(seed), F.col(key), F.col("synthetic"))
    picked = F.col("_near")[F.pmod(draw, F.size("_near")).cast("int")]["neighbour"]
    at = at.withColumn("neighbour", F.when(F.size("_near") > 0, picked)).withColumn("gap", F.pmod(F.shiftright(draw, 16), F.lit(1 << 32)) / F.lit(float(1 << 32)))
    ends = df.select(F.col(key).alias("neighbour"), *[F.col(c).cast("double").alias(f"_q{i}") for i, c in enumerate(features)])
    at = at.join(ends, "neighbour", "left")
    moved = {c: F.coalesce(F.col(f"_v{i}") + F.col("gap") * (F.col(f"_q{i}") - F.col(f"_v{i}")), F.col(f"_v{i}")) for i, c in enumerate(features)}
    at = at.withColumns(moved).withColumn("gap", F.when(F.col("neighbour").isNotNull(), F.col("gap")))
    kept = df.withColumns({c: F.col(c).cast("double") for c in features}).withColumns(
        {"synthetic": F.lit(0), "neighbour": F.lit(None).cast(df.schema[key].dataType), "gap": F.lit(None).cast("double")})
    return kept.unionByName(at.select(*kept.columns))

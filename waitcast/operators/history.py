"""Per-ride historical statistics.

Scale design
------------
Every history first pre-counts ``(keys..., wait) -> n``: a plain hash
aggregate with map-side combine, so a ride holding a third of all rows is
reduced to one row per distinct wait value inside each map task before
anything is shuffled. Statistics then come from the counted rows:
count/mean/std from weighted sums, and exact interpolated percentiles from a
running count per group (a window partitioned by the group keys over one row
per distinct value) followed by ``min(value where cum > rank)`` — declarative
aggregates, no per-group object maps. Key-less (global) statistics rank by value
range (:mod:`waitcast.operators.quantiles`), so no window runs over a whole table.
``exact=False`` switches to ``percentile_approx`` (bounded memory).

All six grains plus ride-only and global come from one pass
(:func:`all_histories`): the pre-counted rows are dealt by ride and every grain of
some rides is derived at once (:mod:`waitcast.operators.ride_histories`). Rides with
so many readings that one task should not hold their counts take GROUPING SETS over the
pre-counted rows instead; there the grain is tagged from ``grouping()`` so a NULL key is
never mistaken for a rolled-up key.
"""

from __future__ import annotations

from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitcast.operators import ride_histories as R
from waitcast.operators.quantiles import exact_percentiles
from waitcast.operators.scalars import with_scalars

# travels with the tasks: many jobs use histories, also where workers do not have this package
cloudpickle.register_pickle_by_value(R)

WAIT = "tiempo_espera"
KEYS = ["atraccion", "mes", "hora_int", "dia_semana_num"]

# grain name -> (group keys, statistics reported by the reference for that grain)
GRAINS: dict[str, tuple[list[str], list[str]]] = {
    "mes": (["atraccion", "mes"], ["count", "mean", "median", "std", "p75", "p90", "p95"]),
    "hora": (["atraccion", "hora_int"], ["count", "mean", "median", "std", "p75", "p90"]),
    "dia": (["atraccion", "dia_semana_num"], ["count", "mean", "median", "std", "p75", "p90"]),
    "mes_dia": (["atraccion", "mes", "dia_semana_num"], ["count", "mean", "median", "p75", "p90"]),
    "hora_dia": (["atraccion", "hora_int", "dia_semana_num"], ["count", "mean", "median", "p75"]),
    "mes_hora": (["atraccion", "mes", "hora_int"], ["count", "mean", "median", "p75"]),
}
# Grains used by the cascade (J7) in addition to the six above.
CASCADE_GRAINS: dict[str, list[str]] = {
    "mes_hora_dia": ["atraccion", "mes", "hora_int", "dia_semana_num"],
    "hora_dia": ["atraccion", "hora_int", "dia_semana_num"],
    "mes_hora": ["atraccion", "mes", "hora_int"],
    "hora": ["atraccion", "hora_int"],
    "mes_dia": ["atraccion", "mes", "dia_semana_num"],
    "dia": ["atraccion", "dia_semana_num"],
    "mes": ["atraccion", "mes"],
    "atraccion": ["atraccion"],
    "global": [],
}
# different values of one group up to which a task may rank them
GROUP_VALUES = 1 << 20
# readings of one ride up to which a task may hold its counts (40 bytes each, and as much again some times over)
RIDE_ROWS = 1 << 21
# statistics of the long histories, in their order
LONG_STATS = ["count", "mean", "std", "p25", "median", "p75", "p90", "p95"]
_PCT = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95}


def precount(df: DataFrame, keys: list[str], value: str = WAIT) -> DataFrame:
    """(keys, value) -> n over rows with a non-null value (map-side combined)."""
    return (df.where(F.col(value).isNotNull())
            .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")))


def _raw_stats(value: str, stats: list[str], suffix: str, quantile) -> list[Column]:
    """Aggregates over raw rows; ``quantile(stat)`` gives a percentile's column."""
    v = F.col(value)
    plain = {"count": F.count(v), "mean": F.avg(v), "std": F.stddev_samp(v)}
    return [(plain[st] if st in plain else quantile(st)).alias(f"{st}_{suffix}" if suffix else st) for st in stats]


def stats_from_counts(pre: DataFrame, keys: list[str], stats: list[str], suffix: str = "",
                      value: str = WAIT) -> DataFrame:
    """Statistics of ``value`` per ``keys`` from pre-counted rows ``(keys, value, _n)``.

    Exact interpolated percentiles without an object aggregate: a running count
    over the counted rows of each group (a window partitioned by the group keys,
    sorted by value — one row per distinct value, so a hot group costs its number
    of distinct values, not its rows), then ``min(value where cum > rank)`` for
    the two ranks around (N-1)p in a plain hash aggregate on the same keys (no
    extra shuffle). Interpolation ``lo + (h - floor(h)) * (hi - lo)``.
    """
    assert keys, "use history() for key-less (global) statistics"
    v, n = F.col(value), F.col("_n")
    # a hash of the keys first: sorting compares eight bytes instead of strings
    own = ["_group", *keys]
    pre = pre.withColumn("_group", F.xxhash64(*keys))
    w = Window.partitionBy(*own).orderBy(value)
    to_here = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = pre.withColumns({"_cum": F.sum(n).over(to_here), "_c": F.first(v).over(to_here), "_tot": F.sum(n).over(every)})
    # sums around the group's smallest value: squares of raw values cancel when they are large
    x = v - F.col("_c")
    pcts = [p for p in stats if p in _PCT]
    aggs = [F.sum(n).alias("_cnt"), F.min("_c").alias("_c"), F.sum(x * n).alias("_s1"), F.sum(x * x * n).alias("_s2")]
    for p in pcts:
        h = (F.col("_tot") - 1) * F.lit(_PCT[p])
        aggs.append(F.min(F.when(F.col("_cum") > F.floor(h), v)).alias(f"_lo_{p}"))
        aggs.append(F.min(F.when(F.col("_cum") > F.ceil(h), v)).alias(f"_hi_{p}"))
    g = d.groupBy(*own).agg(*aggs)
    return g.select(*keys, *_finished(stats, suffix))


def _finished(stats: list[str], suffix: str = "") -> list[Column]:
    """Statistics from a group's count, sums around ``_c`` and the values next to each wanted rank."""
    cnt, s1, s2 = F.col("_cnt"), F.col("_s1"), F.col("_s2")
    out = []
    for st in stats:
        name = f"{st}_{suffix}" if suffix else st
        if st == "count":
            out.append(cnt.alias(name))
        elif st == "mean":
            out.append((F.col("_c") + s1 / cnt).alias(name))
        elif st == "std":
            out.append(F.when(cnt > 1, F.sqrt(F.greatest(F.lit(0.0), (s2 - s1 * s1 / cnt) / (cnt - 1)))).alias(name))
        elif st in _PCT:
            h = (cnt - 1) * F.lit(_PCT[st])
            lo, hi = F.col(f"_lo_{st}"), F.col(f"_hi_{st}")
            out.append((lo + (h - F.floor(h)) * (hi - lo)).alias(name))
        else:
            raise ValueError(st)
    return out


def stats_of_all(counts: DataFrame, stats: list[str], value: str = WAIT) -> DataFrame:
    """The same for all rows as one group, from counts (value, _n): one row, or none without rows. Percentiles are
    ranked by value range (:mod:`waitcast.operators.quantiles`), so no task sorts all values."""
    v, n = F.col(value), F.col("_n")
    pcts = [p for p in stats if p in _PCT]
    around = with_scalars(counts, counts.agg(F.min(v).alias("_c")))
    x = v - F.col("_c")
    moments = around.agg(F.sum(n).alias("_cnt"), F.min("_c").alias("_c"), F.sum(x * n).alias("_s1"), F.sum(x * x * n).alias("_s2"))
    moments = moments.where(F.col("_cnt") > 0)
    if pcts:
        moments = with_scalars(moments, exact_percentiles(counts, [], value, [_PCT[p] for p in pcts]))
        # _q is interpolated: no rest to the next value
        moments = moments.withColumns({f"_{e}_{p}": F.col("_q")[i] for i, p in enumerate(pcts) for e in ("lo", "hi")})
    return moments.select(*_finished(stats))


def history(df: DataFrame, keys: list[str], stats: list[str], suffix: str = "",
            value: str = WAIT, exact: bool = True) -> DataFrame:
    """Generic history: pre-count, then weighted statistics; without keys see :func:`whole_history`."""
    if exact and keys:
        return stats_from_counts(precount(df, keys, value), keys, stats, suffix, value)
    rows = df.where(F.col(value).isNotNull())
    if not exact:
        return rows.groupBy(*keys).agg(*_raw_stats(value, stats, suffix, lambda st: F.percentile_approx(value, F.lit(_PCT[st]), F.lit(10000))))
    return whole_history(df, stats, value).select(*[F.col(st).alias(f"{st}_{suffix}" if suffix else st) for st in stats])


def whole_history(df: DataFrame, stats: list[str], value: str = WAIT, group_values: int = GROUP_VALUES) -> DataFrame:
    """Statistics of all rows: always one row, count 0 and NULLs without values.

    The different values are counted and written (one scan, one small job). Up to ``group_values`` of them are
    ranked by one window; more are ranked by value range over many tasks (:func:`stats_of_all`). Both are exact."""
    counts = precount(df, [], value).checkpoint(eager=True)
    n = counts.count()
    if not n:
        return counts.agg(*[(F.count(value) if st == "count" else F.max(F.lit(None).cast("double"))).alias(st) for st in stats])
    if n > group_values:
        return stats_of_all(counts, stats, value)
    return stats_from_counts(counts.withColumn("_all", F.lit(0)), ["_all"], stats, value=value).select(*stats)


def grain_history(df: DataFrame, grain: str, stats: list[str] | None = None, exact: bool = True) -> DataFrame:
    """History at one of the six reference grains, columns ``<stat>_<grain>``."""
    keys, default_stats = GRAINS[grain]
    return history(df, keys, stats or default_stats, suffix=grain, exact=exact)


def reduced_histories(df: DataFrame) -> dict[str, DataFrame]:
    """Reduced ride x month (count, median, p75, p90) and ride x hour (count, median, p75)."""
    return {"mes": grain_history(df, "mes", ["count", "median", "p75", "p90"]),
            "hora": grain_history(df, "hora", ["count", "median", "p75"])}


def global_stats(df: DataFrame, value: str = WAIT) -> DataFrame:
    """One row with mean, median, std, p75, p90, p95 of the target."""
    return history(df, [], ["count", "mean", "median", "std", "p75", "p90", "p95"], suffix="", value=value) \
        .withColumnRenamed("count", "n").withColumnRenamed("median", "median")


def all_histories(df: DataFrame, grains: list[str] | None = None, value: str = WAIT,
                  exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Every cascade grain in one pass.

    1. pre-count ``(ride, month, hour, weekday, wait) -> n`` (map-side combined);
    2. per ride and grain: weighted count / mean / std and exact percentiles from running counts
       (:func:`histories_from_counts`); the global grain, one group of all rows, comes from :func:`whole_history`.

    Output is long: ``grain, atraccion, mes, hora_int, dia_semana_num, n, mean, std,
    p25, p50, p75, p90, p95``; keys outside the grain are NULL. The grain is tagged
    from ``grouping()``, so a NULL key in the data is never mistaken for a rolled-up key.
    """
    grains = grains or list(CASCADE_GRAINS)
    if not exact:
        return _all_histories_approx(df, grains, value, accuracy)
    keyed = [g for g in grains if g != "global"]
    out = []
    if keyed:
        out.append(histories_from_counts(precount(df, KEYS, value), keyed, value, readings=df))
    if "global" in grains:
        none = [F.lit(None).cast(df.schema[k].dataType).alias(k) for k in KEYS]
        whole = whole_history(df, LONG_STATS, value).where("count > 0").select(F.lit("global").alias("grain"), *none, *LONG_STATS)
        out.append(whole.withColumnsRenamed({"count": "n", "median": "p50"}))
    return reduce(DataFrame.unionByName, out)


def histories_from_counts(pre: DataFrame, grains: list[str], value: str = WAIT, readings: DataFrame | None = None,
                          ride_rows: int = RIDE_ROWS) -> DataFrame:
    """The histories of :func:`all_histories`, but the global one, from counts (KEYS, value, _n).

    Counts are dealt by ride, and a task derives every grain of some rides at once. Rides of more than ``ride_rows`` rows in
    ``readings`` (by default ``pre``) go through :func:`_histories_by_window`, which holds no ride in a task."""
    kind = pre.schema[value].dataType
    if not isinstance(kind, (T.DoubleType, T.FloatType, T.IntegralType)):
        return _histories_by_window(pre, grains, value)
    ride = F.xxhash64(KEYS[0])  # not NULL, so that a NULL ride is a ride
    sizes = (pre if readings is None else readings).groupBy(ride.alias("_ride")).count()
    large = [r[0] for r in sizes.where(F.col("count") > ride_rows).select("_ride").collect()]  # at most rows / ride_rows
    rows = pre.where(~ride.isin(large)) if large else pre
    rows = rows.select(ride.alias("_ride"), *KEYS, F.col(value).cast("double").alias(value), "_n").repartition("_ride").sortWithinPartitions("_ride")
    sets = {g: CASCADE_GRAINS[g] for g in grains}

    def run(batches):
        return R.histories(batches, sets, KEYS, value, list(_PCT.values()))

    fields = [T.StructField("grain", T.StringType()), *[pre.schema[k] for k in KEYS], T.StructField("n", T.LongType()),
              *[T.StructField(c, T.DoubleType()) for c in ("mean", "std", "p25", "p50", "p75", "p90", "p95")]]
    out = rows.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType) for f in fields]))
    return out.unionByName(_histories_by_window(pre.where(ride.isin(large)), grains, value)) if large else out


def _histories_by_window(pre: DataFrame, grains: list[str], value: str) -> DataFrame:
    """The same by GROUPING SETS and windows: a group is sorted, never held."""
    sets = [[F.col(k) for k in CASCADE_GRAINS[g]] + [F.col(value)] for g in grains]
    mid = pre.groupingSets(sets, *KEYS, value).agg(F.sum("_n").alias("_n"), *[F.grouping(k).alias(f"_g_{k}") for k in KEYS])
    mid = mid.select(_grain_tag(grains).alias("grain"), *KEYS, value, "_n")
    return stats_from_counts(mid, ["grain", *KEYS], LONG_STATS, value=value).withColumnsRenamed({"count": "n", "median": "p50"})


def _grain_tag(grains: list[str]) -> Column:
    tag = None
    for g in grains:
        ks = set(CASCADE_GRAINS[g])
        cond = F.lit(True)
        for k in KEYS:
            cond = cond & (F.col(f"_g_{k}") == (0 if k in ks else 1))
        tag = F.when(cond, F.lit(g)) if tag is None else tag.when(cond, F.lit(g))
    return tag


def _all_histories_approx(df: DataFrame, grains: list[str], value: str, accuracy: int) -> DataFrame:
    """A7 with ``percentile_approx`` (T3 option for continuous values): GROUPING SETS over the
    raw rows; every aggregate has bounded, mergeable state, so no group's distinct values are
    ever held. Same output columns as the exact form."""
    v = F.col(value)
    probs = F.array(*[F.lit(p) for p in (0.25, 0.5, 0.75, 0.9, 0.95)])
    sets = [[F.col(k) for k in CASCADE_GRAINS[g]] for g in grains]
    agg = (df.where(v.isNotNull()).groupingSets(sets, *KEYS)
           .agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                F.percentile_approx(v, probs, F.lit(accuracy)).alias("_p"),
                *[F.grouping(k).alias(f"_g_{k}") for k in KEYS]))
    return agg.select(_grain_tag(grains).alias("grain"), *KEYS, "n", "mean", "std",
                      *[F.col("_p")[i].cast("double").alias(n) for i, n in enumerate(["p25", "p50", "p75", "p90", "p95"])])


def grain_slice(hist: DataFrame, grain: str) -> DataFrame:
    """Rows of one grain from :func:`all_histories`, keyed by that grain's columns only."""
    keys = CASCADE_GRAINS[grain]
    return hist.where(F.col("grain") == grain).select(*keys, "n", "mean", "std", "p25", "p50", "p75", "p90", "p95")


def column_percentiles(df: DataFrame, cols: list[str], probs: list[float], prefix: str = "") -> DataFrame:
    """One row of exact interpolated percentiles for several columns in one pass.

    Columns are stacked to (column, value), pre-counted per distinct value
    (map-side combined), and ranked by value range over many tasks
    (:mod:`waitcast.operators.quantiles`). Output columns are ``{prefix}{col}__{i}`` for the i-th probability.
    """
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {stack}) AS (_c, _v)").where(F.col("_v").isNotNull())
    pre = long.groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_n"))
    q = exact_percentiles(pre, ["_c"], "_v", probs, few_groups=True)
    return q.agg(*[F.max(F.when(F.col("_c") == c, F.col("_q")[i])).alias(f"{prefix}{c}__{i}")
                   for c in cols for i in range(len(probs))])

"""Exploration aggregates and top-k reports.

All are single aggregations (map-side combined) over the readings; wide
per-column statistics are computed in one ``agg`` and turned long with
``stack`` rather than one job per column. Exact quantiles are ranked by value range
(:mod:`waitcast.operators.quantiles`); pass ``exact=False`` for ``percentile_approx``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitcast.operators.quantiles import exact_percentiles
from waitcast.functions.labels import wait_class_rule
from waitcast.operators.scalars import with_scalars

WAIT = "tiempo_espera"
LIMITED_ROWS = 10   # fixed threshold of the reference's data-volume rule


def _stack(wide: DataFrame, names: list[str], fields: list[str], name_col: str = "column_name") -> DataFrame:
    parts = ", ".join(f"'{n}', " + ", ".join(f"`{f}__{n}`" for f in fields) for n in names)
    return wide.selectExpr(f"stack({len(names)}, {parts}) as ({name_col}, {', '.join(fields)})")


def describe(df: DataFrame, cols: list[str], exact: bool = True) -> DataFrame:
    """A10: count, mean, std, min, 25%, 50%, 75%, max per column (long form).

    Moments come from one aggregate; exact quartiles from
    :func:`history.column_percentiles` (pre-counted per distinct value).
    """
    from waitcast.operators.history import column_percentiles
    aggs = []
    for c in cols:
        x = F.col(c)
        aggs += [F.count(x).alias(f"count__{c}"), F.avg(x).alias(f"mean__{c}"), F.stddev_samp(x).alias(f"std__{c}"),
                 F.min(x).cast("double").alias(f"min__{c}"), F.max(x).cast("double").alias(f"max__{c}")]
        if not exact:
            q = F.percentile_approx(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(10000))
            aggs += [q[i].alias(f"{n}__{c}") for i, n in enumerate(["p25", "p50", "p75"])]
    wide = df.agg(*aggs)
    if exact:
        q = column_percentiles(df, cols, [0.25, 0.5, 0.75])
        q = q.select(*[F.col(f"{c}__{i}").alias(f"{n}__{c}") for c in cols for i, n in enumerate(["p25", "p50", "p75"])])
        wide = with_scalars(wide, q)
    return _stack(wide, cols, ["count", "mean", "std", "min", "p25", "p50", "p75", "max"])


def null_counts(df: DataFrame) -> DataFrame:
    """NULL count per column, most NULLs first (one aggregate for all columns)."""
    cols = df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"nulls__{c}") for c in cols])
    return _stack(wide, cols, ["nulls"]).orderBy(F.desc("nulls"), "column_name")


def quality_report(df: DataFrame, keys: list[str], target: str = WAIT, order: str = "row_id") -> DataFrame:
    """After keep-first de-duplication on ``keys``: NULLs per column, and the number of
    removed duplicates reported on the target column only (0 elsewhere)."""
    from waitcast.operators.dedup import keep_first
    kept = keep_first(df, keys, [order])
    removed = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.sum(F.col("_n") - 1).alias("_removed"))
    nulls = null_counts(kept)
    return (with_scalars(nulls, removed)
            .select("column_name", "nulls",
                    F.when(F.col("column_name") == target, F.col("_removed")).otherwise(F.lit(0)).cast("long")
                    .alias("duplicates_removed")))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Value -> n, most frequent first."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col)


def mean_by(df: DataFrame, keys: list[str], value: str = WAIT, descending: bool = True) -> DataFrame:
    """Mean wait by keys, fully ordered by the mean (then keys)."""
    g = df.groupBy(*keys).agg(F.avg(value).alias("mean_wait"))
    return g.orderBy(F.desc("mean_wait") if descending else F.asc("mean_wait"), *keys)


def mean_pivot(df: DataFrame, row: str, col: str, values: list, value: str = WAIT) -> DataFrame:
    """A15 (pivot form): explicit pivot values, so no extra job discovers them."""
    return df.groupBy(row).pivot(col, values).agg(F.avg(value))


def correlation_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation for every pair (a < b in list order), one aggregate."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[F.corr(a, b).alias(f"corr__{a}__{b}") for a, b in pairs])
    parts = ", ".join(f"'{a}', '{b}', `corr__{a}__{b}`" for a, b in pairs)
    return wide.selectExpr(f"stack({len(pairs)}, {parts}) as (col_a, col_b, corr)")


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between min and max (last bin closed), like numpy."""
    b = df.agg(F.min(col).alias("_mn"), F.max(col).alias("_mx"))
    x = with_scalars(df.select(col).where(F.col(col).isNotNull()), b)
    idx = F.least(F.floor((F.col(col) - F.col("_mn")) / (F.col("_mx") - F.col("_mn")) * bins), F.lit(bins - 1))
    g = x.groupBy(idx.cast("int").alias("bin"), "_mn", "_mx").agg(F.count(F.lit(1)).alias("n"))
    w = (F.col("_mx") - F.col("_mn")) / bins
    return g.select("bin", (F.col("_mn") + F.col("bin") * w).alias("lo"),
                    (F.col("_mn") + (F.col("bin") + 1) * w).alias("hi"), "n")


#: Different values of a group up to which one task may rank them.
GROUP_VALUES = 1 << 20


def box_summary(df: DataFrame, keys: list[str] | None = None, value: str = WAIT, group_values: int = GROUP_VALUES) -> DataFrame:
    """q1, median, q3, whiskers (furthest points within 1.5 IQR) and outlier count.

    Where no group has more than ``group_values`` different values (measured on the counted rows), they are ranked by
    windows over the group, in one shuffle and without a join; else by value range over many tasks."""
    keys = keys or []
    v, n = F.col(value), F.col("_n")
    pre = df.where(v.isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    if keys:
        pre = pre.checkpoint(eager=True)
        largest = pre.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        if largest <= group_values:
            w = Window.partitionBy(*keys).orderBy(value)
            every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            j = pre.withColumns({"_cum": F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)), "_tot": F.sum(n).over(every)})
            at = {q: (F.col("_tot") - 1) * F.lit(p) for q, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))}
            ends = {f"_{e}_{q}": F.min(F.when(F.col("_cum") > r(h), v)).over(every) for q, h in at.items() for e, r in (("lo", F.floor), ("hi", F.ceil))}
            j = j.withColumns(ends).withColumns({q: F.col(f"_lo_{q}") + (h - F.floor(h)) * (F.col(f"_hi_{q}") - F.col(f"_lo_{q}")) for q, h in at.items()})
            return _boxes(j, keys, value)
    q = exact_percentiles(pre, keys, value, [0.25, 0.5, 0.75]).select(*keys, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"))
    if keys:
        from waitcast.operators.joins import size_checked_join
        return _boxes(size_checked_join(pre, q, keys, "inner", materialize=True, null_safe=True), keys, value)
    return _boxes(with_scalars(pre, q), keys, value)


def _boxes(counted: DataFrame, keys: list[str], value: str) -> DataFrame:
    v, reach = F.col(value), 1.5 * (F.col("q3") - F.col("q1"))
    inside = (v >= F.col("q1") - reach) & (v <= F.col("q3") + reach)
    quartiles = [F.first(q).alias(q) for q in ("q1", "median", "q3")]
    out = counted.groupBy(*keys).agg(*quartiles, F.min(F.when(inside, v)).alias("whisker_lo"), F.max(F.when(inside, v)).alias("whisker_hi"),
                                     F.sum(F.when(~inside, F.col("_n")).otherwise(0)).alias("n_outliers"))
    return out if keys else out.where(F.col("q1").isNotNull())


def month_comparison(df: DataFrame, month: int, top: int = 10) -> DataFrame:
    """Per ride in one month: count, mean, max, min, distinct dates; top ``top`` by mean."""
    m = df.where(F.month("fecha") == month)
    g = m.groupBy("atraccion").agg(F.count(WAIT).alias("n"), F.avg(WAIT).alias("mean_wait"),
                                   F.max(WAIT).alias("max_wait"), F.min(WAIT).alias("min_wait"),
                                   F.count_distinct("fecha").alias("n_dates"))
    return g.orderBy(F.desc("mean_wait"), "atraccion").limit(top)


def weekend_vs_weekday(df: DataFrame) -> DataFrame:
    """Count, mean, std, min, max by weekend flag."""
    return (df.groupBy(F.weekday("fecha").isin(5, 6).cast("int").alias("es_fin_de_semana"))
            .agg(F.count(WAIT).alias("n"), F.avg(WAIT).alias("mean_wait"), F.stddev_samp(WAIT).alias("std_wait"),
                 F.min(WAIT).alias("min_wait"), F.max(WAIT).alias("max_wait")))


def numpy_round(x: Column, digits: int = 1) -> Column:
    """pandas ``.round``: half-even on x * 10^digits (``rint``)."""
    return F.rint(x * F.lit(10.0 ** digits)) / F.lit(10.0 ** digits)


def ride_profile(df: DataFrame, ride: str, by: str) -> DataFrame:
    """One ride by weekday / hour / day of month: mean (rounded 1 dp, pandas style) and count."""
    r = df.where(F.col("atraccion") == ride)
    return r.groupBy(by).agg(numpy_round(F.avg(WAIT)).alias("mean_wait"), F.count(WAIT).alias("n")).orderBy(by)


def month_profile(df: DataFrame, season_col: str = "temporada") -> DataFrame:
    """Per month: its season (constant within a month) and mean wait."""
    return df.groupBy("mes").agg(F.min(season_col).alias(season_col), F.avg(WAIT).alias("mean_wait")).orderBy("mes")


def volume_rule(n: Column) -> Column:
    """Fewer than 10 rows -> 'limited'."""
    return F.when(n < LIMITED_ROWS, F.lit("limited")).otherwise(F.lit("sufficient"))


def headline_counts(df: DataFrame) -> DataFrame:
    """Distinct rides, distinct zones, rows."""
    return df.agg(F.count_distinct("atraccion").alias("n_rides"), F.count_distinct("zona").alias("n_zones"),
                  F.count(F.lit(1)).alias("n_rows"))


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Distinct values, sorted."""
    return df.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col)


def class_distribution(df: DataFrame, value: str = WAIT) -> DataFrame:
    """Rows per wait class (rule form)."""
    return df.groupBy(wait_class_rule(value).alias("clase")).agg(F.count(F.lit(1)).alias("n"))


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """K1/K2/K4: ordered head (TakeOrderedAndProject: per-partition top-k, then merge)."""
    return df.orderBy(*order).limit(k)

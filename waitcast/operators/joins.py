"""Lookups and enrichment joins.

Join strategy: all joins are left equi-joins. History and encoding tables are
aggregates whose size is bounded by the key domain (rides x months x hours x
weekdays), not by the row count — but that bound is measured, not assumed:
history tables are materialised once (reliable checkpoint), their rows are
counted per grain, and a slice is broadcast only when rows x row width fits
``BROADCAST_LIMIT_BYTES``; beyond it the join stays a shuffle join (AQE skew
handling applies). One-row global statistics are bound as scalar subqueries
(``operators/scalars.py``).
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitcast.operators import history as H
from waitcast.operators.scalars import with_scalars

WAIT = H.WAIT
# Largest side we broadcast after measuring it; beyond it the join stays a shuffle join.
BROADCAST_LIMIT_BYTES = 128 * 1024 * 1024


def row_bytes(df: DataFrame) -> int:
    """Rough in-memory row width from the schema (strings counted as 32 bytes)."""
    w = 16
    for f in df.schema.fields:
        w += 32 if isinstance(f.dataType, (T.StringType, T.BinaryType)) else 8
    return w


def fits_broadcast(n_rows: int, df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    return n_rows * row_bytes(df) <= limit


def size_checked_join(left: DataFrame, right: DataFrame, on, how: str = "left",
                      n_rows: int | None = None, limit: int = BROADCAST_LIMIT_BYTES,
                      materialize: bool = False, null_safe: bool = False) -> DataFrame:
    """Join, broadcasting ``right`` only when its measured size is under ``limit``.

    ``n_rows`` is the measured row count of ``right`` (pass it when known; else it
    is counted). ``materialize=True`` first checkpoints ``right`` (an aggregate such
    as an encoding table) so it is computed once and the count is a cheap scan of
    the checkpoint. Beyond the limit the join is left to the planner (shuffle join,
    AQE skew handling). ``null_safe=True`` joins NULL keys with NULL keys.
    """
    if materialize:
        right = right.checkpoint(eager=True)
    if n_rows is None:
        n_rows = right.count()
    fits = fits_broadcast(n_rows, right, limit)
    if not null_safe:
        return left.join(F.broadcast(right) if fits else right, on=on, how=how)
    keys = [on] if isinstance(on, str) else list(on)
    r = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(F.broadcast(r) if fits else r, on=same, how=how).drop(*[f"_right_{k}" for k in keys])


def grain_counts(hist: DataFrame) -> dict[str, int]:
    """Rows per grain of a materialised one-pass history (one tiny aggregate)."""
    return {r["grain"]: r["count"] for r in hist.groupBy("grain").count().collect()}


_STAT_SRC = {"count": "n", "mean": "mean", "median": "p50", "std": "std", "p75": "p75", "p90": "p90", "p95": "p95"}


def attach_histories(df: DataFrame, train: DataFrame, grains: list[str] | None = None,
                     hist: DataFrame | None = None) -> DataFrame:
    """Left-join the six ride histories (fitted on ``train``) onto ``df``.

    The six grains come from one pass (:func:`history.all_histories`),
    materialised once with a reliable checkpoint; each grain slice is joined
    with a size-checked broadcast, so the big side is never shuffled six times.
    Columns are named like the reference (``count_mes``, ``median_hora`` ...).
    """
    grains = grains or list(H.GRAINS)
    if hist is None:
        hist = H.all_histories(train, grains=grains).checkpoint(eager=True)
    counts = grain_counts(hist)
    out = df
    for g in grains:
        keys, stats = H.GRAINS[g]
        sl = H.grain_slice(hist, g).select(*keys, *[F.col(_STAT_SRC[st]).alias(f"{st}_{g}") for st in stats])
        out = size_checked_join(out, sl, keys, "left", n_rows=counts.get(g, 0))
    return out


def global_row(hist: DataFrame) -> DataFrame:
    """The global statistics as one row, NULL where ``hist`` has no global grain."""
    rows = hist.where(F.col("grain") == "global")
    return rows.agg(*[F.first(c).alias(a) for c, a in (("mean", "mean"), ("p50", "median"), ("std", "std"), ("p75", "p75"), ("p90", "p90"), ("p95", "p95"))])


def attach_and_fill(df: DataFrame, train: DataFrame) -> DataFrame:
    """J1 + F19: the six ride histories of ``train`` attached to ``df``, gaps filled by family; one pass over ``train``."""
    hist = H.all_histories(train, grains=[*H.GRAINS, "global"]).checkpoint(eager=True)
    return fill_by_family(attach_histories(df, train, hist=hist), train, hist=hist)


def fill_by_family(df: DataFrame, train: DataFrame | None, value: str = WAIT, hist: DataFrame | None = None) -> DataFrame:
    """fill history columns by name family from global statistics of ``train``, or from the global
    grain of a materialised history ``hist`` that has it.

    ``count_*`` -> 0; ``*mean*`` -> mean; ``*median*`` -> median; ``*std*`` -> std;
    ``*p75*``/``*p90*``/``*p95*`` -> the global percentile. The one-row global
    statistics are bound as a scalar subquery.
    """
    g = (H.global_stats(train, value) if hist is None else global_row(hist)).select(
        F.col("mean").alias("_g_mean"), F.col("median").alias("_g_median"), F.col("std").alias("_g_std"),
        F.col("p75").alias("_g_p75"), F.col("p90").alias("_g_p90"), F.col("p95").alias("_g_p95"))
    j = with_scalars(df, g)
    fills = {}
    for c in df.columns:
        if c.startswith("count_"):
            fills[c] = F.coalesce(F.col(c), F.lit(0))
            continue
        for fam in ("mean", "median", "std", "p75", "p90", "p95"):
            if fam in c:
                fills[c] = F.coalesce(F.col(c), F.col(f"_g_{fam}"))
                break
    return j.withColumns(fills).drop(*g.columns)


WEATHER_COLS = ["temperatura", "humedad", "codigo_clima", "sensacion_termica"]


def one_row_per_key(df: DataFrame, keys) -> DataFrame:
    """One row per key: repeats would multiply readings. Of several, the largest by its columns in order stays."""
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    return df.groupBy(*keys).agg(F.max(F.struct(*others)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def weather_table(weather: DataFrame, keys=("fecha", "hora_int")) -> tuple[DataFrame, int]:
    """The weather, one row per key, written once (checkpoint), and its measured row count: the static side of
    batch joins and of every micro-batch of a stream."""
    w = one_row_per_key(weather, list(keys)).checkpoint(eager=True)
    return w, w.count()


def attach_weather(df: DataFrame, weather: DataFrame, keys=("fecha", "hora_int")) -> DataFrame:
    """Attach the columns of an hourly weather table on (date, hour); repeated keys count once."""
    w, n = weather_table(weather, keys)
    return size_checked_join(df, w, list(keys), "left", n_rows=n)


def fill_missing_weather(df: DataFrame, weather: DataFrame, keys=("fecha", "hora_int"),
                         cols=None, gate: str = "temperatura", n_rows: int | None = None) -> DataFrame:
    """Only rows whose ``gate`` column is NULL take weather; all columns move together.

    ``cols`` defaults to the weather columns that both tables have. Only rows that miss weather enter the join.
    ``n_rows``: ``weather`` comes from :func:`weather_table`; else it is prepared here.
    """
    if n_rows is None:
        weather, n_rows = weather_table(weather, keys)
    cols = list(cols) if cols is not None else [c for c in WEATHER_COLS if c in weather.columns and c in df.columns]
    w = weather.select(*keys, *[F.col(c).alias(f"_w_{c}") for c in cols])
    if df.isStreaming:          # one read of the stream: the gate is in the projection
        j = size_checked_join(df, w, list(keys), "left", n_rows=n_rows)
        fills = {c: F.when(F.col(gate).isNull(), F.col(f"_w_{c}")).otherwise(F.col(c)) for c in cols}
        return j.withColumns(fills).select(*df.columns)
    need = size_checked_join(df.where(F.col(gate).isNull()), w, list(keys), "left", n_rows=n_rows)
    need = need.withColumns({c: F.col(f"_w_{c}").cast(df.schema[c].dataType) for c in cols}).select(*df.columns)
    return df.where(F.col(gate).isNotNull()).unionByName(need)


def weather_keys_needed(df: DataFrame, weather: DataFrame, keys=("fecha", "hora_int"),
                        gate: str = "temperatura") -> DataFrame:
    """Distinct (date, hour) keys of rows missing weather that the weather table lacks."""
    need = df.where(F.col(gate).isNull()).select(*keys).distinct()
    return need.join(weather.select(*keys), on=list(keys), how="left_anti")


def ride_zone_lookup(df: DataFrame) -> DataFrame:
    """Ride -> zone (smallest zone name seen for the ride)."""
    return df.where(F.col("zona").isNotNull()).groupBy("atraccion").agg(F.min("zona").alias("zona"))


def frequency_lookup(df: DataFrame, train: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Rows per category in ``train``; 0 when unseen."""
    name = name or f"{col}_freq"
    freq = train.groupBy(col).agg(F.count(F.lit(1)).alias(name))
    out = size_checked_join(df, freq, col, "left", materialize=True)
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(0)))

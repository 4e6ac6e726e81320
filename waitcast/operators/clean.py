"""Projections, filters and predicates.

Filters are plain Catalyst predicates so they push into parquet scans.
Data-dependent thresholds (quantile trim, IQR) are computed as a one-row
aggregate bound as a scalar subquery and filtered in the same plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from waitcast.operators.quantiles import exact_percentiles
from waitcast.operators.scalars import with_scalars

# Fixed values of the reference.
EXCLUDED_ZONES = ["Halloween", "Warner Beach"]          # zones dropped by the wrangling scripts
QUANTILE_TRIMS = [(0.005, 0.995), (0.02, 0.995), (0.01, 0.99)]  # (low, high) pairs used for trimming
WAIT_CAP = 180.0                                        # fixed cap on the wait in minutes
DOMAIN = {"tiempo_espera": (0, None), "temperatura": (-10, 45), "humedad": (0, 100)}
REQUIRED_REQUEST_FIELDS = ["fecha", "hora", "atraccion", "zona"]


def drop_optional(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop columns if present (``drop`` ignores absent names)."""
    return df.drop(*names)


def project_fixed(df: DataFrame, columns: list[tuple[str, T.DataType]]) -> DataFrame:
    """Select a fixed list in order; absent columns become typed NULLs."""
    have = set(df.columns)
    return df.select(*[(F.col(n).cast(t) if n in have else F.lit(None).cast(t)).alias(n) for n, t in columns])


def exclude_zones(df: DataFrame, zones: list[str] = EXCLUDED_ZONES, col: str = "zona") -> DataFrame:
    """``NOT IN`` that keeps NULL zones (as the pandas original does)."""
    return df.where(~F.coalesce(F.col(col).isin(zones), F.lit(False)))


def drop_closed_zero(df: DataFrame) -> DataFrame:
    """Drop rows with wait 0 while closed; NULL flags or waits are kept."""
    bad = (F.col("tiempo_espera") == 0) & (F.col("abierta") == F.lit(False))
    return df.where(~F.coalesce(bad, F.lit(False)))


def domain_filter(df: DataFrame, bounds: dict = DOMAIN) -> DataFrame:
    """P5: inclusive domain ranges; a NULL in a bounded column drops the row."""
    cond = F.lit(True)
    for c, (lo, hi) in bounds.items():
        if lo is not None:
            cond = cond & (F.col(c) >= lo)
        if hi is not None:
            cond = cond & (F.col(c) <= hi)
    return df.where(cond)


def quantile_bounds(df: DataFrame, col: str, lo: float, hi: float, exact: bool = True) -> DataFrame:
    """One-row frame with ``_lo``/``_hi`` quantiles of ``col``.

    Exact mode pre-counts values (map-side) and ranks them by value range over many tasks
    (:mod:`waitcast.operators.quantiles`).
    """
    if exact:
        pre = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
        return exact_percentiles(pre, [], col, [lo, hi]).select(F.col("_q")[0].alias("_lo"), F.col("_q")[1].alias("_hi"))
    q = F.percentile_approx(F.col(col), F.array(F.lit(lo), F.lit(hi)), F.lit(10000))
    return df.agg(q.alias("_q")).select(F.col("_q")[0].alias("_lo"), F.col("_q")[1].alias("_hi"))


def quantile_trim(df: DataFrame, col: str = "tiempo_espera", lo: float = 0.005, hi: float = 0.995,
                  exact: bool = True) -> DataFrame:
    """Keep rows with ``lo-quantile <= col <= hi-quantile`` (inclusive)."""
    b = quantile_bounds(df, col, lo, hi, exact)
    return (with_scalars(df, b)
            .where((F.col(col) >= F.col("_lo")) & (F.col(col) <= F.col("_hi")))
            .drop("_lo", "_hi"))


def iqr_outliers(df: DataFrame, col: str = "tiempo_espera", k: float = 1.5) -> DataFrame:
    """Rows strictly outside [Q1 - k*IQR, Q3 + k*IQR]."""
    b = quantile_bounds(df, col, 0.25, 0.75)
    b = b.select((F.col("_lo") - k * (F.col("_hi") - F.col("_lo"))).alias("_lo"),
                 (F.col("_hi") + k * (F.col("_hi") - F.col("_lo"))).alias("_hi"))
    return (with_scalars(df, b)
            .where((F.col(col) < F.col("_lo")) | (F.col(col) > F.col("_hi")))
            .drop("_lo", "_hi"))


def cap_wait(df: DataFrame, cap: float = WAIT_CAP, col: str = "tiempo_espera") -> DataFrame:
    """Keep waits <= cap."""
    return df.where(F.col(col) <= cap)


def require(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows with a NULL in any required column."""
    return df.dropna(subset=cols)


def non_blank_zone(df: DataFrame, col: str = "zona") -> DataFrame:
    """P10: drop NULL and blank zones."""
    return df.where(F.col(col).isNotNull() & (F.trim(F.col(col)) != ""))


def only_open(df: DataFrame, col: str = "abierta") -> DataFrame:
    """Rides flagged open."""
    return df.where(F.col(col) == F.lit(True))


def day_slice(df: DataFrame, day: str, col: str = "fecha") -> DataFrame:
    """One date (a literal comparison, prunable on a date-partitioned table)."""
    return df.where(F.col(col) == F.to_date(F.lit(day)))


def name_match(df: DataFrame, name: str, col: str = "atraccion", contains: bool = False) -> DataFrame:
    """Equality or substring match."""
    return df.where(F.col(col).contains(name) if contains else (F.col(col) == name))


def hour_slice(df: DataFrame, lo: float, hi: float, col: str = "hora_int") -> DataFrame:
    """Inclusive hour range."""
    return df.where(F.col(col).between(lo, hi))


def time_of_day_in(ts_text: Column, fmt: str, start: str = "12:00", end: str = "19:30") -> Column:
    """Time of day of ``ts_text`` (parsed with ``fmt``) within [start, end]; bad text -> false."""
    hhmm = F.date_format(F.try_to_timestamp(ts_text, F.lit(fmt)), "HH:mm")
    return F.coalesce(hhmm.between(start, end), F.lit(False))


def degenerate_columns(df: DataFrame) -> DataFrame:
    """P16 (detection): one aggregate over all columns -> (column, all_null, constant).

    ``constant`` follows pandas ``nunique() == 1`` (NULLs ignored) via min == max.
    """
    cols = [c for c, t in df.dtypes if not t.startswith(("array", "map", "struct"))]
    aggs = []
    for c in cols:
        aggs += [F.count(F.col(c)).alias(f"n__{c}"),
                 (F.min(F.col(c)) == F.max(F.col(c))).alias(f"k__{c}")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `n__{c}` = 0, coalesce(`k__{c}`, false)" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, all_null, constant)")


def drop_degenerate(df: DataFrame) -> DataFrame:
    """Drop all-NULL / constant columns. Decides the *schema*, so it reads the
    tiny per-column report (one row per column) on the driver; no data rows move."""
    rep = degenerate_columns(df).where("all_null or constant").select("column_name").collect()
    return df.drop(*[r[0] for r in rep])


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns by schema (booleans excluded)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def keep_numeric(df: DataFrame, also: list[str] | None = None) -> DataFrame:
    keep = set(numeric_columns(df)) | set(also or [])
    return df.select(*[c for c in df.columns if c in keep])


def sample_rows(df: DataFrame, n: int, key_cols: list[str], seed: int = 42) -> DataFrame:
    """Repeatable sample of n rows (order by a seeded hash of the row key).

    A single integer key uses the multiplicative 32-bit hash of the splits (portable:
    any engine can reproduce the sample); other keys use ``xxhash64``. ``limit`` is
    the feature here; Spark plans it as TakeOrderedAndProject (per-partition top-n,
    then a merge of n x partitions rows).
    """
    integral = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if len(key_cols) == 1 and isinstance(df.schema[key_cols[0]].dataType, integral):
        from waitcast.operators.encode import hash_u32
        h = hash_u32(key_cols[0], seed)
    else:
        h = F.xxhash64(F.lit(seed), *[F.col(c) for c in key_cols])
    return df.withColumn("_h", h).orderBy("_h", *key_cols).limit(n).drop("_h")


def missing_weather(col: str = "temperatura") -> Column:
    """Predicate of rows still lacking weather."""
    return F.col(col).isNull()


def validate_requests(df: DataFrame, required: list[str] = REQUIRED_REQUEST_FIELDS) -> DataFrame:
    """P20: add ``missing`` (array of absent required fields, in order) and ``valid``."""
    have = set(df.columns)
    checks = [F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), F.lit(c))
              if c in have else F.lit(c) for c in required]
    missing = F.array_compact(F.array(*checks))
    return df.withColumn("missing", missing).withColumn("valid", F.size("missing") == 0)

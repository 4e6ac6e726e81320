"""Splits and categorical encodings (M1-M7).

Splits are deterministic functions of a row key (repeatable, oracle-able,
executor-loss safe: a recomputed partition gets the same split).

The exact stratified split (M2) avoids a window over a whole stratum: rows
are hashed into 1024 sub-buckets per stratum, a small (stratum x bucket) count
table locates the one boundary bucket per stratum, and only ranks *within*
(stratum, bucket) are computed — a stratum holding a third of all rows is
ranked in 1024 independent pieces.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from waitcast.operators.scalars import with_scalars

_MULT = 2654435761          # Knuth multiplicative hash constant
_M31 = 2147483648
_M32 = 4294967296
SMOOTHING = 10              # fixed smoothing weight of the reference's target encoding


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_u32(key, seed: int = 0) -> Column:
    """Deterministic 32-bit hash of an integer key (no overflow: key is reduced mod 2^31 first)."""
    k = F.pmod(_c(key) + F.lit(seed), F.lit(_M31))
    return F.pmod(k * F.lit(_MULT), F.lit(_M32))


def hash_split_flag(key, train_frac: float = 0.8, seed: int = 0) -> Column:
    """M1: True for the train share of rows."""
    return hash_u32(key, seed) < F.lit(train_frac * _M32)


def hash_split(df: DataFrame, key: str, train_frac: float = 0.8, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    flag = hash_split_flag(key, train_frac, seed)
    return df.where(flag), df.where(~flag)


def nested_split(df: DataFrame, key: str, train_frac: float = 0.8, val_frac: float = 0.2):
    """M1: train/test split, then a validation split of the train rows (different seed)."""
    tr, te = hash_split(df, key, train_frac)
    fit, val = hash_split(tr, key, 1 - val_frac, seed=7919)
    return fit, val, te


def stratified_split(df: DataFrame, key: str, strata: list[str], train_frac: float = 0.8,
                     buckets: int = 1024) -> DataFrame:
    """M2: adds ``is_train``: exactly ceil(train_frac * n) rows per stratum, the ones with
    the smallest (hash, key)."""
    shift = 32 - (buckets - 1).bit_length()
    d = df.withColumn("_u", hash_u32(key)).withColumn("_b", F.shiftright(F.col("_u"), shift))
    cnt = d.groupBy(*strata, "_b").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*strata).orderBy("_b")
    cnt = (cnt.withColumn("_before", F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("_n", F.sum("_c").over(Window.partitionBy(*strata)))
              .withColumn("_k", F.ceil(F.col("_n") * F.lit(train_frac)))
              .withColumn("_need", F.col("_k") - F.col("_before"))
              .select(*strata, "_b", "_c", "_need"))
    from waitcast.operators.joins import size_checked_join
    j = size_checked_join(d, cnt, [*strata, "_b"], "inner", materialize=True, null_safe=True)
    # only the boundary bucket of each stratum is ranked; all other rows are decided where they are
    whole = (F.col("_need") >= F.col("_c")) | (F.col("_need") <= 0)
    rank = F.row_number().over(Window.partitionBy(*strata, "_b").orderBy("_u", key))
    decided = j.where(whole).withColumn("is_train", F.col("_need") > 0)
    ranked = j.where(~whole).withColumn("is_train", rank <= F.col("_need"))
    return decided.unionByName(ranked).drop("_u", "_b", "_c", "_need")


def target_mean_encoding(df: DataFrame, train: DataFrame, col: str, target: str = "tiempo_espera",
                         smoothing: float | None = None, name: str | None = None) -> DataFrame:
    """M3/M4 + J2: category -> mean target over ``train`` (smoothed when ``smoothing``
    is given: (n*mean + s*global)/(n + s)); unseen or NULL category -> global mean."""
    name = name or f"{col}_enc"
    t = train.where(F.col(target).isNotNull())
    g = t.agg(F.avg(target).alias("_g"))
    stats = t.groupBy(col).agg(F.avg(target).alias("_m"), F.count(F.lit(1)).alias("_n"))
    if smoothing is not None:
        stats = with_scalars(stats, g).select(
            col, ((F.col("_n") * F.col("_m") + F.lit(float(smoothing)) * F.col("_g")) /
                  (F.col("_n") + F.lit(float(smoothing)))).alias(name))
    else:
        stats = stats.select(col, F.col("_m").alias(name))
    from waitcast.operators.joins import size_checked_join
    out = with_scalars(size_checked_join(df, stats, col, "left", materialize=True), g)
    return out.withColumn(name, F.coalesce(F.col(name), F.col("_g"))).drop("_g")


def ride_hour_encoding(df: DataFrame, train: DataFrame, featured: str, target: str = "tiempo_espera",
                       name: str = "featured_hora_enc") -> DataFrame:
    """M5: mean target by (ride, hour) over train rows of the featured ride; other rows -> NULL
    (the reference only encodes the featured ride)."""
    t = train.where(F.col("atraccion").contains(featured) & F.col(target).isNotNull())
    stats = t.groupBy("atraccion", "hora_int").agg(F.avg(target).alias(name))
    from waitcast.operators.joins import size_checked_join
    return size_checked_join(df, stats, ["atraccion", "hora_int"], "left", materialize=True)


def _safe(v) -> str:
    return re.sub(r"[^0-9A-Za-z]+", "_", str(v)).strip("_")


def one_hot_names(categories: list, col: str) -> dict[str, object]:
    """Column name -> category, in sorted order; categories that clean to the same name get a number."""
    names: dict[str, object] = {}
    for v in sorted(categories):
        base = name = f"{col}_{_safe(v)}"
        i = 2
        while name.lower() in {n.lower() for n in names}:
            name, i = f"{base}_{i}", i + 1
        names[name] = v
    return names


def one_hot(df: DataFrame, train: DataFrame, col: str) -> DataFrame:
    """M7: one int column per category seen in ``train``; unseen categories are all-zero.

    The category list (the domain, not the rows) is read on the driver, as
    ``StringIndexer`` does; use :func:`one_hot_vector` for the MLlib form.
    """
    cats = one_hot_names([r[0] for r in train.where(F.col(col).isNotNull()).select(col).distinct().collect()], col)
    return df.withColumns({name: F.col(col).eqNullSafe(F.lit(v)).cast("int") for name, v in cats.items()})


def one_hot_vector(train: DataFrame, col: str):
    """M7 (MLlib): StringIndexer(handleInvalid='keep') + OneHotEncoder pipeline fitted on train."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    return Pipeline(stages=[
        StringIndexer(inputCol=col, outputCol=f"{col}_idx", handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{col}_idx"], outputCols=[f"{col}_ohe"], handleInvalid="keep"),
    ]).fit(train)

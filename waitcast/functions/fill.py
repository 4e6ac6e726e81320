"""Null fills and typed casts.

Fill values that depend on data (medians) are computed in one pass for all
columns (pre-counted per distinct value, so the state is bounded by distinct
values) and bound as a one-row scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from waitcast.operators.scalars import with_scalars

# Fixed defaults of the reference for prediction requests.
REQUEST_DEFAULTS = {"temperatura": 20.0, "humedad": 60.0, "codigo_clima": 3, "hora": 12.0}
UNKNOWN_CODE_LABEL = "Desconocido"


def median_fill(df: DataFrame, cols: list[str], label_cols: dict[str, str] | None = None,
                absent_zero: bool = True) -> DataFrame:
    """NULL -> exact median of the column (one aggregate for all columns);
    ``label_cols`` get a constant label; columns absent from ``df`` are added as 0."""
    from waitcast.operators.history import column_percentiles
    present = [c for c in cols if c in df.columns]
    out = df
    if present:
        med = column_percentiles(df, present, [0.5], prefix="_med_")     # one row
        out = with_scalars(out, med)
        out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"_med_{c}__0").cast(df.schema[c].dataType))
                               for c in present}).drop(*[f"_med_{c}__0" for c in present])
    for c, lab in (label_cols or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit(lab)))
    if absent_zero:
        missing = [c for c in cols if c not in df.columns]
        if missing:
            out = out.withColumns({c: F.lit(0) for c in missing})
    return out


def typed_casts(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """tolerant casts (bad text -> NULL)."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in casts.items()})


def request_defaults(df: DataFrame, train_medians: DataFrame | None = None, today: str | None = None) -> DataFrame:
    """defaults for scoring requests.

    * weather: training median if ``train_medians`` (one row: temperatura, humedad) is
      given, else the fixed constants; code -> 3; feels-like -> temperature;
    * bad date -> ``today`` (a parameter, so runs are repeatable);
    * bad hour -> 12.0 (expects a parsed ``hora_num`` column).
    """
    out = df
    if train_medians is not None:
        m = train_medians.select(F.col("temperatura").alias("_m_t"), F.col("humedad").alias("_m_h"))
        out = with_scalars(out, m)
        t_def, h_def = F.col("_m_t"), F.col("_m_h")
    else:
        t_def, h_def = F.lit(REQUEST_DEFAULTS["temperatura"]), F.lit(REQUEST_DEFAULTS["humedad"])
    cols: dict[str, Column] = {
        "temperatura": F.coalesce(F.col("temperatura"), t_def),
        "humedad": F.coalesce(F.col("humedad"), h_def),
        "codigo_clima": F.coalesce(F.col("codigo_clima"), F.lit(REQUEST_DEFAULTS["codigo_clima"])),
    }
    out = out.withColumns(cols)
    if "sensacion_termica" in out.columns:
        out = out.withColumn("sensacion_termica", F.coalesce(F.col("sensacion_termica"), F.col("temperatura")))
    else:
        out = out.withColumn("sensacion_termica", F.col("temperatura"))
    if today is not None:
        out = out.withColumn("fecha", F.coalesce(F.col("fecha"), F.to_date(F.lit(today))))
    if "hora_num" in out.columns:
        out = out.withColumn("hora_num", F.coalesce(F.col("hora_num"), F.lit(REQUEST_DEFAULTS["hora"])))
    return out.drop("_m_t", "_m_h")

"""Registry of named queries: Spark job + DuckDB oracle SQL.

Every query reads the driver tables (through :mod:`waitcast.sources.tables`)
in full. ``@RE``/``@RO``/``@RL``/``@WD`` in oracle SQL expand to the DuckDB
twins of the readings/weather mappings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitcast.sources import tables as tb

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

_MACROS = {
    "@RE": tb.SQL["readings_events"],
    "@RO": tb.SQL["readings_orders"],
    "@RL": tb.SQL["readings_lineitem"],
    "@WD": tb.SQL["weather_daily"],
}


def expand(sql: str) -> str:
    for k in sorted(_MACROS, key=len, reverse=True):
        sql = sql.replace(k, f"({_MACROS[k]})")
    return sql


def query(name: str, sql: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` and its oracle.

    The registered callable first points the session at its checkpoint folder
    (``spark.checkpoint.dir``; a temporary one only when unset), since several
    jobs materialise intermediate tables with ``checkpoint()``.
    """
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from waitcast.session import ensure_checkpoint_dir
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = expand(sql)
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (oracle compare is value-hash based)."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def load_all() -> None:
    """Import the modules that register queries."""
    from waitcast.plans import (queries_core, queries_clean, queries_features,  # noqa: F401
                                queries_explore, queries_history, queries_io, queries_ml, queries_scoring,
                                queries_sources)

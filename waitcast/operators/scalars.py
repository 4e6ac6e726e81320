"""Attach one-row statistics to every row without a join.

Global statistics (quantile bounds, medians, global means, counts) are one-row
aggregates. They are attached as a scalar subquery (``DataFrame.scalar()``): the
aggregate runs once per query, its single row is bound as a struct literal, and
no join (and no cross join) appears in the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """``df`` plus the columns of the one-row frame ``one_row`` (bound once as a scalar subquery)."""
    cols = one_row.columns
    st = one_row.select(F.struct(*[F.col(c) for c in cols]).alias("_s")).scalar()
    return df.withColumn("_scalar_row", st).select(*[F.col(c) for c in df.columns],
                                                  *[F.col("_scalar_row")[c].alias(c) for c in cols])

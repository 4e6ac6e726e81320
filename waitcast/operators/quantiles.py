"""Exact interpolated percentiles that no single task has to hold.

``percentile`` keeps a map of all distinct values of a group in its final task, and a window over a
group sorts them in one. Here the values of a group are counted by value range first (64 ranges per
power of two), the ranges that hold the wanted ranks are found from that table, their rows are cut
into 4,096 pieces each, and only the pieces are ranked. A value range or piece table has a bounded
number of rows per group; everything that grows with the data is spread by (group, range, piece).
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGES_PER_OCTAVE = 64
PIECES = 4096


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(and_, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)])


def exact_percentiles(counted: DataFrame, keys: list[str], value: str, probs: list[float], weight: str = "_n",
                      few_groups: bool = False) -> DataFrame:
    """(keys, _q): array of the percentiles ``probs`` of ``value``, interpolated linearly, for each group.

    ``counted`` holds one or more rows per (keys, value) with a positive ``weight``; NULL values are left
    out, NULL keys form groups, and without keys there is one row (none for an empty input).

    A group has at most two wanted ranges for each percentile, and 4,097 pieces in each. Without keys, or
    with ``few_groups`` (as many as the caller names, such as columns), these tables are bounded and are
    broadcast, so no value is shuffled for a join; else the planner decides.
    """
    bounded = F.broadcast if few_groups or not keys else lambda df: df
    own = [f"_k{i}" for i in range(len(keys))]
    rows = counted.where(F.col(value).isNotNull()).select(
        *[F.col(k).alias(o) for k, o in zip(keys, own, strict=True)], F.col(value).cast("double").alias("_v"), F.col(weight).alias("_w"))
    # grows with the value, so ranges are in the order of their values
    rows = rows.withColumn("_b", F.floor(F.signum("_v") * RANGES_PER_OCTAVE * F.log2(1 + F.abs("_v"))))
    group = Window.partitionBy(*own) if own else Window.partitionBy(F.lit(0))
    to_here = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = rows.groupBy(*own, "_b").agg(F.sum("_w").alias("_t"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    ranges = ranges.withColumns({"_before": F.sum("_t").over(to_here) - F.col("_t"), "_total": F.sum("_t").over(group)})
    at = [(F.col("_total") - 1) * F.lit(p) for p in probs]
    wanted = reduce(lambda a, b: a | b, [(F.col("_before") <= r) & (r < F.col("_before") + F.col("_t")) for h in at for r in (F.floor(h), F.ceil(h))])
    found = ranges.where(wanted).select(*[F.col(o).alias(f"_r{o}") for o in own], F.col("_b").alias("_rb"), "_lo", "_hi", "_before", "_total")

    inner = rows.join(bounded(found), _same([*own, "_b"], [*[f"_r{o}" for o in own], "_rb"])).select(*own, "_b", "_v", "_w", "_lo", "_hi", "_before", "_total")
    share = F.when(F.col("_hi") > F.col("_lo"), (F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))).otherwise(0.0)
    inner = inner.withColumn("_piece", F.floor(share * PIECES))
    pieces = inner.groupBy(*own, "_b", "_piece").agg(F.sum("_w").alias("_t"))
    to_piece = Window.partitionBy(*own, "_b").orderBy("_piece").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = pieces.select(*[F.col(o).alias(f"_p{o}") for o in own], F.col("_b").alias("_pb"), F.col("_piece").alias("_pp"),
                           (F.sum("_t").over(to_piece) - F.col("_t")).alias("_ahead"))
    ranked = inner.join(bounded(pieces), _same([*own, "_b", "_piece"], [*[f"_p{o}" for o in own], "_pb", "_pp"]))
    to_value = Window.partitionBy(*own, "_b", "_piece").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = ranked.withColumn("_cum", F.col("_before") + F.col("_ahead") + F.sum("_w").over(to_value))

    ends = [F.min(F.when(F.col("_cum") > r, F.col("_v"))).alias(f"_{e}{i}") for i, h in enumerate(at) for e, r in (("lo", F.floor(h)), ("hi", F.ceil(h)))]
    out = ranked.groupBy(*own).agg(F.max("_total").alias("_total"), *ends)
    if not own:
        out = out.where(F.col("_total").isNotNull())
    between = [F.col(f"_lo{i}") + (h - F.floor(h)) * (F.col(f"_hi{i}") - F.col(f"_lo{i}")) for i, h in enumerate(at)]
    return out.select(*[F.col(o).alias(k) for k, o in zip(keys, own, strict=True)], F.array(*between).alias("_q"))

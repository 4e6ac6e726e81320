"""De-duplication and precedence merges.

Keep-first / keep-last are written as ``min_by`` / ``max_by`` aggregates over
a struct of the row, ordered by an explicit sequence column (T12: a total
order, never file concat order). Unlike ``row_number()`` over a window, these
aggregates combine map-side: a key holding a third of all rows collapses to
one candidate per map task before the shuffle, so no task ever sorts a hot
group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEDUP_KEYS = ["fecha", "hora", "atraccion"]


def _pick(df: DataFrame, keys: list[str], order: list[str], last: bool) -> DataFrame:
    others = [c for c in df.columns if c not in keys]
    # a struct even for one column: min_by / max_by skip rows whose order value is NULL, and a struct never
    # is. A row without a sequence loses against any row with one.
    ordkey = F.struct(*[x for c in order for x in ((F.col(c).isNull() != F.lit(last)).alias(f"_null_{c}"), F.col(c))])
    row = F.struct(*[F.col(c) for c in others])
    agg = (F.max_by if last else F.min_by)(row, ordkey).alias("_r")
    out = df.groupBy(*keys).agg(agg)
    return out.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others]).select(*df.columns)


def keep_first(df: DataFrame, keys: list[str] = DEDUP_KEYS, order: list[str] = ("row_id",)) -> DataFrame:
    """One row per key, the one with the smallest ``order`` value."""
    return _pick(df, list(keys), list(order), last=False)


def keep_last(df: DataFrame, keys: list[str] = DEDUP_KEYS, order: list[str] = ("row_id",)) -> DataFrame:
    """One row per key, the one with the largest ``order`` value."""
    return _pick(df, list(keys), list(order), last=True)


def dedup_report(df: DataFrame, keys: list[str] = DEDUP_KEYS) -> DataFrame:
    """D1 count: rows in, rows kept, duplicates removed (one aggregate per key first)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.sum("_n").alias("rows_in"), F.count(F.lit(1)).alias("rows_out"),
                       (F.sum("_n") - F.count(F.lit(1))).alias("duplicates_removed"))


def exact_duplicate_groups(df: DataFrame) -> DataFrame:
    """Identical rows with their multiplicity (n > 1)."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def exact_duplicate_members(df: DataFrame) -> DataFrame:
    """D3: every member of a group of identical rows (``duplicated(keep=False)``).

    Members are identical, so they are regenerated from (row, n): the grouping combines
    map-side, and a large group is cut into pieces of at most 1,024 members that are dealt
    out before they are expanded, so neither a task nor an array holds a whole group.
    """
    piece = 1024
    g = exact_duplicate_groups(df)
    starts = g.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(piece))))
    dealt = starts.withColumn("_m", F.least(F.col("n") - F.col("_i"), F.lit(piece))).repartition(F.xxhash64(*df.columns, "_i"))
    return dealt.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_m")))).select(*df.columns)


def exact_duplicate_count(df: DataFrame) -> DataFrame:
    """D3 count: rows that repeat an earlier identical row."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def ride_trace(df: DataFrame, ride: str, order: list[str] = ("fecha", "hora")) -> DataFrame:
    """Time-ordered trace of one ride (range-partitioned global sort)."""
    return df.where(F.col("atraccion") == ride).orderBy(*order)


def union_aligned(*dfs: DataFrame) -> DataFrame:
    """Union all by column name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def precedence_merge(sources: list[DataFrame], keys: list[str] = DEDUP_KEYS,
                     seq: str | list[str] = "row_id") -> DataFrame:
    """Union sources in precedence order (later wins), keep the last per key.

    Each source gets ``_src`` = its position; the winner per key is the row with
    the largest (``_src``, ``seq``).
    """
    tagged = [s.withColumn("_src", F.lit(i)) for i, s in enumerate(sources)]
    u = union_aligned(*tagged)
    seqs = [seq] if isinstance(seq, str) else list(seq)
    return keep_last(u, keys, ["_src", *seqs]).drop("_src")


def append_keep_latest(existing: DataFrame, new: DataFrame, keys: list[str] = DEDUP_KEYS,
                       seq: str = "row_id") -> DataFrame:
    """Existing plus new, new wins on key collisions."""
    return precedence_merge([existing, new], keys, seq)


def columnwise_append(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """U4: attach the columns of an aligned frame by key (no positional zip); the right side is measured
    before it is broadcast."""
    from waitcast.operators.joins import size_checked_join
    return size_checked_join(left, right, keys, "left", materialize=True)

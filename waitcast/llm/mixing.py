"""Mixing sources to target weights: weighted fair queueing over shuffled documents.

Every source is a queue of its documents in a shuffled order, gone through ``epochs`` times.
A document's virtual finish time is its source's running word count divided by the source's
target. All queue entries are sorted by finish time over the whole cluster and taken until the
total budget is spent, so at any point of the mix the sources stand in the ratio of their targets.

Running sums never gather a source in one task: a source is cut into 4,096 ranges of the shuffle
key, sums are taken inside (source, range) and carried on from a table of range totals; the global
sum does the same over the partitions of a range sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waitcast.llm.scratch import WORD_PATTERN, materialise, partitions, text_or_empty
from waitcast.operators.scalars import with_scalars

#: Ranges of the shuffle key: the top 12 bits of a 64-bit hash.
RANGE_BITS = 12
#: Fixed values of the contract query: weights in turn over the sources in code point order, null last.
CYCLE = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2


def n_words(column: Column) -> Column:
    return F.regexp_count(column, F.lit(WORD_PATTERN)).cast("long")


def cyclic_weights(sources: DataFrame, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """(source, weight) for each row of ``sources``, one row per source: the weights in turn, by code point, null last."""
    place = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last()))
    turn = F.array(*[F.lit(float(w)) for w in cycle])
    return sources.select("source", F.element_at(turn, ((place - 1) % len(cycle) + 1).cast("int")).alias("weight"))


def targets(sizes: DataFrame, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size, weight), one row per source.

    ``share`` times all sizes is dealt out by weight; a target stops at ``epochs`` times its
    source's size and the excess is dealt to the others by weight, until none is above. In order
    of the level at which a source fills up, it is full if the budget covers that level for all
    sources not filled before, so one pass finds the end of the repeated dealing. A source without
    words, or with a null, zero or negative weight, gets the target 0.
    """
    weight = F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0))
    cap = F.when(weight > 0, F.col("source_size") * F.lit(float(epochs))).otherwise(0.0)
    s = sizes.select("source", "source_size", weight.alias("w"), cap.alias("cap"))
    every = W.partitionBy(F.lit(0))
    level = F.when(F.col("w") > 0, F.col("cap") / F.col("w")).otherwise(0.0)
    s = s.withColumn("budget", F.sum("source_size").over(every) * F.lit(float(share))).withColumn("level", level)
    order = every.orderBy("level", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, W.currentRow)
    rest = every.orderBy("level", F.col("source").asc_nulls_last()).rowsBetween(W.currentRow, W.unboundedFollowing)
    s = s.withColumn("before", F.sum("cap").over(order) - F.col("cap")).withColumn("rest", F.sum("w").over(rest))
    s = s.withColumn("full", F.col("level") * F.col("rest") + F.col("before") <= F.col("budget"))
    left = F.col("budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(every)
    open_w = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(every)
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.least(F.col("cap"), left * F.col("w") / open_w))
    return s.select("source", "source_size", target.alias("target"))


def plan(docs: DataFrame, weights: DataFrame | None = None, share: float = SHARE, epochs: int = EPOCHS,
         seed: int = 42) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text): how often the mix takes it.

    ``weights`` is (source, weight), one row per source; a source that it lacks gets nothing. None
    means the weights in turn. Returns doc_id, source, place (the shuffle key), size, source_size,
    target, finish (first virtual finish time), copies and taken (words, repeats counted). Null
    sources form one source of their own. Rows equal in doc_id, source and text stand at the same
    place and are taken alike. A document without words is taken with no effect on the budget.
    The order depends on ``seed`` and the rows alone, so reruns agree.
    """
    spark: SparkSession = docs.sparkSession
    n = partitions(spark)
    text = text_or_empty()
    place = F.xxhash64(F.lit(seed), F.col("doc_id"), text)
    rows = materialise(docs.select("doc_id", "source", n_words(text).alias("size"), place.alias("place")), "mix-sizes")
    rows = rows.withColumn("piece", F.shiftrightunsigned(F.col("place"), 64 - RANGE_BITS).cast("int"))

    pieces = rows.groupBy("source", "piece").agg(F.sum("size").alias("piece_size"))
    sizes = pieces.groupBy("source").agg(F.sum("piece_size").alias("source_size"))
    if weights is None:
        weights = cyclic_weights(sizes)
    weights = weights.select(F.col("source").alias("w_source"), "weight")
    sizes = sizes.join(weights, F.col("source").eqNullSafe(F.col("w_source")), "left").drop("w_source")
    aims = targets(sizes, share, epochs).select(F.col("source").alias("a_source"), "source_size", "target")
    up_to = W.partitionBy("source").orderBy("piece").rowsBetween(W.unboundedPreceding, W.currentRow)
    pieces = pieces.withColumn("offset", F.sum("piece_size").over(up_to) - F.col("piece_size"))
    pieces = pieces.join(aims, F.col("source").eqNullSafe(F.col("a_source"))).select(
        F.col("source").alias("p_source"), F.col("piece").alias("p_piece"), "offset", "source_size", "target")

    rows = rows.join(pieces, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("piece") == F.col("p_piece")))
    order = W.partitionBy("p_source", "p_piece").orderBy("place", "doc_id").rangeBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("before", F.col("offset") + F.sum("size").over(order))
    rows = materialise(rows.select("doc_id", "source", "place", "size", "source_size", "target", "before"), "mix-queues")

    def entry(epoch: Column) -> Column:
        finish = (F.col("before") + epoch * F.col("source_size")) / F.col("target")
        return F.struct(finish.alias("finish"), "source", "place", "doc_id", epoch.cast("int").alias("epoch"))

    key = ["finish", "source", "place", "doc_id", "epoch"]
    queue = rows.where("target > 0").select("size", F.explode(F.array(*[entry(F.lit(e)) for e in range(epochs)])).alias("entry"))
    queue = queue.select("size", "entry.*").repartitionByRange(n, *key).withColumn("part", F.spark_partition_id())
    queue = materialise(queue, "mix-order")
    ends = queue.groupBy("part").agg(F.sum("size").alias("part_size"))  # one row per partition of the range sort
    ahead = F.sum("part_size").over(W.partitionBy(F.lit(0)).orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow))
    ends = ends.select(F.col("part").alias("e_part"), (ahead - F.col("part_size")).alias("ahead"))
    within = W.partitionBy("part").orderBy(*key).rowsBetween(W.unboundedPreceding, W.currentRow)
    queue = queue.withColumn("spent", F.sum("size").over(within)).join(F.broadcast(ends), F.col("part") == F.col("e_part"))
    budget = rows.agg((F.sum("size") * F.lit(float(share))).alias("budget")).scalar()
    last = queue.where(F.col("ahead") + F.col("spent") <= budget).agg(F.max(F.struct(*key)).alias("last"))

    copies = sum(F.when((F.col("target") > 0) & (entry(F.lit(e)) <= F.col("last")), 1).otherwise(0) for e in range(epochs))
    out = with_scalars(rows, last).withColumn("copies", F.coalesce(copies, F.lit(0)).cast("int"))
    finish = F.when(F.col("target") > 0, F.col("before") / F.col("target"))
    return out.select("doc_id", "source", "place", "size", "source_size", "target", finish.alias("finish"), "copies",
                      (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, weights: DataFrame | None = None, share: float = SHARE, epochs: int = EPOCHS,
        seed: int = 42) -> DataFrame:
    """The rows of ``docs`` that the mix takes, all columns, each as often as it is taken."""
    mixed = plan(docs, weights, share, epochs, seed)
    taken = mixed.where("copies > 0").select(F.col("doc_id").alias("_llm_id"), F.col("source").alias("_llm_source"),
                                             F.col("place").alias("_llm_place"), F.col("copies").alias("_llm_copies")).distinct()
    place = F.xxhash64(F.lit(seed), F.col("doc_id"), text_or_empty())
    same = (F.col("doc_id").eqNullSafe(F.col("_llm_id")) & F.col("source").eqNullSafe(F.col("_llm_source"))
            & (place == F.col("_llm_place")))
    rows = docs.join(taken, same)
    times = F.explode(F.sequence(F.lit(1), F.col("_llm_copies"))).alias("_llm_copy")
    return rows.select(*[docs[c] for c in docs.columns], times).drop("_llm_copy")

"""LM scoring: the cross-entropy difference of two matched n-gram models.

A target model and a background model of the same order and smoothing are counted over the same
vocabulary, the 256 bytes, so neither has unknown words. The background counts are scaled to the
target's total, so that smoothing weighs the same in both. A document's score is the mean over its
bytes of the loss under the target model minus the loss under the background model: the lower, the
more it looks like the target.

The counts cover all documents and the models grow with the corpus, so they are never broadcast or
collected: texts are written in batches, bucketed by batch, with each batch's distinct n-grams. The
n-grams are counted and smoothed in a shuffle by n-gram, and every batch gets back the losses of its
own n-grams, which then meet its texts without a shuffle of those.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waitcast.llm.scratch import folder, materialise, partitions, text_or_empty
from waitcast.operators.scalars import with_scalars

#: Bytes of an n-gram: the last one is predicted from those before it. At most 7, which fit a long.
ORDER = 5
#: Weight of the uniform distribution, in counts, at each context.
SMOOTHING = 1.0
#: Bytes of text in a batch, about; bounds a task's memory.
BATCH_BYTES = 8 << 20


def keys(text: bytes, order: int) -> np.ndarray:
    """Every n-gram of a text as a number, its first byte the highest."""
    data = np.frombuffer(text, np.uint8).astype(np.int64)
    n = max(len(data) - order + 1, 0)
    out = np.zeros(n, np.int64)
    for i in range(order):
        out = out << 8 | data[i:i + n]
    return out


def _batches(docs: DataFrame, order: int) -> DataFrame:
    """A table bucketed by batch: rows of (batch, doc_id, text), and one row per batch with its distinct
    n-grams and how often they stand in target documents and in all."""
    spark: SparkSession = docs.sparkSession

    def counts(name: int, texts: list[bytes], target: list[bool]) -> pa.RecordBatch:
        gram, n = np.unique(np.concatenate([keys(t, order) for t in texts]), return_counts=True)
        some, m = np.unique(np.concatenate([np.zeros(0, np.int64), *[keys(t, order) for t, is_target in zip(texts, target, strict=True) if is_target]]), return_counts=True)
        in_target = np.zeros(len(gram), np.int64)
        in_target[np.searchsorted(gram, some)] = m
        lists = [pa.array([x], pa.list_(pa.int64())) for x in (gram, in_target, n)]
        return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()), *lists], names=names)

    names = ["batch", "doc_id", "text", "grams", "in_target", "in_all"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, texts, target, size = TaskContext.get().partitionId() << 32, [], [], 0
        for b in batches:
            for lo in range(0, len(b), 256):
                piece = b.slice(lo, 256)
                new = [t.as_buffer().to_pybytes() for t in piece.column(1).cast(pa.large_binary())]
                texts += new
                target += piece.column(2).to_pylist()
                size += sum(map(len, new))
                none = [pa.nulls(len(piece), pa.list_(pa.int64()))] * 3
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(piece), pa.int64()), piece.column(0), piece.column(1), *none], names=names)
                if size >= BATCH_BYTES:
                    yield counts(name, texts, target)
                    name, texts, target, size = name + 1, [], [], 0
        if texts:
            yield counts(name, texts, target)

    rows = docs.mapInArrow(run, "batch long, doc_id long, text string, grams array<long>, in_target array<long>, in_all array<long>")
    table = f"lm_batches_{uuid.uuid4().hex}"
    (rows.write.format("parquet").option("compression", "zstd").bucketBy(partitions(spark), "batch").sortBy("batch")
     .saveAsTable(table, path=folder(spark, "lm-batches")))
    return spark.table(table)


def losses(counted: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """(gram, loss_target, loss_background), in nats, from (gram, in_target, in_all), one row per n-gram.

    p(byte | context) = (count + smoothing / 256) / (count of context + smoothing). Without target
    documents the target model is uniform.
    """
    one = W.partitionBy(F.shiftright("gram", 8))  # the n-grams of a context: 256 at most
    rows = with_scalars(counted, counted.agg((F.sum("in_target") / F.sum("in_all")).alias("scale")))
    rows = rows.withColumn("scaled", F.col("in_all") * F.when(F.col("scale") > 0, F.col("scale")).otherwise(1.0))

    def loss(column: str) -> Column:
        return -F.log((F.col(column) + smoothing / 256) / (F.sum(column).over(one) + smoothing))

    return rows.select("gram", loss("in_target").alias("loss_target"), loss("scaled").alias("loss_background"))


def score(docs: DataFrame, target: DataFrame, order: int = ORDER, smoothing: float = SMOOTHING) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_tokens, loss_target, loss_background, score.

    ``target`` (doc_id) names the target documents; the background is all documents. n_tokens: bytes with a
    whole context before them; losses are means over them, score their difference. A null or short text has
    no tokens and null scores. Repeated rows count as often as they stand; ids that ``docs`` lacks, nulls
    and repeats in ``target`` don't matter.
    """
    if not 2 <= order <= 7:
        raise ValueError("an n-gram has 2 to 7 bytes")
    chosen = target.select(F.col("doc_id").cast("long").alias("t_id")).where("t_id IS NOT NULL").distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    # the target list grows with the corpus: joined by shuffle at every size
    rows = rows.join(chosen.hint("merge"), F.col("doc_id") == F.col("t_id"), "left").select("doc_id", "text", F.col("t_id").isNotNull().alias("target"))
    table = _batches(rows, order)

    found = table.where("grams IS NOT NULL").select("batch", F.explode(F.arrays_zip("grams", "in_target", "in_all")).alias("g"))
    found = found.select("batch", F.col("g.grams").alias("gram"), "g.in_target", "g.in_all")
    counted = found.groupBy("gram").agg(F.sum("in_target").alias("in_target"), F.sum("in_all").alias("in_all"))
    model = losses(materialise(counted, "lm-counts"), smoothing)
    own = found.select("batch", "gram").join(model, "gram").select(F.col("batch").alias("of_batch"), "gram", "loss_target", "loss_background")

    def per_batch(texts: pa.Table, model: pa.Table) -> pa.Table:
        gram = model.column("gram").to_numpy()
        by = np.argsort(gram)
        gram, loss = gram[by], [model.column(c).to_numpy()[by] for c in ("loss_target", "loss_background")]
        n, means = [], ([], [])
        for t in texts.column("text"):
            at = np.searchsorted(gram, keys(t.as_py().encode(), order))
            n.append(len(at))
            for total, x in zip(means, loss, strict=True):
                total.append(float(x[at].mean()) if len(at) else None)
        difference = [None if a is None else a - b for a, b in zip(*means, strict=True)]
        return pa.table({"doc_id": texts.column("doc_id"), "n_tokens": pa.array(n, pa.int64()), "loss_target": pa.array(means[0], pa.float64()),
                         "loss_background": pa.array(means[1], pa.float64()), "score": pa.array(difference, pa.float64())})

    texts = table.where("grams IS NULL").select("batch", "doc_id", "text")
    return texts.groupBy("batch").cogroup(own.groupBy("of_batch")).applyInArrow(
        per_batch, "doc_id long, n_tokens long, loss_target double, loss_background double, score double")

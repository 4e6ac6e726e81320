"""Exact dedup against a persistent digest index, bucketed and sorted by digest.

The index is a bucketed Parquet table of (digest, keep_id, group_size), one row per batch and
digest. New data are hashed, pre-aggregated to one row per digest, sort-merge anti-joined with the
index (the bucketed side is read without a shuffle), and the new digests appended, bucketed and
sorted alike. Digests that the index already holds are appended as updates of their group.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waitcast.llm.scratch import ascii_lower, folder, materialise, text_or_empty


def digest(column: str = "text") -> Column:
    """SHA-256, lowercase hex, of the text with A-Z lower-cased, in UTF-8; null counts as empty."""
    return F.sha2(ascii_lower(text_or_empty(column)).cast("binary"), 256)


class DigestIndex:
    """A digest index at ``path``, in the shared folder or any store that Spark writes.

    Opening an existing path continues with it. ``buckets`` must stay the same over the life of an
    index; about one per 256 MB of digests (64 bytes a row) expected at its largest.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 64):
        self.spark, self.buckets = spark, buckets
        self.path = path or folder(spark, "digests")
        self.table = f"digests_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.table} (digest STRING, keep_id BIGINT, group_size BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'")

    def _append(self, rows: DataFrame) -> None:
        rows = rows.select("digest", "keep_id", "group_size").repartition(self.buckets, "digest")
        (rows.write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
         .saveAsTable(self.table, path=self.path))

    def groups(self) -> DataFrame:
        """One row per digest over all batches: digest, keep_id (largest doc_id; null if all are null), group_size."""
        return self.spark.table(self.table).groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))

    def add(self, docs: DataFrame) -> DataFrame:
        """Dedupe a batch against itself and everything added before, and add it to the index.

        Returns one row per digest that the index did not hold: digest, keep_id, group_size within
        the batch. Rows of the batch whose digest is known are dropped from this result; their group
        in the index grows, and the largest doc_id of all batches stays.
        """
        batch = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest().alias("digest"))
        batch = batch.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        known = self.spark.table(self.table).select(F.col("digest").alias("known"))
        held = F.col("digest") == F.col("known")
        fresh = batch.join(known.hint("merge"), held, "left_anti").withColumn("fresh", F.lit(True))
        again = batch.join(known.hint("merge"), held, "left_semi").withColumn("fresh", F.lit(False))
        step = materialise(fresh.unionByName(again), "digest-batch")  # the append must not change what it reads
        self._append(step)
        self.spark.catalog.refreshTable(self.table)
        return step.where("fresh").drop("fresh")

    def lookup(self, docs: DataFrame) -> DataFrame:
        """``docs`` (all columns) with keep_id, group_size, kept and text_sha256 from the index.

        Of several rows that share the kept doc_id and the text, all count as kept. Where every
        doc_id of a group is null, keep_id is null and the rows count as kept.
        """
        clash = [c for c in ("keep_id", "group_size", "kept", "text_sha256") if c in docs.columns]
        rows = docs.drop(*clash).withColumn("text_sha256", digest())
        groups = materialise(self.groups(), "digest-groups").withColumnRenamed("digest", "_llm_digest")  # else a large group is one task's
        out = rows.join(groups, F.col("text_sha256") == F.col("_llm_digest"), "left").drop("_llm_digest")
        return out.withColumn("kept", F.col("doc_id").cast("long").eqNullSafe(F.col("keep_id")))

    def close(self) -> None:
        """Forget the table's name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, columns unchanged: of equal texts the one with the largest doc_id.

    Rows repeated with the same doc_id and text are one document: one of them stays. With an index,
    only texts new to it stay.
    """
    index = index or DigestIndex(docs.sparkSession)
    fresh = index.add(docs).select(F.col("digest").alias("_llm_digest"), F.col("keep_id").alias("_llm_keep"))
    rows = docs.withColumn("_llm_text", digest())
    stays = (F.col("_llm_text") == F.col("_llm_digest")) & F.col("doc_id").cast("long").eqNullSafe(F.col("_llm_keep"))
    return rows.join(fresh, stays, "left_semi").dropDuplicates(["doc_id", "_llm_text"]).drop("_llm_text")

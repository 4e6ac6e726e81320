"""Line dedup over levelled sorted runs of line hashes.

A run holds one row per line key of one or more batches: the key's 128-bit hash, the number of
documents that hold it and the largest of their ids, bucketed and sorted by hash. Every batch
becomes a run of level 0; when a level has ``fanout`` runs, they are merged into one run of the
next level, so a corpus of n batches is spread over about ``fanout`` * log(n) runs and every row is
rewritten log(n) times. The lines of a batch are merge-anti-joined with the runs.

Only hashes, ids and positions are shuffled by line; a text meets its list of surviving positions
once, by document.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waitcast.llm.scratch import SPACES, ascii_lower, folder, materialise, text_or_empty

#: Fixed values of the contract query.
MIN_CHARS = 40
MIN_DOCS = 5


def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _hashes(key: Column) -> Column:
    """Two 64-bit hashes of a key with different seeds: 128 bits."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


@dataclass
class LineRuns:
    """The levelled runs below ``root``, a folder that Spark writes. Documents of different batches are
    taken as different documents: a document belongs to one batch."""

    spark: SparkSession
    root: str = ""
    fanout: int = 4
    buckets: int = 64
    min_chars: int = MIN_CHARS
    levels: list[list[str]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.root = self.root or folder(self.spark, "line-runs")

    def _write(self, rows: DataFrame, level: int) -> str:
        name = f"lines_{level}_{uuid.uuid4().hex}"
        (rows.select("h1", "h2", "n_docs", "last_doc").repartition(self.buckets, "h1").write.format("parquet")
         .bucketBy(self.buckets, "h1").sortBy("h1", "h2").saveAsTable(name, path=f"{self.root}/{name}"))
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        return name

    @staticmethod
    def _merged(runs: DataFrame) -> DataFrame:
        return runs.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))

    def keys(self) -> DataFrame:
        """One row per line key over all runs: h1, h2, n_docs, last_doc."""
        names = [n for level in self.levels for n in level]
        tables = [self.spark.table(n) for n in names]
        rows = tables[0]
        for t in tables[1:]:
            rows = rows.unionByName(t)
        return rows if len(tables) == 1 else self._merged(rows)

    def add(self, docs: DataFrame) -> None:
        """Add the keys of a batch of documents as a run of level 0, and compact the levels that are full."""
        text = text_or_empty()
        keys = F.filter(F.transform(F.split(text, "\n"), line_key), lambda k: F.char_length(k) >= self.min_chars)
        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(F.array_distinct(F.transform(keys, _hashes))).alias("h"))
        found = found.select("doc_id", "h.h1", "h.h2").distinct()  # a document may be spread over several rows
        self._write(found.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc")), 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            runs = self.spark.table(full[0])
            for n in full[1:]:
                runs = runs.unionByName(self.spark.table(n))
            self._write(self._merged(runs), level + 1)
            level += 1

    def strip(self, docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
        """``docs`` (all columns) with n_lines, n_dropped and kept_text.

        A line whose key has at least ``min_chars`` code points and is in at least ``min_docs`` documents
        of the runs goes, unless this document is the largest that holds it. Other lines stay in order,
        joined by a line feed. A null text is one empty line. Where every doc_id that holds a key is
        null, its lines stay.
        """
        clash = [c for c in ("n_lines", "n_dropped", "kept_text") if c in docs.columns]
        rows = docs.drop(*clash)
        names = rows.columns
        text = text_or_empty()
        # rows are told apart by id and text; rows alike in both fare alike
        alike = [F.col("doc_id").cast("long").alias("_llm_r_id"), F.xxhash64(text).alias("_llm_r_1"), F.xxhash64(F.lit(1), text).alias("_llm_r_2")]
        lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("at"), line_key(x).alias("key")))
        long_lines = F.filter(lines, lambda x: F.char_length(x["key"]) >= self.min_chars)
        hashed = F.transform(long_lines, lambda x: F.struct(x["at"].alias("at"), _hashes(x["key"]).alias("h")))
        found = docs.select(*alike, F.explode(hashed).alias("l")).select("_llm_r_id", "_llm_r_1", "_llm_r_2", "l.at", "l.h.h1", "l.h.h2")
        often = self.keys().where((F.col("n_docs") >= min_docs) & F.col("last_doc").isNotNull()).select(
            F.col("h1").alias("f1"), F.col("h2").alias("f2"), "last_doc")
        goes = (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")) & ~F.col("_llm_r_id").eqNullSafe(F.col("last_doc"))
        stay = found.join(often.hint("merge"), goes, "left_anti")
        stay = stay.groupBy("_llm_r_id", "_llm_r_1", "_llm_r_2").agg(F.collect_set("at").alias("_llm_stay"))
        stay = stay.select(F.col("_llm_r_id").alias("_llm_s_id"), F.col("_llm_r_1").alias("_llm_s_1"), F.col("_llm_r_2").alias("_llm_s_2"), "_llm_stay")
        rows = rows.select(*names, *alike)
        same = F.col("_llm_r_id").eqNullSafe(F.col("_llm_s_id")) & (F.col("_llm_r_1") == F.col("_llm_s_1")) & (F.col("_llm_r_2") == F.col("_llm_s_2"))
        rows = rows.join(stay, same, "left").select(
            *names, F.coalesce("_llm_stay", F.array().cast("array<int>")).alias("_llm_stay"), F.split(text, "\n").alias("_llm_l_all"))
        is_long = F.filter(F.transform(F.col("_llm_l_all"), lambda x, i: F.when(F.char_length(F.btrim(x, F.lit(SPACES))) >= self.min_chars, i)),
                           lambda i: i.isNotNull())
        rows = rows.withColumn("_llm_l_gone", F.array_except(is_long, F.col("_llm_stay")))
        places = F.array_except(F.sequence(F.lit(0), F.size("_llm_l_all") - 1), F.col("_llm_l_gone"))
        kept = F.array_join(F.transform(places, lambda i: F.element_at(F.col("_llm_l_all"), i + 1)), "\n")
        return rows.select(*names, F.size("_llm_l_all").cast("long").alias("n_lines"), F.size("_llm_l_gone").cast("long").alias("n_dropped"),
                           kept.alias("kept_text"))


def dedup_lines(docs: DataFrame, runs: LineRuns | None = None, min_docs: int = MIN_DOCS) -> DataFrame:
    """Add ``docs`` to the runs as one batch and strip its lines against all of them."""
    runs = runs or LineRuns(docs.sparkSession)
    runs.add(docs)
    return runs.strip(docs, min_docs)

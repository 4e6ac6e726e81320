"""Structured Streaming ingestion.

The reference polls a feed every 15 minutes and appends CSV files; here the
same flow is a file stream:

* X1  ``readStream`` over a folder of snapshot files, explicit schema,
      ``Trigger.AvailableNow`` (process what is there, then stop) or a
      processing-time trigger;
* X2  drop repeated (fecha, hora, atraccion) readings within a watermark
      (keep-first; bounded state);
* X3  keep-last merge into the curated table inside ``foreachBatch``: only the
      date-range partitions present in the micro-batch are read, merged and
      written as new versions, and one commit file switches to them, so a tick costs O(batch), not
      O(table). A replayed batch id is a no-op (idempotent sink);
* X4  the batch cleaning/enrichment chain applied to each micro-batch;
* X5  stream-static left joins (weather, histories);
* X6  15-minute tick rollup per ride with a watermark (append mode, or update mode into
      an append log whose newest version per key is the result).

Merged partitions go to new files and old ones are never touched, so a micro-batch
never reads and overwrites the same files.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitcast.operators import clean as C
from waitcast.operators import dedup as D
from waitcast.operators import joins as J


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream with an explicit schema."""
    r = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def dedup_within_watermark(stream: DataFrame, keys: list[str], event_time: str = "ts",
                           delay: str = "1 hour") -> DataFrame:
    """First reading of each key within the watermark delay."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def tick_rollup(stream: DataFrame, event_time: str = "ts", delay: str = "30 minutes",
                tick: str = "15 minutes") -> DataFrame:
    """Per 15-minute tick and ride: readings, mean, max wait. State is bounded by the
    watermark; use append mode (final windows) or update mode with :class:`AppendLog`."""
    return (stream.withWatermark(event_time, delay)
            .groupBy(F.window(event_time, tick).alias("tick"), "atraccion")
            .agg(F.count(F.lit(1)).alias("n"), F.avg("tiempo_espera").alias("mean_wait"),
                 F.max("tiempo_espera").alias("max_wait")))


def enrich_static(stream: DataFrame, weather: DataFrame | None = None, keys=("fecha", "hora_int"),
                  n_rows: int | None = None) -> DataFrame:
    """Stream-static enrichment (weather only where missing, J4). Inside ``foreachBatch`` pass the table and
    the count of ``joins.weather_table``, so that the static side is not computed for each micro-batch."""
    if weather is None:
        return stream
    return J.fill_missing_weather(stream, weather, keys, n_rows=n_rows)


def clean_batch(batch: DataFrame) -> DataFrame:
    """The batch cleaning chain for one micro-batch."""
    return C.non_blank_zone(C.drop_closed_zero(C.exclude_zones(batch)))


class CuratedMerge:
    """``foreachBatch`` sink that keeps the newest reading per key.

    The curated table is parquet in partitions by the day of ``fecha`` (``partition_format`` sets the grain). Each
    micro-batch: de-duplicate the batch (keep last by ``seq``), read only the curated partitions of the batch's dates,
    merge, and write the merged partitions as new versions below ``parts/_held=<batch id>``. One commit file,
    ``commits/b=<batch id>.json``, then names the version that holds each partition, and the batch id with them.
    It is the only step that readers see: a failure before it leaves the old table, a replay writes over what was
    left, and a batch id that is committed is a no-op. Versions are never changed, so a reader keeps its table.

    ``prefer="seq"`` (default) keeps the row with the largest ``seq`` whatever
    batch it came in: the result does not depend on file arrival order.
    ``prefer="arrival"`` lets the later batch win, as the reference's
    append-then-keep-last does.
    """

    def __init__(self, path: str, keys: list[str], seq: str | list[str] = "row_id", transform=None,
                 prefer: str = "seq", partition_format: str = "yyyy-MM-dd"):
        self.path, self.keys, self.transform, self.prefer = path, keys, transform, prefer
        self.seq = [seq] if isinstance(seq, str) else list(seq)
        # daily by default: a live tick only touches today's partition; backfills spanning
        # years pass "yyyy-MM" so each micro-batch rewrites a few month partitions instead
        # of thousands of small daily ones
        self.partition_format = partition_format

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = last_commit(spark, self.path)
        if last is not None and batch_id <= last.batch_id:
            return
        b = self.transform(batch) if self.transform else batch
        b = D.keep_last(b, self.keys, self.seq)
        b = b.withColumn("_part", F.date_format("fecha", self.partition_format)).checkpoint(eager=True)
        # partition names, not rows: the days (or months) of one micro-batch
        parts = {r[0] for r in b.select("_part").distinct().collect()}
        held = last.held if last else {}
        old = last.read(spark, parts & set(held)) if parts & set(held) else None
        merged = b
        if old is not None:
            old = old.withColumn("_part", F.date_format("fecha", self.partition_format)).select(*b.columns)
            if self.prefer == "arrival":
                merged = D.precedence_merge([old, b], self.keys, self.seq)
            else:
                merged = D.keep_last(D.union_aligned(old, b), self.keys, self.seq)
        if parts:
            merged.write.mode("overwrite").partitionBy("_part").parquet(f"{self.path}/parts/_held={batch_id}")
        self._commit(spark, Commit(self.path, batch_id, {**held, **dict.fromkeys(parts, batch_id)}, b.drop("_part").schema))

    def _commit(self, spark: SparkSession, commit: Commit) -> None:
        write_commit(spark, commit)


#: Rows of a commit file: one per partition with the batch id that holds it, and one with the table's schema.
COMMIT = "batch_id long, entries int, part string, holder long, schema string"


@dataclass(frozen=True)
class Commit:
    """One state of a curated table: which version holds each partition (None: rows without a date)."""

    path: str
    batch_id: int
    held: dict[str | None, int]
    schema: T.StructType

    def read(self, spark: SparkSession, parts: set[str | None] | None = None) -> DataFrame:
        """The table, or some of its partitions."""
        chosen = self.held if parts is None else {p: self.held[p] for p in parts}
        if not chosen:
            return spark.createDataFrame([], self.schema)
        root = f"{self.path}/parts"
        paths = [f"{root}/_held={holder}/_part={'__HIVE_DEFAULT_PARTITION__' if part is None else part}" for part, holder in sorted(chosen.items(), key=str)]
        return spark.read.schema(self.schema).option("basePath", root).parquet(*paths).select(*self.schema.names)


def write_commit(spark: SparkSession, commit: Commit) -> None:
    """Make ``commit`` the newest one, by one file."""
    rows = [(commit.batch_id, len(commit.held), part, holder, None) for part, holder in commit.held.items()]
    rows.append((commit.batch_id, len(commit.held), None, None, commit.schema.json()))
    spark.createDataFrame(rows, COMMIT).coalesce(1).write.mode("overwrite").json(f"{commit.path}/commits/b={commit.batch_id}.json")


def last_commit(spark: SparkSession, path: str) -> Commit | None:
    """The newest commit of a curated table. Commit files are listed, only the newest is read."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(f"{path}/commits")
    except AnalysisException:
        return None
    newest = files.select(F.max(F.regexp_extract("path", r"/b=(\d+)\.json/", 1).cast("long"))).first()[0]
    if newest is None:
        return None
    rows = spark.read.schema(COMMIT).json(f"{path}/commits/b={newest}.json").collect()  # a row per partition
    held = {r["part"]: r["holder"] for r in rows if r["schema"] is None}
    if not rows or len(held) != rows[0]["entries"]:
        raise RuntimeError(f"commit {newest} of {path} is incomplete")
    return Commit(path, newest, held, T.StructType.fromJson(json.loads(next(r["schema"] for r in rows if r["schema"] is not None))))


class AppendLog:
    """Sink for update-mode aggregates: append each micro-batch with its batch id; readers
    keep the row of the latest batch per key (:func:`latest_per_key`). A long-running
    log is compacted by writing ``latest_per_key`` of it as a new table (same result)."""

    def __init__(self, path: str):
        self.path = path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id).cast("long")).write.mode("append").parquet(self.path)


def latest_per_key(log: DataFrame, keys: list[str]) -> DataFrame:
    """Read side of :class:`AppendLog`: newest version of each key (a map-side combined max_by)."""
    others = [c for c in log.columns if c not in keys and c != "_batch"]
    g = log.groupBy(*keys).agg(F.max_by(F.struct(*others), "_batch").alias("_r"))
    return g.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def run_available_now(df: DataFrame, sink, checkpoint: str, output_mode: str = "append"):
    """Run a streaming query over everything available, then stop (X1 trigger)."""
    q = (df.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
         .outputMode(output_mode).foreachBatch(sink).start())
    q.awaitTermination()
    return q


def run_to_parquet(df: DataFrame, path: str, checkpoint: str, output_mode: str = "append"):
    q = (df.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
         .outputMode(output_mode).format("parquet").option("path", path).start())
    q.awaitTermination()
    return q


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    """The curated table written by :class:`CuratedMerge`, as of its newest commit."""
    last = last_commit(spark, path)
    if last is None:
        raise FileNotFoundError(f"no commit in {path}")
    return last.read(spark)

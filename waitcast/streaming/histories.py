"""A1-A9 kept up to date: histories that follow a stream of readings without counting old ones again.

Histories are functions of counts ``(ride, month, hour, weekday, wait) -> n``, and counts of batches add up. The state is those
counts in parts by a hash of the ride, and one part ``all`` with ``wait -> n`` of all rides for the global grain. A micro-batch is
counted first (map-side combined), the parts that its rides lie in are read, merged and written as new versions, and the histories
of these parts alone are derived anew. Counts and histories each have a commit file per batch
(:class:`waitcast.streaming.ingest.Commit`); a history part is current when it has its count part's version, so a failure between the
two commits is made up for by the next call, and readers see whole states only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waitcast.operators import history as H
from waitcast.streaming.ingest import Commit, last_commit, write_commit

ALL = "all"


class HistoryState:
    """``foreachBatch`` sink of readings with the columns of ``history.KEYS`` and ``value``.

    Rows without a value are not counted; a NULL key is a key. ``sign`` names a column of 1 and -1: a row of -1 takes back a
    reading counted before (the loser of a keep-last merge). A batch id that is committed is a no-op, an empty batch commits the old
    parts. ``buckets`` is fixed by the first batch; another number is refused.
    """

    def __init__(self, path: str, value: str = H.WAIT, buckets: int = 64, transform=None, sign: str | None = None):
        self.path, self.value, self.buckets, self.transform, self.sign = path, value, buckets, transform, sign

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = last_commit(spark, f"{self.path}/counts")
        if last is None or batch_id > last.batch_id:
            last = self._add(self.transform(batch) if self.transform else batch, batch_id, last)
        self._derive(spark, last)

    def _part(self) -> Column:
        return F.concat(F.lit(f"{self.buckets}-"), F.pmod(F.xxhash64(H.KEYS[0]), F.lit(self.buckets)).cast("string"))

    def _add(self, batch: DataFrame, batch_id: int, last: Commit | None) -> Commit:
        spark, cells = batch.sparkSession, [*H.KEYS, self.value]
        held = last.held if last else {}
        if any(p != ALL and p.split("-")[0] != str(self.buckets) for p in held):
            raise ValueError(f"{self.path} has another number of buckets than {self.buckets}")
        one = F.col(self.sign).cast("long") if self.sign else F.lit(1).cast("long")
        new = batch.where(F.col(self.value).isNotNull()).groupBy(*cells).agg(F.sum(one).alias("_n"))
        new = new.withColumn("_part", self._part()).checkpoint(eager=True)
        whole = new.groupBy(self.value).agg(F.sum("_n").alias("_n"))
        whole = whole.select(*[F.lit(None).cast(new.schema[k].dataType).alias(k) for k in H.KEYS], self.value, "_n", F.lit(ALL).alias("_part"))
        both = new.unionByName(whole)
        # names of parts, at most buckets + 1
        touched = {r[0] for r in both.select("_part").distinct().collect()}
        if touched & set(held):
            old = last.read(spark, touched & set(held))
            part = F.when(F.col("_whole"), F.lit(ALL)).otherwise(self._part())
            both = both.unionByName(old.withColumn("_part", part).drop("_whole"))
        both = both.groupBy("_part", *cells).agg(F.sum("_n").alias("_n")).withColumn("_whole", F.col("_part") == ALL)
        # cells taken back altogether stay as 0, so that a part that was touched has a version
        if touched:
            both.write.mode("overwrite").partitionBy("_part").parquet(f"{self.path}/counts/parts/_held={batch_id}")
        commit = Commit(f"{self.path}/counts", batch_id, {**held, **dict.fromkeys(touched, batch_id)}, both.drop("_part").schema)
        write_commit(spark, commit)
        return commit

    def _derive(self, spark: SparkSession, counts: Commit) -> None:
        last = last_commit(spark, f"{self.path}/histories")
        if last is not None and last.batch_id == counts.batch_id:
            return
        held = last.held if last else {}
        stale = {p for p, version in counts.held.items() if held.get(p) != version}
        pre = counts.read(spark, stale).where("_n > 0")
        rides = H.histories_from_counts(pre.where("NOT _whole").drop("_whole"), [g for g in H.CASCADE_GRAINS if g != "global"], self.value)
        part = self._part()
        out = rides.withColumn("_part", part)
        if ALL in stale:
            none = [F.lit(None).cast(pre.schema[k].dataType).alias(k) for k in H.KEYS]
            whole = H.stats_of_all(pre.where("_whole").select(self.value, "_n"), H.LONG_STATS, self.value)
            whole = whole.select(F.lit("global").alias("grain"), *none, *H.LONG_STATS).withColumnsRenamed({"count": "n", "median": "p50"})
            out = out.unionByName(whole.withColumn("_part", F.lit(ALL)))
        if stale:
            written = f"{self.path}/histories/parts/_held={counts.batch_id}"
            out.write.mode("overwrite").partitionBy("_part").parquet(written)
            # a part all of whose readings were taken back has no histories; it is derived again, to nothing, until it has some
            left = {r[0] for r in spark.read.schema(out.schema).parquet(written).select("_part").distinct().collect()}
            held = {p: v for p, v in held.items() if p not in stale} | dict.fromkeys(left, counts.batch_id)
        write_commit(spark, Commit(f"{self.path}/histories", counts.batch_id, held, out.drop("_part").schema))


def read_histories(spark: SparkSession, path: str) -> DataFrame:
    """The histories (columns of ``history.all_histories``) as of the newest commit of a :class:`HistoryState`."""
    last = last_commit(spark, f"{path}/histories")
    if last is None:
        raise FileNotFoundError(f"no commit in {path}/histories")
    return last.read(spark)

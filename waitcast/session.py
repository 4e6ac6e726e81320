"""Spark session helpers.

The library never creates machine-local scratch space on a cluster: the
checkpoint directory is read from ``spark.checkpoint.dir``; only when it is
unset (local tests) do we point it at a fresh temp folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Rows that are worth a partition of their own in :func:`spread`.
ROWS_EACH = 8192

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpointed intermediates (histories, encodings, merges) are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "waitcast") -> SparkSession:
    """Session for tests and the bench (local mode); clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("WAITCAST_DRIVER_MEM", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder named in ``spark.checkpoint.dir``; invent one only when unset (tests).

    A machine-local folder would be lost with its executor, so off a local master an unset folder
    is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="waitcast-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def spread(df: DataFrame, rows_each: int = ROWS_EACH) -> DataFrame:
    """``df`` written once (reliable checkpoint) over at least as many partitions as the cluster has cores, for work that goes over it
    many times: a small file is one row group, so one task, however many rows it has. Fewer than ``rows_each`` rows for a core
    take fewer partitions. Rows and columns stay."""
    ensure_checkpoint_dir(df.sparkSession)
    held, cores = df.checkpoint(eager=True), df.sparkSession.sparkContext.defaultParallelism
    if held.rdd.getNumPartitions() >= cores:  # no pass to count the rows
        return held
    wanted = min(cores, -(-held.count() // rows_each))
    if held.rdd.getNumPartitions() >= wanted:
        return held
    return held.repartition(wanted).checkpoint(eager=True)

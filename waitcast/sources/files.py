"""File scans and sinks.

Readers always pass an explicit schema (or read every field as text and
``try_cast``), so no inference pass runs and malformed values become NULL.
Paths are plain parameters: local, HDFS or object-store URIs (S13) work alike.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitcast.operators.clean import project_fixed
from waitcast.operators.dedup import union_aligned
from waitcast.schema import READINGS_COLUMNS
from waitcast.session import ensure_checkpoint_dir


def read_csv(spark: SparkSession, path, schema: T.StructType, header: bool = True) -> DataFrame:
    """CSV scan with header and an explicit schema; ``path`` may be a glob or a list.

    Raises ``FileNotFoundError`` when nothing matches (S2's "fail if none").
    """
    try:
        return (spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
                .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise FileNotFoundError(str(path)) from e
        raise


def typed_readings(raw: DataFrame) -> DataFrame:
    """Text columns -> the readings types with ``try_cast`` (bad values -> NULL)."""
    types = dict(READINGS_COLUMNS)
    out = []
    for c in raw.columns:
        t = types.get(c)
        if t is None or isinstance(t, T.StringType):
            out.append(F.col(c))
        else:
            out.append(F.col(c).try_cast(t).alias(c))
    return raw.select(*out)


def _readable(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path).schema  # noqa: B018 - resolves (lists) the path only
        return True
    except AnalysisException:
        return False


def file_headers(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """Header line -> files: the first line of each file is the first row of its split starting at byte 0. One
    distributed job finds the numbers of these rows, a second one their lines; a hash aggregate of numbers holds one row a file,
    where one of lines would sort all lines. Only (file, header) pairs reach the driver (file-listing metadata, as
    Spark's own file index)."""
    # both jobs scan the same files in the same splits, so rows have the same numbers
    lines = spark.read.text(paths).select(F.input_file_name().alias("f"), F.input_file_block_start().alias("b"),
                                          F.monotonically_increasing_id().alias("i"), F.col("value"))
    heads = lines.where(F.col("b") == 0)
    first = first_rows(heads).checkpoint(eager=True)
    heads = heads.join(F.broadcast(first.select("i")), "i").select("f", "value").collect()
    out: dict[str, list[str]] = {}
    for r in heads:
        out.setdefault(r["value"], []).append(r["f"])
    return out


def first_rows(lines: DataFrame) -> DataFrame:
    """The least row number ``i`` of each file ``f``."""
    return lines.groupBy("f").agg(F.min("i").alias("i"))


def tolerant_scan(spark: SparkSession, paths: list[str], required: tuple[str, ...] = ("zona", "atraccion"),
                  columns=READINGS_COLUMNS) -> DataFrame:
    """S3: many CSV files whose column sets and orders differ.

    Unreadable paths are skipped; files are grouped by header layout (one job reads
    every file's first line); layouts lacking a ``required`` column are skipped; each
    remaining layout is one multi-file scan read as text (no inference). Layouts are
    unioned by name (missing columns -> NULL), typed with ``try_cast`` and projected
    to the fixed column order.
    """
    import csv
    ok = [p for p in paths if _readable(spark, p)]
    if not ok:
        raise FileNotFoundError("no readable files")
    parts = []
    for header, files in sorted(file_headers(spark, ok).items()):
        names = next(csv.reader([header]))
        if not all(r in names for r in required):
            continue
        parts.append(spark.read.option("header", True).option("mode", "PERMISSIVE").csv(sorted(files)))
    if not parts:
        raise FileNotFoundError("no file with the required columns")
    u = union_aligned(*parts)
    have = [c for c, _ in columns if c in u.columns]
    typed = typed_readings(u.select(*have))
    return project_fixed(typed, columns)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink with header."""
    df.write.mode(mode).option("header", True).csv(path)


def csv_to_parquet(spark: SparkSession, src, dst: str, schema: T.StructType, partition_by=("anio", "mes")) -> None:
    """CSV -> Parquet partitioned by year and month (partition pruning for date filters)."""
    df = read_csv(spark, src, schema)
    df = df.withColumns({"anio": F.year("fecha"), "mes_p": F.month("fecha")}) if "fecha" in df.columns else df
    cols = [c if c != "mes" else "mes_p" for c in partition_by]
    df.write.mode("overwrite").partitionBy(*cols).parquet(dst)


def save_artifacts(tables: dict[str, DataFrame], root: str) -> None:
    """One parquet folder per artifact (histories, encodings, column list, processed table)."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")


def load_artifact(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """Read an artifact; a missing one becomes an empty frame with its schema."""
    try:
        return spark.read.schema(schema).parquet(f"{root}/{name}")
    except AnalysisException:
        return spark.createDataFrame([], schema)


def save_pipeline(model: PipelineModel, path: str) -> None:
    """Persist the fitted pipeline (MLlib writer)."""
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def write_json(df: DataFrame, path: str) -> None:
    """Metrics record(s) as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)


def staging_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory (never machine-local)."""
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/waitcast-stage/{name}-{uuid.uuid4().hex[:12]}"

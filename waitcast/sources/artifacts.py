"""Versioned training artifacts.

A store is a folder:

    v=<n>/<name>/         tables as Parquet, pipelines in the MLlib format
    manifests/v=<n>.json  the version's entries, one JSON row each, written last

A version exists from the moment its manifest does; a manifest is one file that Spark's committer renames into place, and
holds the number of its entries, so a version that was cut short is never seen. Versions are never changed. Readers take the
newest one, or the one they name, from the manifest alone: names, schemas and paths.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "version long, entries int, name string, kind string, schema string"


@dataclass(frozen=True)
class Version:
    """The entries of one published version: name -> (kind, schema as JSON)."""

    spark: SparkSession
    root: str
    number: int
    entries: dict[str, tuple[str, str | None]]

    def path(self, name: str) -> str:
        return f"{self.root}/v={self.number}/{name}"

    def table(self, name: str, missing: T.StructType | str | None = None) -> DataFrame:
        """A table with the schema it was saved with. One that the version lacks is an empty frame of the schema ``missing``,
        or a KeyError without it (S12)."""
        if name not in self.entries:
            if missing is None:
                raise KeyError(f"{name} is not in version {self.number} of {self.root}")
            return self.spark.createDataFrame([], missing)
        schema = T.StructType.fromJson(json.loads(self.entries[name][1]))
        return self.spark.read.schema(schema).parquet(self.path(name))

    def pipeline(self, name: str) -> PipelineModel:
        if self.entries.get(name, ("",))[0] != "pipeline":
            raise KeyError(f"{name} is no pipeline of version {self.number} of {self.root}")
        return PipelineModel.load(self.path(name))


def _manifests(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(MANIFEST).option("recursiveFileLookup", True).json(f"{root}/manifests")
    except AnalysisException:
        return None


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions, oldest first."""
    rows = _manifests(spark, root)
    if rows is None:
        return []
    whole = rows.groupBy("version").agg(F.count("*").alias("n"), F.max("entries").alias("entries")).where("n = entries")
    return sorted(r["version"] for r in whole.collect())


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame], pipelines: dict[str, PipelineModel] | None = None) -> int:
    """Write tables and pipelines as the next version and return its number. One writer at a time."""
    pipelines = pipelines or {}
    if not tables and not pipelines:
        raise ValueError("nothing to publish")
    number = max(versions(spark, root), default=0) + 1
    rows = []
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/v={number}/{name}")  # over what a failed attempt left
        rows.append((number, len(tables) + len(pipelines), name, "table", df.schema.json()))
    for name, model in pipelines.items():
        model.write().overwrite().save(f"{root}/v={number}/{name}")
        rows.append((number, len(tables) + len(pipelines), name, "pipeline", None))
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").json(f"{root}/manifests/v={number}.json")
    return number


def open_version(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The newest published version, or the one asked for; reads its manifest once."""
    known = versions(spark, root)
    if not known or (number is not None and number not in known):
        raise FileNotFoundError(f"no published version{'' if number is None else f' {number}'} in {root}")
    number = known[-1] if number is None else number
    rows = _manifests(spark, root).where(F.col("version") == number).collect()  # one row per artifact
    return Version(spark, root, number, {r["name"]: (r["kind"], r["schema"]) for r in rows})

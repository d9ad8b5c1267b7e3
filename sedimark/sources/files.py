"""File sources: job documents, manifests, landed raw payloads, and the schema registry."""

from __future__ import annotations

import hashlib
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

JOB = """
  id string, role string, company string, published_at string, source struct<url: string, retrieved_at: string>,
  problem_statement string, responsibilities array<string>, processes array<string>, keywords array<string>,
  technologies array<struct<name: string, category: string, importance: string>>, teams array<string>,
  quality_attributes array<string>, fit array<struct<area: string, current_fit: string, evidence_level: string, learning_value: string, portfolio_candidate: boolean>>,
  graph_edges array<struct<`from`: string, relation: string, `to`: string>>
"""


def job_documents(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document a file, in the order of their paths (column ``ordinal``)."""
    read = spark.read.schema(JOB).option("multiLine", True).json(path)
    return read.withColumn("ordinal", F.col("_metadata.file_path"))


def manifest(spark: SparkSession, path: str | None) -> DataFrame:
    """(source, source_posting_id, url, groupId, search) pinned by an earlier run; no path means none pinned. search: JSON text."""
    row = "source string, source_posting_id string, url string, groupId string, search string"
    if path is None:
        return spark.createDataFrame([], row)
    read = spark.read.schema(f"sources map<string, array<struct<{row.replace(' string', ': string')}>>>").option("multiLine", True).json(path)
    return read.select(F.explode("sources").alias("code", "rows")).select(F.explode("rows").alias("r")).select("r.*")


def migrations(path: str) -> list[tuple[str, str]]:
    """(version, checksum) of the .sql files of a folder, by name."""
    return [(p.name, hashlib.sha256(p.read_bytes()).hexdigest()) for p in sorted(Path(path).glob("*.sql"))]


def pending_migrations(found: list[tuple[str, str]], applied: dict[str, str]) -> list[str]:
    """Versions yet to apply; a changed checksum of an applied one is an error."""
    for version, checksum in found:
        if version in applied and applied[version] != checksum:
            raise ValueError(f"migration {version} has changed since it was applied")
    return [v for v, _ in found if v not in applied]

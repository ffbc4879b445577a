"""Tables as numbered snapshots: write beside the old files, then commit."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.layout import write_day_partitioned

MANIFEST_SCHEMA = (
    T.StructType()
    .add("table_name", T.StringType())
    .add("path", T.StringType())
    .add("ts", T.StringType())
    .add("columns", T.StringType())
)


@dataclass(frozen=True)
class Table:
    """Rows of a table and how they are laid out.

    ``ts`` names the timestamp of a table with one partition per day. ``path``
    is set while the rows are exactly those written there.
    """

    rows: DataFrame
    ts: str | None = None
    path: str | None = None


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A parquet table, or no rows if nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_snapshot(spark: SparkSession, root: str, number: int, tables: dict[str, Table]) -> int:
    """Write the tables that have no files yet and the manifest of a snapshot.

    Unchanged and renamed tables are listed with their old files. Returns how
    many tables were written. Nothing refers to the snapshot until the caller
    commits its number, so a repeat may overwrite the manifest.
    """
    listed, written = [], 0
    for name, table in tables.items():
        path = table.path
        if path is None:
            path = f"{root}/data/{number}/{name}-{uuid.uuid4().hex}"
            if table.ts is None:
                table.rows.write.parquet(path)
            else:
                write_day_partitioned(table.rows, path, table.ts)
            written += 1
        listed.append((name, path, table.ts, table.rows.schema.json()))
    manifest = spark.createDataFrame(listed, MANIFEST_SCHEMA).coalesce(1)
    manifest.write.mode("overwrite").parquet(f"{root}/manifests/{number}")
    return written


def read_snapshot(spark: SparkSession, root: str, number: int) -> dict[str, Table]:
    """Tables of a committed snapshot; the manifest is one row per table."""
    manifest = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root}/manifests/{number}")
    tables = {}
    for name, path, ts, columns in manifest.collect():
        schema = T.StructType.fromJson(json.loads(columns))
        rows = spark.read.schema(schema).parquet(path)
        tables[name] = Table(rows.select(*schema.fieldNames()), ts, path)
    return tables

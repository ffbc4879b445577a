"""Migrations kept as SQL files and run against a schema of the Spark catalog."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.history import BOUND_COLUMNS, HISTORY_SCHEMA, conform
from tidemark.operators.layers import clean_plan
from tidemark.operators.statements import split_statements
from tidemark.plans.migrate import ChangedStep, baseline_row, pending
from tidemark.session import save
from tidemark.sources import catalog
from tidemark.sources.scripts import (
    changed_scripts,
    file_name,
    read_scripts,
    resolve,
    script_checksum,
    substitute,
)

HISTORY_TABLE = "schema_history"


def _history(spark: SparkSession, schema: str) -> str:
    """Name of the history table of a schema, created if it is not there."""
    name = f"{schema}.{HISTORY_TABLE}"
    columns = [
        f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        + (" DEFAULT current_timestamp()" if f.name == "installed_on" else "")
        for f in HISTORY_SCHEMA
    ]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {catalog.quoted(schema)}")
    catalog.create_table(spark, name, ", ".join(columns))
    return name


def read_schema_history(spark: SparkSession, schema: str) -> DataFrame:
    return spark.table(_history(spark, schema))


def baseline_schema(spark: SparkSession, schema: str, version: str) -> None:
    """Start an empty history at a version; no other table is created."""
    name = _history(spark, schema)
    if not spark.table(name).isEmpty():
        raise ValueError("the history is not empty")
    catalog.insert_into(spark, name, baseline_row(spark, version).select(*BOUND_COLUMNS))


def migrate_files(
    spark: SparkSession,
    folder: str,
    schema: str = "default",
    values: dict[str, str] | None = None,
    target: str | None = None,
    dialect: str = "plain",
) -> list[str]:
    """Run the pending ``V<version>__<description>.sql`` files of a folder.

    Returns the versions that ran. Files run in version order and statements in
    file order, each as one Spark SQL statement. The catalog has no transaction
    over several statements: a failing file leaves a failed history row and
    stops the run.
    """
    name = _history(spark, schema)
    history = spark.table(name)
    files = read_scripts(spark, folder).withColumn("script", file_name("path"))
    files = resolve(files, "script").filter("version IS NOT NULL")
    changed = [r["version"] for r in changed_scripts(files, history).collect()]
    if changed:
        raise ChangedStep(f"changed after they were applied: {', '.join(changed)}")

    todo = pending(files, history, target).drop("path")
    # Statements run from here one by one, so their texts come here. Files are
    # written by hand; the tables they change stay on the executors.
    applied = todo.withColumn("checksum", script_checksum("text")).drop("text").collect()
    filled = todo.select("script", substitute("text", {"schema": schema, **(values or {})}).alias("text"))
    statements: dict[str, list[str]] = {}
    for row in split_statements(filled, dialect, "script").orderBy("script", "stmt_no").collect():
        statements.setdefault(row["script"], []).append(row["sql"])
    rank = history.agg(F.max("installed_rank")).first()[0] or 0

    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(schema)
    try:
        for rank, file in enumerate(applied, rank + 1):
            started = time.monotonic()
            failure = None
            try:
                for sql in statements.get(file["script"], []):
                    spark.sql(sql)
            except Exception as e:
                failure = e
            row = spark.range(1).select(
                F.lit(rank).alias("installed_rank"),
                F.lit(file["version"]).alias("version"),
                F.lit(file["description"]).alias("description"),
                F.lit("SQL").alias("type"),
                F.lit(file["script"]).alias("script"),
                F.lit(file["checksum"]).alias("checksum"),
                F.current_user().alias("installed_by"),
                F.lit(int((time.monotonic() - started) * 1000)).alias("execution_time"),
                F.lit(failure is None).alias("success"),
            )
            catalog.insert_into(spark, name, row)
            if failure is not None:
                raise failure
    finally:
        spark.catalog.setCurrentDatabase(before)
    return [file["version"] for file in applied]


def repair_schema(spark: SparkSession, schema: str) -> None:
    """Drop the failed rows of a history, so that their files run again.

    The rows left are rewritten: a parquet table has no DELETE.
    """
    name = _history(spark, schema)
    kept = save(conform(spark.table(name)).filter("success"), "history")
    kept.write.insertInto(name, overwrite=True)


def schema_objects(spark: SparkSession, schema: str) -> DataFrame:
    """Tables, views and functions of a schema as a listing."""
    quoted = catalog.quoted(schema)
    views = [r["viewName"] for r in spark.sql(f"SHOW VIEWS IN {quoted}").collect() if not r["isTemporary"]]
    tables = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {quoted}").collect() if not r["isTemporary"]]
    functions = [r[0].split(".")[-1] for r in spark.sql(f"SHOW USER FUNCTIONS IN {quoted}").collect()]
    rows = [(schema, v, "VIEW", False) for v in views]
    rows += [(schema, t, "TABLE", False) for t in tables if t not in views]
    rows += [(schema, f, "FUNCTION", False) for f in functions]
    return spark.createDataFrame(rows, "schema string, name string, kind string, internal boolean")


def clean_schema(spark: SparkSession, schema: str) -> list[str]:
    """Drop everything in a schema of the catalog; returns what was run."""
    none = spark.createDataFrame([], "src string, dst string")
    plan = clean_plan(schema_objects(spark, schema), none, "spark")
    statements = [r["statement"] for r in plan.collect()]
    for sql in statements:
        spark.sql(sql)
    return statements

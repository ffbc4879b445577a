"""Applying versioned steps once each, and asking which are still to come."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import version_key, version_text
from tidemark.operators.history import (
    BASELINE_MARKER,
    HISTORY_SCHEMA,
    append_history,
)
from tidemark.plans.snapshots import Table, read_or_empty, read_snapshot, write_snapshot
from tidemark.plans.steps import Step


class ChangedStep(ValueError):
    """A step that was applied has other changes now."""


@dataclass(frozen=True)
class MigrateResult:
    """Tables after the run, versions applied by it, tables written by it."""

    tables: dict[str, DataFrame]
    applied: list[str]
    rewrites: int


def pending(available: DataFrame, history: DataFrame, target: str | None = None) -> DataFrame:
    """Available versions that were not applied, in version order.

    Versions compare as numbers. A failed row does not count as applied.
    Versions up to that of a baseline row do, and versions after ``target`` are
    left out.
    """
    key = version_text("version")
    done = history.filter("success AND version IS NOT NULL")
    applied = done.select(key.alias("_key")).filter("_key IS NOT NULL").distinct()
    waiting = available.withColumn("_key", key).filter("_key IS NOT NULL")
    waiting = waiting.join(applied, "_key", "left_anti").drop("_key")
    baselines = done.filter(F.col("type") == BASELINE_MARKER)
    floor = baselines.agg(F.max(version_key("version")).alias("floor")).scalar()
    waiting = waiting.filter(F.coalesce(version_key("version") > floor, F.lit(True)))
    if target is not None:
        waiting = waiting.filter(version_key("version") <= version_key(F.lit(target)))
    return waiting.orderBy(version_key("version"))


def baseline_row(spark: SparkSession, version: str, description: str = "<< Baseline >>") -> DataFrame:
    """The one marker row of a baseline, without the time of the insert."""
    return spark.range(1).select(
        F.lit(1).alias("installed_rank"),
        F.lit(version).alias("version"),
        F.lit(description).alias("description"),
        F.lit(BASELINE_MARKER).alias("type"),
        F.lit(description).alias("script"),
        F.lit(None).cast("int").alias("checksum"),
        F.current_user().alias("installed_by"),
        F.lit(0).alias("execution_time"),
        F.lit(True).alias("success"),
    )


def history_path(root: str) -> str:
    return f"{root}/history"


def read_history(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, history_path(root), HISTORY_SCHEMA)


def baseline(spark: SparkSession, root: str, version: str, description: str = "<< Baseline >>") -> None:
    """Start an empty history at a version; no table is created."""
    if not read_history(spark, root).isEmpty():
        raise ValueError("the history is not empty")
    write_snapshot(spark, root, 1, {})
    append_history(baseline_row(spark, version, description), history_path(root))


def current_tables(spark: SparkSession, root: str) -> dict[str, Table]:
    """Tables of the last committed snapshot."""
    rank = read_history(spark, root).filter("success").agg(F.max("installed_rank")).first()[0]
    return {} if rank is None else read_snapshot(spark, root, rank)


def _check_unchanged(steps: list[Step], history: DataFrame) -> None:
    spark = history.sparkSession
    now = spark.createDataFrame([(s.version, s.checksum) for s in steps], "version string, now int")
    recorded = history.filter("success AND checksum IS NOT NULL").select(
        version_text("version").alias("_key"), "checksum"
    )
    changed = (
        now.withColumn("_key", version_text("version"))
        .join(recorded, "_key")
        .filter("now <> checksum")
        .select("version")
    )
    names = [r[0] for r in changed.collect()]
    if names:
        raise ChangedStep(f"changed after they were applied: {', '.join(names)}")


def migrate(
    spark: SparkSession, root: str, steps: list[Step], target: str | None = None
) -> MigrateResult:
    """Apply the pending steps up to and with ``target``, in version order.

    The steps only compose plans. Each table that differs at the end is written
    once, however many steps touched it, into a new snapshot; appending the
    history rows commits it. If anything fails before, readers still see the
    old snapshot. A run without pending steps writes nothing. One writer at a
    time is assumed.
    """
    history = read_history(spark, root)
    by_version = {s.version: s for s in steps}
    if len(by_version) != len(steps):
        raise ValueError("two steps have the same version")
    last, committed = history.agg(
        F.max("installed_rank"), F.max(F.when(F.col("success"), F.col("installed_rank")))
    ).first()
    if last is not None:
        _check_unchanged(steps, history)
    available = spark.createDataFrame([(s.version,) for s in steps], "version string")
    # The list of steps came from the caller; it returns in order.
    todo = [by_version[r["version"]] for r in pending(available, history, target).collect()]

    tables = {} if committed is None else read_snapshot(spark, root, committed)
    rows = []
    for rank, one in enumerate(todo, (last or 0) + 1):
        started = time.monotonic()
        for change in one.changes:
            tables = change.apply(spark, tables)
        spent = int((time.monotonic() - started) * 1000)
        rows.append([rank, one.version, one.description, "SQL", one.script, one.checksum, spent])
    if not rows:
        return MigrateResult({n: t.rows for n, t in tables.items()}, [], 0)

    started = time.monotonic()
    number = rows[-1][0]
    rewrites = write_snapshot(spark, root, number, tables)
    rows[-1][-1] += int((time.monotonic() - started) * 1000)
    recorded = spark.createDataFrame(
        [tuple(r) for r in rows],
        "installed_rank int, version string, description string, type string, script string, "
        "checksum int, execution_time int",
    ).coalesce(1)
    recorded = recorded.withColumns({"installed_by": F.current_user(), "success": F.lit(True)})
    append_history(recorded, history_path(root))
    written = read_snapshot(spark, root, number)
    return MigrateResult({n: t.rows for n, t in written.items()}, [s.version for s in todo], rewrites)

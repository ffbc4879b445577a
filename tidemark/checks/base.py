"""What the checks share: loading tables, and a history derived from events."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.history import HISTORY_COLUMNS


class Given:
    """The given tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Check:
    run: Callable[[Given], DataFrame]
    sql: str | None


class Checks(dict):
    """Checks of a module by name."""

    def add(self, sql: str | None = None) -> Callable:
        def register(run: Callable[[Given], DataFrame]) -> Callable:
            self[run.__name__] = Check(run, sql)
            return run

        return register


def hist(g: Given) -> DataFrame:
    """One history row per event."""
    return g.events.select(
        F.expr("CAST(event_id + 1 AS INT)").alias("installed_rank"),
        F.expr(
            "CASE WHEN event_id % 10 <> 0 THEN concat(month(ts), '.', day(ts)) END"
        ).alias("version"),
        F.col("event_type").alias("description"),
        F.expr("CASE WHEN event_id % 97 = 0 THEN 'TABLE' ELSE 'SQL' END").alias("type"),
        F.expr("concat('V', event_id, '__', event_type, '.sql')").alias("script"),
        F.expr("CASE WHEN event_id % 7 <> 0 THEN CAST(event_id % 65521 AS INT) END").alias("checksum"),
        F.expr("concat('u', user_id)").alias("installed_by"),
        F.col("ts").alias("installed_on"),
        F.expr("CAST(event_id % 1000 AS INT)").alias("execution_time"),
        F.expr("event_type <> 'error'").alias("success"),
    )


HIST = """hist AS (
  SELECT CAST(event_id + 1 AS INTEGER) AS installed_rank,
    CASE WHEN event_id % 10 <> 0 THEN concat(month(ts), '.', day(ts)) END AS version,
    event_type AS description,
    CASE WHEN event_id % 97 = 0 THEN 'TABLE' ELSE 'SQL' END AS type,
    concat('V', event_id, '__', event_type, '.sql') AS script,
    CASE WHEN event_id % 7 <> 0 THEN CAST(event_id % 65521 AS INTEGER) END AS checksum,
    concat('u', user_id) AS installed_by,
    ts AS installed_on,
    CAST(event_id % 1000 AS INTEGER) AS execution_time,
    event_type <> 'error' AS success
  FROM events)"""
HIST_COLUMNS = ", ".join(HISTORY_COLUMNS)


def plain_time(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps without a zone, as the given tables have them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})

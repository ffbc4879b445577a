"""The history table: one row per applied change.

UPDATE and DELETE are whole-table rewrites here: each edit returns the new
table, and the caller writes it as the next snapshot.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.macros import holds
from tidemark.functions.scalars import to_bool

HISTORY_SCHEMA = T.StructType(
    [
        T.StructField("installed_rank", T.IntegerType(), False),
        T.StructField("version", T.StringType(), True),
        T.StructField("description", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
        T.StructField("script", T.StringType(), False),
        T.StructField("checksum", T.IntegerType(), True),
        T.StructField("installed_by", T.StringType(), False),
        T.StructField("installed_on", T.TimestampType(), False),
        T.StructField("execution_time", T.IntegerType(), False),
        T.StructField("success", T.BooleanType(), False),
    ]
)
HISTORY_COLUMNS = HISTORY_SCHEMA.fieldNames()
BOUND_COLUMNS = [c for c in HISTORY_COLUMNS if c != "installed_on"]

# Types that mark a history row as something other than a script.
TABLE_MARKER = "TABLE"
BASELINE_MARKER = "BASELINE"


def conform(df: DataFrame, *more: Column) -> DataFrame:
    """Any physical layout of a history as the ten declared columns, and ``more``.

    Columns match by name, missing nullable ones become null, and a boolean
    may be stored as a bit, a number or text.
    """
    present = set(df.columns)

    def column(field: T.StructField) -> Column:
        if field.name not in present:
            if not field.nullable:
                raise ValueError(f"history has no column {field.name}")
            return F.lit(None).cast(field.dataType).alias(field.name)
        source = F.col(field.name)
        value = to_bool(source) if field.name == "success" else source.cast(field.dataType)
        return value.alias(field.name)

    return df.select(*[column(f) for f in HISTORY_SCHEMA], *more)


def unify_histories(histories: dict[str, DataFrame]) -> DataFrame:
    """One table from the histories of many servers, with the server's name."""
    parts = [conform(df).withColumn("server", F.lit(name)) for name, df in histories.items()]
    return reduce(DataFrame.unionByName, parts)


def unify_history_files(spark: SparkSession, paths: dict[str, str], schemas: dict[str, T.StructType] | None = None) -> DataFrame:
    """``unify_histories`` for histories in Parquet folders, with one scan for each layout.

    Servers whose files have the same columns and types are read together, and the
    folder of a file tells its server. The plan so grows with the layouts and not
    with the servers. ``schemas`` saves reading one file footer for each server.
    """
    layouts: dict[str, list[str]] = {}
    known = schemas or {}
    for server, path in paths.items():
        schema = known.get(server) or spark.read.parquet(path).schema
        layouts.setdefault(schema.json(), []).append(server)
    names = spark.createDataFrame([(server, path.split(":", 1)[-1].rstrip("/").lstrip("/")) for server, path in paths.items()], "server string, folder string")
    parts = []
    for schema, servers in layouts.items():
        # The name of the folder, without the scheme and slashes that differ between file systems.
        folder = F.regexp_replace(F.regexp_replace(F.url_decode(F.regexp_replace("_metadata.file_path", "[+]", "%2B")), "^[a-z0-9]+:/*", ""), "/[^/]*$", "")
        rows = spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*(paths[s] for s in servers))
        parts.append(conform(rows, folder.alias("folder")))
    whole = reduce(DataFrame.unionByName, parts)
    return whole.join(F.broadcast(names), "folder").drop("folder")


def append_history(df: DataFrame, path: str) -> None:
    """Append rows by explicit column list; the time of the insert is now."""
    rows = df.select(*BOUND_COLUMNS).withColumn("installed_on", F.current_timestamp())
    conform(rows).write.mode("append").parquet(path)


def ordered_history(history: DataFrame) -> DataFrame:
    """Total order by rank, by range partitions."""
    return history.orderBy("installed_rank")


def history_after(history: DataFrame, rank: int, skip_markers: bool = True) -> DataFrame:
    """Rows after a rank, in order, without the rows that mark table creation."""
    later = history.filter(F.col("installed_rank") > rank)
    if skip_markers:
        later = later.filter(F.col("type") != TABLE_MARKER)
    return ordered_history(later.select(*HISTORY_COLUMNS))


def expire_rows(df: DataFrame, match: Column, ts: str, cutoff: Column) -> DataFrame:
    """Drop matching rows that are strictly older than the cutoff.

    Rows for which the condition is unknown stay.
    """
    return df.filter(~holds(match & (F.col(ts) < cutoff)))


def refresh_rows(df: DataFrame, match: Column, ts: str, value: Column) -> DataFrame:
    """Set the timestamp of matching rows."""
    return df.withColumn(ts, F.when(holds(match), value).otherwise(F.col(ts)))


def delete_failed(
    history: DataFrame, version: str | None = None, description: str | None = None
) -> DataFrame:
    """Drop failed rows of one version, or else of one description."""
    if version is None and description is None:
        raise ValueError("give a version or a description")
    same = F.col("version") == version if version is not None else F.col("description") == description
    return history.filter(~holds(~F.col("success") & same))


def update_by_rank(history: DataFrame, updates: DataFrame) -> DataFrame:
    """Set description, type and checksum for given ranks.

    A given null overwrites, so a match flag decides and not ``coalesce``.
    ``updates`` holds each rank at most once.
    """
    changed = ["description", "type", "checksum"]
    new = updates.select(
        "installed_rank", *[F.col(c).alias(f"_new_{c}") for c in changed], F.lit(True).alias("_hit")
    )
    joined = history.join(new, "installed_rank", "left")

    def value(c: str) -> Column:
        if c not in changed:
            return F.col(c)
        return F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)

    return joined.select(*[value(c) for c in history.columns])

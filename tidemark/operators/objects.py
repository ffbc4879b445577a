"""Catalog listings as rows: which objects exist, and whose they are."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of system tables, compared without case, the prefix and
# the exact name that also mark one.
SYSTEM_NAMES = ["telemetry_config", "telemetry", "_query_trace"]
SYSTEM_PREFIX = "sys."
SYSTEM_EXACT = "__T0"

# Kinds of table-like objects, origins of user functions.
TABLE_KINDS = {"T": "TABLE", "V": "VIEW", "A": "ALIAS", "M": "MATERIALIZED TABLE", "G": "TEMPORARY TABLE"}
FUNCTION_ORIGINS = ["E", "M", "Q", "U"]


def is_system(name: Column | str) -> Column:
    """The name is one of the fixed system names."""
    name = F.col(name) if isinstance(name, str) else name
    return (
        F.startswith(name, F.lit(SYSTEM_PREFIX))
        | F.lower(name).isin(SYSTEM_NAMES)
        | (name == SYSTEM_EXACT)
    )


def user_objects(objects: DataFrame) -> DataFrame:
    """Objects that are neither internal nor system objects by name."""
    return objects.filter(~is_system("name") & ~F.col("internal"))


def objects_of_kind(
    objects: DataFrame, kinds: list[str], owner: str | None = None, schema: str | None = None
) -> DataFrame:
    """Objects of some kinds, of one owner and schema, with trimmed names."""
    wanted = F.col("kind").isin(kinds)
    if owner is not None:
        wanted &= F.col("owner") == owner
    if schema is not None:
        wanted &= F.col("schema") == schema
    return objects.filter(wanted).withColumn("name", F.rtrim("name"))


def exists_many(requested: DataFrame, objects: DataFrame, keys: list[str]) -> DataFrame:
    """For every requested key: is there an object with exactly this key?"""
    present = objects.select(*keys).distinct().withColumn("_hit", F.lit(True))
    return requested.join(present, keys, "left").select(
        *requested.columns, F.col("_hit").isNotNull().alias("found")
    )


def emptiness(schemas: DataFrame, objects: DataFrame, kinds: list[str]) -> DataFrame:
    """Objects per schema and kind, their sum, and whether the schema is empty."""
    counts = objects.groupBy("schema").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k.lower()}") for k in kinds]
    )
    names = [f"n_{k.lower()}" for k in kinds]
    filled = schemas.join(counts, "schema", "left").select(
        *schemas.columns, *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names]
    )
    total = reduce(Column.__add__, [F.col(n) for n in names])
    return filled.withColumns({"n_objects": total, "is_empty": total == 0})


def tables_without_views(tables: DataFrame, views: DataFrame, keys: list[str]) -> DataFrame:
    """A listing of tables that also returns views, minus the views."""
    return tables.join(views.select(*keys).distinct(), keys, "left_anti")


def all_objects(parts: dict[str, DataFrame]) -> DataFrame:
    """One listing from the listings per kind, with the kind added."""
    return reduce(
        DataFrame.unionByName, [df.withColumn("kind", F.lit(kind)) for kind, df in parts.items()]
    )

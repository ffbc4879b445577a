"""Steps of a migration: functions from tables to tables.

A step changes the plan of a table, not its files. Steps in a row compose, and
the optimizer folds them into one projection over one scan.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import cast_or_null
from tidemark.plans.snapshots import Table

Tables = dict[str, Table]


@dataclass(frozen=True)
class Change:
    """One change, with a text that tells what it does."""

    text: str
    apply: Callable[[SparkSession, Tables], Tables]


@dataclass(frozen=True)
class Step:
    """A version with its description and changes; recorded as one history row."""

    version: str
    description: str
    changes: tuple[Change, ...]

    @property
    def script(self) -> str:
        return f"V{self.version}__{self.description.replace(' ', '_')}.sql"

    @property
    def checksum(self) -> int:
        """CRC-32 of the texts of the changes, as a signed 32-bit number."""
        crc = zlib.crc32("\n".join(c.text for c in self.changes).encode())
        return crc - 2**32 if crc >= 2**31 else crc


def step(version: str, description: str, *changes: Change) -> Step:
    return Step(version, description, changes)


def _need(tables: Tables, name: str) -> Table:
    if name not in tables:
        raise ValueError(f"table {name} does not exist")
    return tables[name]


def _on_rows(text: str, name: str, change: Callable[[DataFrame], DataFrame]) -> Change:
    def apply(spark: SparkSession, tables: Tables) -> Tables:
        table = _need(tables, name)
        return tables | {name: replace(table, rows=change(table.rows), path=None)}

    return Change(text, apply)


def create_table(name: str, columns: str, ts: str | None = None) -> Change:
    """New empty table; a table of that name that is already there stays."""

    def apply(spark: SparkSession, tables: Tables) -> Tables:
        if name in tables:
            return tables
        empty = spark.createDataFrame([], T.StructType.fromDDL(columns))
        return tables | {name: Table(empty, ts)}

    layout = f" PARTITION BY DAY({ts})" if ts else ""
    return Change(f"CREATE TABLE IF NOT EXISTS {name} ({columns}){layout}", apply)


def typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows by column name with each value cast to the declared type.

    A column that the rows lack is null; one the table lacks is an error.
    """
    unknown = [c for c in rows.columns if c not in schema.fieldNames()]
    if unknown:
        raise ValueError(f"no such columns: {', '.join(unknown)}")
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def insert_rows(name: str, rows: DataFrame, label: str = "rows") -> Change:
    """Append rows, matched by column name."""
    return _on_rows(
        f"INSERT INTO {name} ({', '.join(rows.columns)}) {label}",
        name,
        lambda df: df.unionByName(typed(rows, df.schema)),
    )


def rename_table(old: str, new: str) -> Change:
    """Rename; rows and files stay as they are."""

    def apply(spark: SparkSession, tables: Tables) -> Tables:
        if new in tables:
            raise ValueError(f"table {new} exists")
        table = _need(tables, old)
        return {n: t for n, t in tables.items() if n != old} | {new: table}

    return Change(f"RENAME TABLE {old} TO {new}", apply)


def with_column(df: DataFrame, column: str, data_type: str, default: Column | None = None) -> DataFrame:
    """A new last column, null or a default in the old rows."""
    if column in df.columns:
        raise ValueError(f"column {column} exists")
    value = F.lit(None) if default is None else default
    return df.withColumn(column, value.cast(data_type))


def add_column(name: str, column: str, data_type: str, default: Column | None = None) -> Change:
    return _on_rows(
        f"ALTER TABLE {name} ADD COLUMN {column} {data_type} DEFAULT {default}",
        name,
        lambda df: with_column(df, column, data_type, default),
    )


def retyped(df: DataFrame, column: str, data_type: str, on_error: str = "fail") -> DataFrame:
    """The column in place with another type.

    ``fail`` stops at a value that does not fit, ``null`` replaces it by null;
    ``lost_values`` counts those first. A value that the cast only rounds, as 1.7
    to int, fits. ``fail`` stops with ANSI mode on or off.
    """
    if column not in df.columns:
        raise ValueError(f"column {column} does not exist")
    if on_error not in ("fail", "null"):
        raise ValueError("on_error is fail or null")
    old = F.col(column)
    new = cast_or_null(old, df.schema[column].dataType, data_type)
    if on_error == "fail":
        said = F.concat(F.lit(f"{column} does not fit {data_type}: "), old.cast("string"))
        new = F.when(old.isNotNull() & new.isNull(), F.raise_error(said).cast(data_type)).otherwise(new)
    return df.withColumn(column, new)


def lost_values(df: DataFrame, column: str, data_type: str) -> DataFrame:
    """How many values would become null."""
    old = F.col(column)
    lost = old.isNotNull() & cast_or_null(old, df.schema[column].dataType, data_type).isNull()
    return df.agg(F.count_if(lost).alias("n_lost"))


def change_type(name: str, column: str, data_type: str, on_error: str = "fail") -> Change:
    return _on_rows(
        f"ALTER TABLE {name} ALTER COLUMN {column} TYPE {data_type} ON ERROR {on_error}",
        name,
        lambda df: retyped(df, column, data_type, on_error),
    )


def without_column(df: DataFrame, column: str) -> DataFrame:
    """The table without a column that it must have."""
    if column not in df.columns:
        raise ValueError(f"column {column} does not exist")
    return df.drop(column)


def drop_column(name: str, column: str) -> Change:
    return _on_rows(
        f"ALTER TABLE {name} DROP COLUMN {column}", name, lambda df: without_column(df, column)
    )


def drop_table(name: str, if_exists: bool = False) -> Change:
    """Drop; the history of the steps stays."""

    def apply(spark: SparkSession, tables: Tables) -> Tables:
        if not if_exists:
            _need(tables, name)
        return {n: t for n, t in tables.items() if n != name}

    return Change(f"DROP TABLE {name}", apply)


def transform(name: str, text: str, change: Callable[[DataFrame], DataFrame]) -> Change:
    """Any other change of the rows of a table."""
    return _on_rows(text, name, change)

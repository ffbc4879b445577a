"""Comparing the columns a table has with the columns it should have."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T



def column_drift(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Differences between two listings of columns ``(keys..., type)``.

    ``missing``, ``extra`` or ``type``; columns that agree are left out. The
    listings may cover any number of tables and servers.
    """
    left = expected.withColumnsRenamed({"type": "expected_type"})
    right = actual.withColumnsRenamed({"type": "actual_type"})
    drift = (
        F.when(F.col("actual_type").isNull(), "missing")
        .when(F.col("expected_type").isNull(), "extra")
        .when(F.col("expected_type") != F.col("actual_type"), "type")
    )
    return left.join(right, keys, "full").withColumn("drift", drift).filter("drift IS NOT NULL")


def columns_of(df: DataFrame, table: str) -> DataFrame:
    """Schema of a DataFrame as a listing ``(table_name, column_name, type)``."""
    rows = [(table, f.name, f.dataType.simpleString()) for f in df.schema]
    return df.sparkSession.createDataFrame(rows, "table_name string, column_name string, type string")


def ensure_columns(df: DataFrame, expected: T.StructType, on_drift: str = "rewrite") -> DataFrame:
    """The table with at least the expected columns, in one projection.

    ``rewrite`` keeps all rows: missing columns are added as null, other types
    are cast, extra columns stay at the end. ``recreate`` gives an empty table
    of the expected layout if a column is missing, and drops the rows.
    """
    missing = [f for f in expected if f.name not in df.columns]
    if on_drift == "recreate":
        return df.sparkSession.createDataFrame([], expected) if missing else df
    if on_drift != "rewrite":
        raise ValueError("on_drift is rewrite or recreate")
    wanted = [
        (F.lit(None) if f in missing else F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in expected
    ]
    extra = [F.col(c) for c in df.columns if c not in expected.fieldNames()]
    return df.select(*wanted, *extra)

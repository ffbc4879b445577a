"""Keys, nulls and conditions, checked over rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.macros import holds


def insert_if_absent(
    target: DataFrame, new: DataFrame, keys: list[str], order: list[str] | None = None
) -> DataFrame:
    """Target plus the new rows whose key it does not hold yet.

    Of several new rows with one key the first by ``order`` (all columns if
    not given) is taken; the choice is made before the shuffle, per task.
    """
    new = new.select(*target.columns)
    rest = [c for c in target.columns if c not in keys]
    order = order or rest
    first = F.min_by(F.struct(*rest), F.struct(*order, *rest)) if rest else F.lit(None)
    chosen = new.groupBy(*keys).agg(first.alias("_row"))
    added = chosen.join(target.select(*keys), keys, "left_anti").select(
        *[F.col(f"_row.{c}").alias(c) if c in rest else F.col(c) for c in target.columns]
    )
    return target.unionByName(added)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that break a primary key: seen more than once, or partly null."""
    has_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    counted = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return counted.withColumn(
        "problem", F.when(has_null, "null").when(F.col("n_rows") > 1, "duplicate")
    ).filter("problem IS NOT NULL")


def null_violations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Nulls per NOT NULL column, counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], cols, "column_name", "n_nulls")


def check_violations(df: DataFrame, name: str, predicate: Column) -> DataFrame:
    """Rows for which a CHECK is false. An unknown result passes."""
    return df.filter(holds(~predicate)).withColumn("check_name", F.lit(name))


def max_length(col: str, n: int) -> Column:
    """Condition of a VARCHAR(n) column."""
    return F.length(col) <= n

"""Named SQL expressions, and the view that uses one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def register_macro(
    spark: SparkSession, name: str, params: dict[str, str], body: str, returns: str
) -> None:
    """Define a temporary SQL function; the optimizer inlines its body."""
    signature = ", ".join(f"{p} {t}" for p, t in params.items())
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({signature}) RETURNS {returns} RETURN {body}"
    )


def non_empty_text(df: DataFrame, col: str) -> DataFrame:
    """Rows whose text is not empty. A null text is unknown, so it goes too."""
    register_macro(df.sparkSession, "some_is_empty", {"a": "STRING"}, "a = ''", "BOOLEAN")
    return df.filter(~F.call_function("some_is_empty", F.col(col)))


def holds(condition: Column) -> Column:
    """Condition with unknown counted as false, as DELETE and UPDATE count it."""
    return F.coalesce(condition, F.lit(False))

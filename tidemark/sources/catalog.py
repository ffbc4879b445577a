"""Tables of the Spark catalog: create, insert, rename, add a column, drop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def quoted(name: str) -> str:
    """A dotted table name with every part in backticks."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def create_table(
    spark: SparkSession,
    name: str,
    columns: str,
    partition_by: list[str] | None = None,
    if_not_exists: bool = True,
    location: str | None = None,
) -> None:
    """Create a parquet table from column definitions; a second call is a no-op."""
    guard = "IF NOT EXISTS " if if_not_exists else ""
    sql = f"CREATE TABLE {guard}{quoted(name)} ({columns}) USING parquet"
    if partition_by:
        sql += f" PARTITIONED BY ({', '.join(quoted(c) for c in partition_by)})"
    if location:
        sql += " LOCATION '" + location.replace("'", "\\'") + "'"
    spark.sql(sql)


def insert_into(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Append by column name; columns that ``rows`` lacks get their default."""
    columns = ", ".join(quoted(c) for c in rows.columns)
    spark.sql(f"INSERT INTO {quoted(name)} ({columns}) SELECT * FROM {{rows}}", rows=rows)


def rename_table(spark: SparkSession, old: str, new: str) -> None:
    """Rename; the rows stay where they are."""
    spark.sql(f"ALTER TABLE {quoted(old)} RENAME TO {quoted(new)}")


def add_table_column(spark: SparkSession, name: str, column: str, data_type: str) -> None:
    """Add a column at the end. Metadata only: old files read it as null."""
    spark.sql(f"ALTER TABLE {quoted(name)} ADD COLUMNS ({quoted(column)} {data_type})")


def drop_table(spark: SparkSession, name: str, if_exists: bool = False) -> None:
    """Drop the table."""
    spark.sql(f"DROP TABLE {'IF EXISTS ' if if_exists else ''}{quoted(name)}")


def table_exists(spark: SparkSession, name: str) -> bool:
    """Exact check of one name in the catalog."""
    return spark.catalog.tableExists(name)

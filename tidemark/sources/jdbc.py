"""Reading tables of other databases over JDBC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# URL prefix and the driver class that serves it. The longer
# prefix comes first where one prefix starts with another.
JDBC_DRIVERS = {
    "jdbc:clickhouse:": "com.clickhouse.jdbc.ClickHouseDriver",
    "jdbc:cubrid:": "cubrid.jdbc.driver.CUBRIDDriver",
    "jdbc:databricks:": "com.databricks.client.jdbc42.Driver",
    "jdbc:p6spy:db2:": "com.p6spy.engine.spy.P6SpyDriver",
    "jdbc:db2:": "com.ibm.db2.jcc.DB2Driver",
    "jdbc:duckdb:": "org.duckdb.DuckDBDriver",
    "jdbc:ignite:thin:": "org.apache.ignite.IgniteJdbcThinDriver",
    "jdbc:IRIS:": "com.intersystems.jdbc.IRISDriver",
    "jdbc:oceanbase:": "com.oceanbase.jdbc.Driver",
    "jdbc:mysql:": "com.mysql.cj.jdbc.Driver",
    "jdbc:timeplus:": "com.timeplus.jdbc.TimeplusDriver",
    "jdbc:yugabytedb:": "com.yugabyte.Driver",
    "jdbc:p6spy:postgresql:": "com.p6spy.engine.spy.P6SpyDriver",
    "jdbc:postgresql:": "org.postgresql.Driver",
}

# Older driver classes, used when the first one is not present.
BACKUP_JDBC_DRIVERS = {
    "jdbc:clickhouse:": ["ru.yandex.clickhouse.ClickHouseDriver"],
    "jdbc:databricks:": [
        "com.databricks.client.jdbc41.Driver",
        "com.databricks.client.jdbc.Driver",
    ],
    "jdbc:oceanbase:": ["com.alipay.oceanbase.jdbc.Driver"],
}


def driver_for_url(url: str) -> str | None:
    """Driver class for one URL."""
    return next((d for prefix, d in JDBC_DRIVERS.items() if url.startswith(prefix)), None)


def driver_class(url: Column | str) -> Column:
    """Driver class for a column of URLs."""
    url = F.col(url) if isinstance(url, str) else url
    choice = F.lit(None).cast("string")
    for prefix, driver in reversed(JDBC_DRIVERS.items()):
        choice = F.when(F.startswith(url, F.lit(prefix)), F.lit(driver)).otherwise(choice)
    return choice


def jdbc_options(
    url: str,
    table: str,
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    driver: str | None = None,
) -> dict[str, str]:
    """Options of the scan; with a key the table is read in parallel slices."""
    driver = driver or driver_for_url(url)
    if driver is None:
        raise ValueError(f"no driver known for {url.split('?')[0]}")
    options = {"url": url, "driver": driver, "dbtable": table}
    if key is not None and bounds is not None and partitions > 1:
        low, high = bounds
        options |= {
            "partitionColumn": key,
            "lowerBound": str(low),
            "upperBound": str(high + 1),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    key: str | None = None,
    partitions: int = 1,
    driver: str | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Scan a table, split on a numeric key. Filters and columns push down.

    The bounds of the key are one row that the database itself computes.
    """
    reader = spark.read.format("jdbc").options(**(properties or {}))
    bounds = None
    if key is not None and partitions > 1:
        plain = jdbc_options(url, table, driver=driver)
        plain.pop("dbtable")
        query = f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}"
        row = reader.options(**plain).option("query", query).load().first()
        if row is not None and row[0] is not None:
            bounds = (int(row[0]), int(row[1]))
    options = jdbc_options(url, table, key, bounds, partitions, driver)
    return spark.read.format("jdbc").options(**(properties or {})).options(**options).load()

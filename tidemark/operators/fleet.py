"""Fleets of database servers: which product, and is its version supported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.macros import holds
from tidemark.functions.scalars import version_at_least, version_from_text, version_key

# Oldest supported and newest known version per dialect.
VERSION_RANGE = {
    "db2z": ("12.1", "13.1"),
    "tidb": ("5.0", "5.0"),
    "oceanbase": ("1.4", "5.0"),
    "yugabytedb": ("11.2", None),
    "iris": ("2019", None),
}
YUGABYTE_VERSION = r"^PostgreSQL\s\d{1,2}(\.\d{1,2})?-YB-\d{1,2}(\.\d{1,2})?"


def detect_dialect(servers: DataFrame) -> DataFrame:
    """Add the dialect of each server from URL, product and version texts.

    Rules are tried in order. Where several products share a URL prefix, the
    special ones come before the general one. Null: no rule fits.
    """
    url, product = F.col("url"), F.col("product")
    version, text = F.col("product_version"), F.col("version_text")

    def url_is(*prefixes: str) -> Column:
        found = F.lit(False)
        for prefix in prefixes:
            found = found | F.startswith(url, F.lit(prefix))
        return found

    def product_is(name: str) -> Column:
        return F.startswith(product, F.lit(name))

    mysql = F.contains(product, F.lit("MySQL"))
    postgres_url = url_is("jdbc:postgresql:")
    db2_url = url_is("jdbc:db2:", "jdbc:p6spy:db2:")
    iris_major = F.element_at(version_key(F.regexp_extract(version, r"[0-9]+", 0)), 1)
    rules = [
        (
            "oceanbase",
            url_is("jdbc:mysql:", "jdbc:oceanbase:")
            & (mysql | F.contains(product, F.lit("OceanBase")))
            & F.contains(text, F.lit("OceanBase")),
        ),
        (
            "tidb",
            url_is("jdbc:mysql:")
            & mysql
            & (F.contains(version, F.lit("TiDB")) | F.contains(text, F.lit("TiDB"))),
        ),
        (
            "yugabytedb",
            (url_is("jdbc:yugabytedb:", "jdbc:p6spy:postgresql:") | postgres_url)
            & product_is("PostgreSQL")
            & text.rlike(YUGABYTE_VERSION),
        ),
        ("questdb", postgres_url & product_is("PostgreSQL") & F.endswith(text, F.lit("QuestDB"))),
        ("db2z", db2_url & product_is("DB2") & F.startswith(version, F.lit("DSN"))),
        ("clickhouse", url_is("jdbc:clickhouse:") & product_is("ClickHouse")),
        ("cubrid", url_is("jdbc:cubrid:") & F.contains(F.lower(product), F.lit("cubrid"))),
        ("databricks", url_is("jdbc:databricks:") & product_is("SparkSQL")),
        ("duckdb", url_is("jdbc:duckdb:") & product_is("DuckDB")),
        ("ignite", url_is("jdbc:ignite:thin:") & product_is("Apache Ignite")),
        ("iris", url_is("jdbc:IRIS:") & product_is("InterSystems IRIS") & (iris_major >= 2019)),
        ("timeplus", url_is("jdbc:timeplus:") & product_is("Timeplus")),
        ("mysql", url_is("jdbc:mysql:") & mysql),
        ("postgresql", postgres_url & product_is("PostgreSQL")),
        ("db2", db2_url & product_is("DB2")),
    ]
    name, rule = rules[0]
    choice = F.when(holds(rule), name)
    for name, rule in rules[1:]:
        choice = choice.when(holds(rule), name)
    return servers.withColumn("dialect", choice)


def server_version(dialect: Column, version: Column, text: Column) -> Column:
    """Version to gate on: one dialect tells it only in its version comment."""
    return F.when(dialect == "oceanbase", version_from_text(text)).otherwise(version)


def version_gate(
    servers: DataFrame, ranges: dict[str, tuple[str, str | None]] | None = None
) -> DataFrame:
    """Add the status of each server's ``version`` for its ``dialect``.

    ``too_old``: below the minimum; ``newer_than_known``: above the newest
    known version; ``unknown``: the version cannot be read; else ``ok``.
    """
    status = F.lit("ok")
    for dialect, (low, high) in (VERSION_RANGE if ranges is None else ranges).items():
        answer = F.when(version_key("version").isNull(), "unknown").when(
            ~version_at_least("version", low), "too_old"
        )
        if high is not None:
            answer = answer.when(version_key("version") > version_key(F.lit(high)), "newer_than_known")
        status = F.when(F.col("dialect") == dialect, answer.otherwise("ok")).otherwise(status)
    return servers.withColumn("status", status)

"""Migrations of table data, and tables of the catalog."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.checks.base import Checks, Given
from tidemark.plans import columns, steps
from tidemark.plans.migrate import baseline_row, migrate, pending, read_history
from tidemark.session import scratch_path
from tidemark.sources import catalog, layout

CHECKS = Checks()
TRADE_COLUMNS = "instrument string, side string, qty double, price double, ts timestamp_ntz"


def trades(g: Given) -> DataFrame:
    return g.lineitem.select(
        F.concat(F.lit("SYM"), "l_partkey").alias("instrument"),
        F.when(F.col("l_returnflag") == "R", "SELL").otherwise("BUY").alias("side"),
        F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("ts"),
    )


def trade_steps(g: Given) -> list[steps.Step]:
    return [
        steps.step("1", "Trades as they come in", steps.create_table("trades", TRADE_COLUMNS)),
        steps.step("2", "One trade for each order line", steps.insert_rows("trades", trades(g))),
        steps.step("3", "Out of the way for a while", steps.rename_table("trades", "trades_table")),
        steps.step(
            "4",
            "Back again, with the place of trade",
            steps.rename_table("trades_table", "trades"),
            steps.add_column("trades", "venue", "string"),
        ),
        steps.step("5", "Whole quantities only", steps.change_type("trades", "qty", "int")),
        steps.step("6", "No place of trade after all", steps.drop_column("trades", "venue")),
        steps.step("7", "No trades any more", steps.drop_table("trades")),
    ]


TRADES = """trades AS (
  SELECT concat('SYM', l_partkey) AS instrument,
    CASE WHEN l_returnflag = 'R' THEN 'SELL' ELSE 'BUY' END AS side,
    l_quantity AS qty, l_extendedprice AS price, l_shipdate AS ts
  FROM lineitem)"""


@CHECKS.add(
    f"WITH {TRADES} SELECT instrument, side, CAST(trunc(qty) AS INTEGER) AS qty, price, ts FROM trades"
)
def migrate_trades(g: Given) -> DataFrame:
    """Six steps, one scan, one write."""
    root = scratch_path(g.spark, "migrate")
    return migrate(g.spark, root, trade_steps(g), target="6").tables["trades"]


@CHECKS.add(
    """SELECT * FROM (VALUES
      (1, '1', 'Trades as they come in', 'V1__Trades_as_they_come_in.sql', true),
      (2, '2', 'One trade for each order line', 'V2__One_trade_for_each_order_line.sql', true),
      (3, '3', 'Out of the way for a while', 'V3__Out_of_the_way_for_a_while.sql', true),
      (4, '4', 'Back again, with the place of trade', 'V4__Back_again,_with_the_place_of_trade.sql', true),
      (5, '5', 'Whole quantities only', 'V5__Whole_quantities_only.sql', true),
      (6, '6', 'No place of trade after all', 'V6__No_place_of_trade_after_all.sql', true),
      (7, '7', 'No trades any more', 'V7__No_trades_any_more.sql', true)
    ) AS t(installed_rank, version, description, script, success)"""
)
def drop_table(g: Given) -> DataFrame:
    """The rows are written, then dropped; the history stays."""
    root = scratch_path(g.spark, "migrate")
    migrate(g.spark, root, trade_steps(g), target="2")
    left = migrate(g.spark, root, trade_steps(g)).tables
    assert not left
    return read_history(g.spark, root).select(
        "installed_rank", "version", "description", "script", "success"
    )


def minute_versions(g: Given) -> DataFrame:
    version = F.concat_ws(".", F.day("ts"), F.hour("ts"), F.minute("ts"))
    return g.events.select(
        version.alias("version"), F.lit("SQL").alias("type"), (F.col("event_type") != "error").alias("success")
    )


MINUTES = """minutes AS (
  SELECT concat(day(ts), '.', hour(ts), '.', minute(ts)) AS version,
    day(ts) * 10000 + hour(ts) * 100 + minute(ts) AS place, event_type <> 'error' AS success
  FROM events)"""


@CHECKS.add(
    f"""WITH {MINUTES} SELECT DISTINCT version FROM minutes
    WHERE place <= 200500 AND version NOT IN (SELECT version FROM minutes WHERE success)"""
)
def pending_versions(g: Given) -> DataFrame:
    rows = minute_versions(g)
    return pending(rows.select("version").distinct(), rows, target="20.05")


@CHECKS.add(
    f"""WITH {MINUTES} SELECT DISTINCT version FROM minutes
    WHERE place > 150000 AND version NOT IN (SELECT version FROM minutes WHERE success)"""
)
def pending_after_baseline(g: Given) -> DataFrame:
    rows = minute_versions(g)
    started = rows.unionByName(baseline_row(g.spark, "15").select(*rows.columns))
    return pending(rows.select("version").distinct(), started)


@CHECKS.add("SELECT * FROM orders")
def insert_rows(g: Given) -> DataFrame:
    """Open orders stay; the others arrive as text and are cast."""
    is_open = F.col("o_orderstatus") == "O"
    old = g.orders.filter(is_open)
    text = g.orders.filter(~is_open).select(*[F.col(c).cast("string").alias(c) for c in old.columns])
    return old.unionByName(steps.typed(text, old.schema))


def table_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


@CHECKS.add(
    f"""WITH {TRADES} SELECT instrument, count(*) AS n_trades,
      CAST(sum(CAST(qty AS BIGINT)) AS BIGINT) AS sum_qty FROM trades GROUP BY instrument"""
)
def rename_table(g: Given) -> DataFrame:
    old, new = table_name("trades"), table_name("trades_table")
    catalog.create_table(g.spark, old, TRADE_COLUMNS, location=scratch_path(g.spark, "trades"))
    catalog.insert_into(g.spark, old, trades(g))
    catalog.rename_table(g.spark, old, new)
    return (
        g.spark.table(new)
        .groupBy("instrument")
        .agg(F.count("*").alias("n_trades"), F.sum(F.col("qty").cast("long")).alias("sum_qty"))
    )


@CHECKS.add("SELECT *, CAST(NULL AS VARCHAR) AS o_venue, 'web' AS o_channel FROM orders")
def add_column(g: Given) -> DataFrame:
    wider = steps.with_column(g.orders, "o_venue", "string")
    return steps.with_column(wider, "o_channel", "string", F.lit("web"))


@CHECKS.add("SELECT *, CAST(NULL AS VARCHAR) AS venue FROM trades".replace("SELECT", f"WITH {TRADES} SELECT", 1))
def add_table_column(g: Given) -> DataFrame:
    """Metadata only: files written before read the column as null."""
    name = table_name("trades")
    catalog.create_table(g.spark, name, TRADE_COLUMNS, location=scratch_path(g.spark, "trades"))
    catalog.insert_into(g.spark, name, trades(g))
    catalog.add_table_column(g.spark, name, "venue", "string")
    return g.spark.table(name)


@CHECKS.add(
    """SELECT * REPLACE (CAST(trunc(l_quantity) AS INTEGER) AS l_quantity,
      TRY_CAST(l_linestatus AS INTEGER) AS l_linestatus) FROM lineitem"""
)
def change_type(g: Given) -> DataFrame:
    whole = steps.retyped(g.lineitem, "l_quantity", "int")
    return steps.retyped(whole, "l_linestatus", "int", on_error="null")


@CHECKS.add(
    """SELECT count(*) AS n_lost FROM lineitem
    WHERE l_linestatus IS NOT NULL AND TRY_CAST(l_linestatus AS INTEGER) IS NULL"""
)
def change_type_lost(g: Given) -> DataFrame:
    return steps.lost_values(g.lineitem, "l_linestatus", "int")


@CHECKS.add("SELECT * EXCLUDE (o_orderpriority) FROM orders")
def drop_column(g: Given) -> DataFrame:
    return steps.without_column(g.orders, "o_orderpriority")


@CHECKS.add(
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(NULL AS VARCHAR) AS o_clerk,
      o_totalprice, o_orderstatus, o_orderdate, o_orderpriority FROM orders"""
)
def ensure_columns(g: Given) -> DataFrame:
    expected = T.StructType.fromDDL("o_orderkey long, o_custkey string, o_clerk string, o_totalprice double")
    return columns.ensure_columns(g.orders, expected)


@CHECKS.add(
    """SELECT column_name, e.type AS expected_type, a.type AS actual_type,
      CASE WHEN a.type IS NULL THEN 'missing' WHEN e.type IS NULL THEN 'extra' ELSE 'type' END AS drift
    FROM (SELECT concat('c', c_custkey) AS column_name, c_mktsegment AS type FROM customer) e
    FULL JOIN (SELECT concat('c', c_custkey + 50) AS column_name, 'BUILDING' AS type FROM customer) a
      USING (column_name)
    WHERE e.type IS DISTINCT FROM a.type"""
)
def column_drift(g: Given) -> DataFrame:
    name = F.concat(F.lit("c"), F.col("c_custkey"))
    moved = F.concat(F.lit("c"), F.col("c_custkey") + 50)
    expected = g.customer.select(name.alias("column_name"), F.col("c_mktsegment").alias("type"))
    actual = g.customer.select(moved.alias("column_name"), F.lit("BUILDING").alias("type"))
    return columns.column_drift(expected, actual, ["column_name"])


@CHECKS.add(
    "SELECT count(*) AS n_rows, count(*) FILTER (o_orderstatus = 'O') AS n_open, count(*) AS n_web FROM orders"
)
def create_table(g: Given) -> DataFrame:
    """Created twice, filled once; the last column takes its default."""
    name = table_name("orders")
    definition = "o_orderkey BIGINT NOT NULL, o_orderstatus STRING, o_channel STRING DEFAULT 'web'"
    path = scratch_path(g.spark, "orders")
    catalog.create_table(g.spark, name, definition, location=path)
    catalog.insert_into(g.spark, name, g.orders.select("o_orderkey", "o_orderstatus"))
    catalog.create_table(g.spark, name, definition, location=path)
    return g.spark.table(name).agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("o_orderstatus") == "O").alias("n_open"),
        F.count_if(F.col("o_channel") == "web").alias("n_web"),
    )


@CHECKS.add("SELECT CAST(ts AS DATE) AS day, count(*) AS n_events FROM events GROUP BY 1")
def day_partitioned(g: Given) -> DataFrame:
    path = scratch_path(g.spark, "events")
    layout.write_day_partitioned(g.events, path, "ts")
    return g.spark.read.parquet(path).groupBy("day").agg(F.count("*").alias("n_events"))


@CHECKS.add("SELECT * FROM lineitem WHERE l_partkey BETWEEN 100 AND 199")
def clustered_lookup(g: Given) -> DataFrame:
    path = scratch_path(g.spark, "lineitem")
    layout.cluster_for_lookup(g.lineitem, ["l_partkey"], path)
    return g.spark.read.parquet(path).filter(F.col("l_partkey").between(100, 199))


@CHECKS.add("SELECT * FROM lineitem WHERE l_suppkey BETWEEN 3 AND 5")
def curve_lookup(g: Given) -> DataFrame:
    """Looked up by the second of the clustered columns."""
    path = scratch_path(g.spark, "lineitem")
    layout.cluster_by_curve(g.lineitem, ["l_partkey", "l_suppkey"], path)
    return g.spark.read.parquet(path).filter(F.col("l_suppkey").between(3, 5))

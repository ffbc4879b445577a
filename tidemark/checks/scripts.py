"""Script collections: one script per order, with statements known by construction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.checks.base import Checks, Given
from tidemark.operators import statements
from tidemark.session import scratch_path
from tidemark.sources.scripts import read_scripts as read

CHECKS = Checks()

SCRIPT = (
    "-- order {k}; first\n"
    "INSERT INTO orders VALUES ({k}, 'it''s; {priority}');\n\n"
    "call app.note({cust}, 'a;b, ''c''', NULL, price + 1, 99999999999);;\n"
    "--#SET TERMINATOR @\n"
    "CREATE PROCEDURE p{k} () BEGIN IF a = {cust} THEN DELETE FROM t; END IF; END@\n"
    "DROP TABLE IF EXISTS t{k}@\n"
    "/* done; */ UPDATE t SET s = '{status} drop' -- last; one\n"
    " WHERE k = {k}@ -- nothing more\n"
)
STATEMENTS = [
    ("INSERT INTO orders VALUES ({k}, 'it''s; {priority}')", "INSERT", True),
    ("call app.note({cust}, 'a;b, ''c''', NULL, price + 1, 99999999999)", "CALL", True),
    (
        "CREATE PROCEDURE p{k} () BEGIN IF a = {cust} THEN DELETE FROM t; END IF; END",
        "CREATE",
        False,
    ),
    ("DROP TABLE IF EXISTS t{k}", "DROP", False),
    ("UPDATE t SET s = '{status} drop' -- last; one\n WHERE k = {k}", "UPDATE", True),
]
FIELDS = {
    "{k}": "o_orderkey",
    "{cust}": "o_custkey",
    "{priority}": "o_orderpriority",
    "{status}": "o_orderstatus",
}


def filled_sql(template: str) -> str:
    text = "'" + template.replace("'", "''") + "'"
    for field, column in FIELDS.items():
        text = f"replace({text}, '{field}', CAST({column} AS VARCHAR))"
    return text


def order_scripts(g: Given) -> DataFrame:
    text = F.lit(SCRIPT)
    for field, column in FIELDS.items():
        text = F.replace(text, F.lit(field), F.col(column).cast("string"))
    return g.orders.select(F.concat(F.lit("V"), "o_orderkey", F.lit("__order.sql")).alias("path"), text.alias("text"))


PATH = "concat('V', o_orderkey, '__order.sql') AS path"
KNOWN = " UNION ALL ".join(
    f"SELECT {PATH}, {n} AS stmt_no, {filled_sql(text)} AS sql, '{kind}' AS kind, "
    f"{str(transactional).lower()} AS transactional FROM orders"
    for n, (text, kind, transactional) in enumerate(STATEMENTS, 1)
)


@CHECKS.add(f"SELECT path, stmt_no, sql FROM ({KNOWN})")
def split_statements(g: Given) -> DataFrame:
    return statements.split_statements(order_scripts(g), "db2z")


@CHECKS.add(f"SELECT kind, transactional, count(*) AS n FROM ({KNOWN}) GROUP BY 1, 2")
def classify_statements(g: Given) -> DataFrame:
    split = statements.split_statements(order_scripts(g), "db2z")
    return (
        statements.classify_statements(split)
        .groupBy("kind", "transactional")
        .agg(F.count("*").alias("n"))
    )


@CHECKS.add(
    f"""WITH a AS (SELECT {PATH}, 2 AS stmt_no, 'app.note' AS procedure, o_custkey FROM orders)
    SELECT path, stmt_no, procedure, 1 AS arg_no, 'int' AS kind, NULL AS str_value,
      CAST(o_custkey AS INTEGER) AS int_value FROM a
    UNION ALL SELECT path, stmt_no, procedure, 2, 'string', 'a;b, ''c''', NULL FROM a
    UNION ALL SELECT path, stmt_no, procedure, 3, 'null', NULL, NULL FROM a
    UNION ALL SELECT path, stmt_no, procedure, 4, 'raw', 'price + 1', NULL FROM a
    UNION ALL SELECT path, stmt_no, procedure, 5, 'raw', '99999999999', NULL FROM a"""
)
def extract_calls(g: Given) -> DataFrame:
    return statements.extract_calls(statements.split_statements(order_scripts(g), "db2z"), bare=True)


@CHECKS.add(
    """SELECT n_name AS nation, count(*) AS n_statements FROM customer
    JOIN nation ON n_nationkey = c_nationkey GROUP BY 1"""
)
def read_scripts(g: Given) -> DataFrame:
    """Scripts per nation are written as files of some lines each, and read whole."""
    folder = scratch_path(g.spark, "scripts")
    line = F.concat(F.lit("INSERT INTO t VALUES ("), "c_custkey", F.lit(");"))
    rows = g.customer.join(g.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    (
        rows.select(F.col("n_name").alias("nation"), line.alias("value"))
        .hint("rebalance", F.col("nation"))
        .write.partitionBy("nation")
        .option("maxRecordsPerFile", 10_000)
        .text(folder)
    )
    nation = F.regexp_extract("path", r"nation=([^/]+)/", 1)
    return (
        read(g.spark, folder, glob="*.txt")
        .groupBy(nation.alias("nation"))
        .agg(F.sum(F.size(F.split("text", ";")) - 1).alias("n_statements"))
    )

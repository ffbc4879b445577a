"""Keys, nulls, references and comparisons over rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.checks.base import HIST, HIST_COLUMNS, Checks, Given, hist
from tidemark.functions.macros import non_empty_text as rows_with_text
from tidemark.functions.macros import register_macro as register
from tidemark.operators import constraints, groups, refs, sequences

CHECKS = Checks()


@CHECKS.add(
    """SELECT o_orderkey, count(l_orderkey) AS n_refs FROM orders
    LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey"""
)
def row_ref_counts(g: Given) -> DataFrame:
    return refs.row_ref_counts(g.orders.select("o_orderkey"), g.lineitem, "o_orderkey", "l_orderkey")


@CHECKS.add(
    """SELECT l_orderkey, l_linenumber, l_quantity, l_partkey + l_linenumber * 100 AS l_partkey
    FROM lineitem WHERE l_partkey + l_linenumber * 100 NOT IN (SELECT p_partkey FROM part)"""
)
def fk_violations(g: Given) -> DataFrame:
    """Part keys are moved up, so the highest ones have no part."""
    moved = (F.col("l_partkey") + F.col("l_linenumber") * 100).alias("l_partkey")
    child = g.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", moved)
    return refs.fk_violations(child, "l_partkey", g.part, "p_partkey")


@CHECKS.add(
    """SELECT doc_id, doc_id * 2 AS parent_id, n_chars FROM documents
    WHERE lang <> 'en' AND doc_id * 2 NOT IN (SELECT doc_id FROM documents)"""
)
def fk_violations_self(g: Given) -> DataFrame:
    """Documents reference documents; a null reference is no violation."""
    parent = F.when(F.col("lang") != "en", F.col("doc_id") * 2).alias("parent_id")
    child = g.documents.select("doc_id", parent, "n_chars")
    return refs.fk_violations(child, "parent_id", g.documents, "doc_id")


@CHECKS.add(
    """WITH c AS (SELECT l_orderkey + 4 * (l_linenumber % 2) AS o, CASE WHEN l_linenumber <> 3 THEN l_linenumber END AS n, l_quantity FROM lineitem)
    SELECT o, n, l_quantity FROM c WHERE o IS NOT NULL AND n IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = c.o AND l.l_linenumber = c.n)"""
)
def fk_violations_composite(g: Given) -> DataFrame:
    """Lines refer to lines by order and number; a number that is missing refers to nothing."""
    number = F.when(F.col("l_linenumber") != 3, F.col("l_linenumber"))
    moved = (F.col("l_orderkey") + 4 * (F.col("l_linenumber") % 2)).alias("o")
    child = g.lineitem.select(moved, number.alias("n"), "l_quantity")
    return refs.fk_violations(child, ["o", "n"], g.lineitem, ["l_orderkey", "l_linenumber"])


@CHECKS.add(
    """SELECT l_orderkey, l_linenumber, l_quantity, l_partkey + l_linenumber * 100 AS l_partkey
    FROM lineitem WHERE l_partkey + l_linenumber * 100 NOT IN (SELECT p_partkey FROM part)"""
)
def fk_violations_dense(g: Given) -> DataFrame:
    """As ``fk_violations``, by a bitmap of the part keys."""
    moved = (F.col("l_partkey") + F.col("l_linenumber") * 100).alias("l_partkey")
    child = g.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", moved)
    return refs.fk_violations_dense(child, "l_partkey", g.part, "p_partkey")


@CHECKS.add(
    """SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING'
    UNION ALL SELECT * REPLACE (c_acctbal + 1 AS c_acctbal) FROM customer WHERE c_mktsegment = 'BUILDING'"""
)
def insert_if_absent(g: Given) -> DataFrame:
    """Every customer arrives twice; of two new rows the smaller balance wins."""
    target = g.customer.filter("c_mktsegment <> 'BUILDING'")
    new = g.customer.withColumn("c_acctbal", F.col("c_acctbal") + 2).unionByName(
        g.customer.withColumn("c_acctbal", F.col("c_acctbal") + 1)
    )
    return constraints.insert_if_absent(target, new, ["c_custkey"], order=["c_acctbal"])


@CHECKS.add(
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows, 'duplicate' AS problem
    FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""
)
def duplicate_keys(g: Given) -> DataFrame:
    return constraints.duplicate_keys(g.lineitem, ["l_orderkey", "l_linenumber"])


@CHECKS.add(
    f"WITH {HIST} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_nulls FROM hist"
        for c in HIST_COLUMNS.split(", ")
    )
)
def null_violations(g: Given) -> DataFrame:
    return constraints.null_violations(hist(g), HIST_COLUMNS.split(", "))


@CHECKS.add("SELECT *, 'small_discount' AS check_name FROM lineitem WHERE NOT (l_discount <= l_tax)")
def check_violations(g: Given) -> DataFrame:
    predicate = F.col("l_discount") <= F.col("l_tax")
    return constraints.check_violations(g.lineitem, "small_discount", predicate)


@CHECKS.add("SELECT p_partkey, p_name, 'p_name_length' AS check_name FROM part WHERE length(p_name) > 9")
def length_violations(g: Given) -> DataFrame:
    rows = g.part.select("p_partkey", "p_name")
    return constraints.check_violations(rows, "p_name_length", constraints.max_length("p_name", 9))


@CHECKS.add(
    """SELECT *, 'left' AS side, CAST(1 AS BIGINT) AS n_rows FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT * REPLACE ('DONE' AS o_orderstatus), 'right', 1 FROM orders WHERE o_orderstatus = 'F'"""
)
def table_diff(g: Given) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "DONE").otherwise(F.col("o_orderstatus"))
    return groups.table_diff(g.orders, g.orders.withColumn("o_orderstatus", status))


FAILED = "DSNUGBAC - UTILITY EXECUTION TERMINATED, HIGHEST RETURN CODE="
RESULTS = f"""r AS (SELECT conv_id AS call_id, turn AS row_no,
    CASE WHEN role = 'assistant' THEN concat('{FAILED}', turn) ELSE text END AS message
  FROM conversations)"""


def call_results(g: Given) -> DataFrame:
    """Conversations as call output; each assistant turn reports a failure."""
    message = F.when(F.col("role") == "assistant", F.concat(F.lit(FAILED), "turn")).otherwise(F.col("text"))
    return g.conversations.select(
        F.col("conv_id").alias("call_id"), F.col("turn").alias("row_no"), message.alias("message")
    )


@CHECKS.add(
    f"""WITH {RESULTS}, o AS (SELECT call_id, count(*) AS n_messages,
        starts_with(arg_max(message, row_no), 'DSNUGBAC') AS failed,
        concat('DSNUTILU TERMINATED WITH OUTPUT:', chr(10), string_agg(concat(message, chr(10)), '' ORDER BY row_no)) AS t
      FROM r GROUP BY call_id)
    SELECT call_id, n_messages, failed, CASE WHEN failed THEN t END AS error_text FROM o"""
)
def call_outcome(g: Given) -> DataFrame:
    return groups.call_outcome(call_results(g))


@CHECKS.add(
    f"""WITH {RESULTS} SELECT call_id, row_no, message FROM r WHERE call_id IN
      (SELECT call_id FROM r GROUP BY 1 HAVING starts_with(arg_max(message, row_no), 'DSNUGBAC'))"""
)
def failed_messages(g: Given) -> DataFrame:
    return groups.failed_messages(call_results(g))


@CHECKS.add(
    """SELECT doc_id, n_chars, CASE WHEN lang = 'de' THEN '' WHEN lang = 'fr' THEN NULL ELSE text END AS text
    FROM documents WHERE lang NOT IN ('de', 'fr')"""
)
def non_empty_text(g: Given) -> DataFrame:
    text = F.expr("CASE WHEN lang = 'de' THEN '' WHEN lang = 'fr' THEN NULL ELSE text END")
    return rows_with_text(g.documents.select("doc_id", "n_chars", text.alias("text")), "text")


@CHECKS.add("SELECT l_quantity >= 30 AS bulk, count(*) AS n FROM lineitem GROUP BY 1")
def register_macro(g: Given) -> DataFrame:
    register(g.spark, "is_bulk", {"quantity": "DOUBLE"}, "quantity >= 30", "BOOLEAN")
    return g.lineitem.groupBy(F.expr("is_bulk(l_quantity)").alias("bulk")).agg(F.count("*").alias("n"))


@CHECKS.add(
    "SELECT o_orderkey, o_orderdate, 100 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS seq FROM orders"
)
def assign_sequence(g: Given) -> DataFrame:
    rows = g.orders.select("o_orderkey", "o_orderdate")
    return sequences.assign_sequence(rows, ["o_orderdate", "o_orderkey"], start=101)

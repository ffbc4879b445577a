"""Catalog listings and reference graphs, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.checks.base import Checks, Given
from tidemark.operators import fleet, layers, objects, refs
from tidemark.sources import jdbc

CHECKS = Checks()


@CHECKS.add(
    """SELECT name, internal FROM (SELECT CASE p_size WHEN 1 THEN concat('sys.', p_name)
        WHEN 2 THEN 'Telemetry' WHEN 3 THEN '_QUERY_TRACE' WHEN 4 THEN '__T0' ELSE p_name END AS name,
      p_size = 5 AS internal FROM part)
    WHERE NOT internal AND NOT starts_with(name, 'sys.') AND name <> '__T0'
      AND lower(name) NOT IN ('telemetry_config', 'telemetry', '_query_trace')"""
)
def user_objects(g: Given) -> DataFrame:
    name = F.expr(
        "CASE p_size WHEN 1 THEN concat('sys.', p_name) WHEN 2 THEN 'Telemetry' "
        "WHEN 3 THEN '_QUERY_TRACE' WHEN 4 THEN '__T0' ELSE p_name END"
    )
    listed = g.part.select(name.alias("name"), (F.col("p_size") == 5).alias("internal"))
    return objects.user_objects(listed)


@CHECKS.add(
    """SELECT 'LOW' AS schema, rtrim(p_name) AS name, p_type AS kind, p_brand AS owner FROM part
    WHERE p_size <= 25 AND p_type IN ('LARGE', 'PROMO') AND p_brand = 'Brand#1'"""
)
def objects_of_kind(g: Given) -> DataFrame:
    listed = g.part.select(
        F.when(F.col("p_size") <= 25, "LOW").otherwise("HIGH").alias("schema"),
        F.concat("p_name", F.lit("   ")).alias("name"),
        F.col("p_type").alias("kind"),
        F.col("p_brand").alias("owner"),
    )
    return objects.objects_of_kind(listed, ["LARGE", "PROMO"], owner="Brand#1", schema="LOW")


@CHECKS.add(
    """SELECT 'F' AS schema, concat('C', c_custkey) AS name,
      c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS found FROM customer"""
)
def exists_many(g: Given) -> DataFrame:
    requested = g.customer.select(
        F.lit("F").alias("schema"), F.concat(F.lit("C"), "c_custkey").alias("name")
    )
    listed = g.orders.select(
        F.col("o_orderstatus").alias("schema"), F.concat(F.lit("C"), "o_custkey").alias("name")
    )
    return objects.exists_many(requested, listed, ["schema", "name"])


@CHECKS.add(
    """WITH s AS (SELECT n_nationkey AS k, n_name AS schema FROM nation
        UNION ALL SELECT -1 - n_nationkey, concat('EMPTY_', n_name) FROM nation),
      t AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1),
      v AS (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1)
    SELECT schema, coalesce(t.n, 0) AS n_table, coalesce(v.n, 0) AS n_view,
      coalesce(t.n, 0) + coalesce(v.n, 0) AS n_objects, coalesce(t.n, 0) + coalesce(v.n, 0) = 0 AS is_empty
    FROM s LEFT JOIN t USING (k) LEFT JOIN v USING (k)"""
)
def emptiness(g: Given) -> DataFrame:
    names = g.nation.select(F.col("n_name").alias("schema"))
    empty = names.select(F.concat(F.lit("EMPTY_"), "schema").alias("schema"))
    keyed = {
        "TABLE": g.customer.select(F.col("c_nationkey").alias("n_nationkey")),
        "VIEW": g.supplier.select(F.col("s_nationkey").alias("n_nationkey")),
    }
    listed = objects.all_objects(keyed).join(g.nation, "n_nationkey")
    listed = listed.select(F.col("n_name").alias("schema"), "kind")
    return objects.emptiness(names.unionByName(empty), listed, ["TABLE", "VIEW"])


@CHECKS.add("SELECT p_type AS schema, concat('P', p_partkey) AS name FROM part WHERE p_brand <> 'Brand#1'")
def tables_without_views(g: Given) -> DataFrame:
    tables = g.part.select(
        F.col("p_type").alias("schema"), F.concat(F.lit("P"), "p_partkey").alias("name"), "p_brand"
    )
    views = tables.filter("p_brand = 'Brand#1'")
    return objects.tables_without_views(tables.drop("p_brand"), views, ["schema", "name"])


@CHECKS.add(
    """SELECT 'VIEW' AS kind, c_name AS name, c_nationkey AS nation FROM customer
    UNION ALL SELECT 'TABLE', s_name, s_nationkey FROM supplier
    UNION ALL SELECT 'SEQUENCE', n_name, n_nationkey FROM nation"""
)
def all_objects(g: Given) -> DataFrame:
    return objects.all_objects(
        {
            "VIEW": g.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")),
            "TABLE": g.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")),
            "SEQUENCE": g.nation.select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("nation")),
        }
    )


@CHECKS.add(
    """WITH r AS (SELECT concat('FK', l_orderkey, '_', l_linenumber) AS fk, concat('PK', l_partkey) AS pk,
        concat('T', l_suppkey) AS source FROM lineitem),
      k AS (SELECT fk AS name, source AS table_name FROM r
        UNION ALL SELECT concat('PK', p_partkey), concat('T', p_partkey) FROM part),
      counted AS (SELECT t.table_name, count(*) AS n, count(DISTINCT r.fk) AS c
        FROM r JOIN k t ON r.pk = t.name JOIN k f ON r.fk = f.name
        WHERE f.table_name <> t.table_name GROUP BY 1)
    SELECT concat('T', p_partkey) AS table_name, coalesce(n, 0) AS incoming_refs_count,
      coalesce(c, 0) AS n_constraints
    FROM part LEFT JOIN counted ON table_name = concat('T', p_partkey)"""
)
def incoming_refs(g: Given) -> DataFrame:
    """A table per part; each order line is a reference from its supplier's table."""
    here = F.lit("S").alias("constraint_schema")
    fk = F.concat(F.lit("FK"), "l_orderkey", F.lit("_"), "l_linenumber").alias("constraint_name")
    links = g.lineitem.select(
        here,
        fk,
        F.lit("S").alias("unique_constraint_schema"),
        F.concat(F.lit("PK"), "l_partkey").alias("unique_constraint_name"),
    )
    table = F.concat(F.lit("T"), F.col("p_partkey")).alias("table_name")
    keys = g.lineitem.select(here, fk, F.concat(F.lit("T"), "l_suppkey").alias("table_name"))
    keys = keys.unionByName(
        g.part.select(here, F.concat(F.lit("PK"), "p_partkey").alias("constraint_name"), table)
    )
    return refs.incoming_refs(g.part.select(table), links, keys, schema="S")


@CHECKS.add(
    """WITH r AS (SELECT concat('FK', l_orderkey, '_', l_linenumber) AS fk, CAST(l_linenumber % 2 AS VARCHAR) AS from_schema,
        CAST(l_orderkey % 2 AS VARCHAR) AS to_schema, concat('T', l_suppkey) AS source, l_partkey AS target FROM lineitem),
      counted AS (SELECT r.to_schema, r.target, count(*) AS n, count(DISTINCT r.fk) AS c
        FROM r JOIN r f ON f.fk = r.fk AND f.from_schema = r.from_schema
        WHERE f.source <> concat('T', r.target) OR r.from_schema <> r.to_schema GROUP BY 1, 2)
    SELECT s.name AS table_schema, concat('T', p_partkey) AS table_name, coalesce(n, 0) AS incoming_refs_count,
      coalesce(c, 0) AS n_constraints
    FROM part CROSS JOIN (SELECT '0' AS name UNION ALL SELECT '1') s
      LEFT JOIN counted ON target = p_partkey AND to_schema = s.name"""
)
def incoming_refs_schemas(g: Given) -> DataFrame:
    """Tables of the same names in two schemas; an order line refers within or across them."""
    fk = F.concat(F.lit("FK"), "l_orderkey", F.lit("_"), "l_linenumber").alias("constraint_name")
    here = (F.col("l_linenumber") % 2).cast("string").alias("constraint_schema")
    links = g.lineitem.select(
        here,
        fk,
        (F.col("l_orderkey") % 2).cast("string").alias("unique_constraint_schema"),
        F.concat(F.lit("PK"), "l_partkey").alias("unique_constraint_name"),
    )
    table = F.concat(F.lit("T"), F.col("p_partkey")).alias("table_name")
    parts = g.part.select("p_partkey", table, F.explode(F.array(F.lit("0"), F.lit("1"))).alias("table_schema"))
    primary = F.concat(F.lit("PK"), "p_partkey").alias("constraint_name")
    keys = g.lineitem.select(here, fk, F.concat(F.lit("T"), "l_suppkey").alias("table_name"))
    keys = keys.unionByName(parts.select(F.col("table_schema").alias("constraint_schema"), primary, "table_name"))
    return refs.incoming_refs(parts.select("table_schema", "table_name"), links, keys)


@CHECKS.add(
    """WITH RECURSIVE e AS (SELECT p_partkey AS src, p_partkey // 2 AS dst FROM part
        WHERE p_partkey <> p_partkey // 2),
      walk(node, layer) AS (SELECT p_partkey, 0 FROM part
        UNION SELECT e.dst, layer + 1 FROM walk JOIN e ON e.src = walk.node)
    SELECT node, max(layer) AS layer FROM walk GROUP BY node"""
)
def peel_layers(g: Given) -> DataFrame:
    """Each part references the part with half its key."""
    nodes = g.part.select(F.col("p_partkey").alias("node"))
    edges = g.part.select(F.col("p_partkey").alias("src"), F.expr("p_partkey DIV 2").alias("dst"))
    return layers.peel_layers(nodes, edges)


@CHECKS.add(
    """SELECT p_partkey * 2 AS name FROM part
    WHERE p_partkey * 2 NOT IN (SELECT l_partkey FROM lineitem)"""
)
def independent_objects(g: Given) -> DataFrame:
    listed = g.part.select((F.col("p_partkey") * 2).alias("name"))
    return refs.independent_objects(listed, g.lineitem.select(F.col("l_partkey").alias("name")), ["name"])


@CHECKS.add(
    """WITH o AS (
        SELECT 4 AS kind_order, 0 AS layer, 'TABLE' AS kind, concat('O', o_orderkey) AS name FROM orders
        UNION ALL SELECT 4, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 1 ELSE 0 END,
          'TABLE', c_name FROM customer
        UNION ALL SELECT 4, CASE WHEN n_nationkey NOT IN (SELECT c_nationkey FROM customer) THEN 0
            WHEN n_nationkey IN (SELECT c_nationkey FROM customer JOIN orders ON o_custkey = c_custkey) THEN 2
            ELSE 1 END,
          'TABLE', n_name FROM nation
        UNION ALL SELECT 3, 0, 'VIEW', s_name FROM supplier
        UNION ALL SELECT 2, 0, 'SEQUENCE', concat('P', p_partkey) FROM part)
    SELECT kind_order, layer, kind, 'main' AS schema, name,
      concat('DROP ', kind, ' "main"."', name, '" CASCADE') AS statement FROM o"""
)
def clean_plan(g: Given) -> DataFrame:
    """Tables for orders, customers and nations that reference each other."""
    order_name = F.concat(F.lit("O"), "o_orderkey")
    listed = objects.all_objects(
        {
            "TABLE": g.orders.select(order_name.alias("name"))
            .unionByName(g.customer.select(F.col("c_name").alias("name")))
            .unionByName(g.nation.select(F.col("n_name").alias("name"))),
            "VIEW": g.supplier.select(F.col("s_name").alias("name")),
            "SEQUENCE": g.part.select(F.concat(F.lit("P"), "p_partkey").alias("name")),
        }
    ).select(F.lit("main").alias("schema"), "name", "kind", F.lit(False).alias("internal"))

    def edge(df: DataFrame, src, dst) -> DataFrame:
        return df.select(
            F.concat(F.lit("main."), src).alias("src"), F.concat(F.lit("main."), dst).alias("dst")
        )

    customers = g.customer.withColumnRenamed("c_custkey", "o_custkey")
    nations = g.nation.withColumnRenamed("n_nationkey", "c_nationkey")
    edges = edge(g.orders.join(customers, "o_custkey"), order_name, F.col("c_name")).unionByName(
        edge(customers.join(nations, "c_nationkey"), F.col("c_name"), F.col("n_name"))
    )
    return layers.clean_plan(listed, edges, "duckdb")


SERVER_KIND = "CAST(c_custkey % 16 AS INT)"


def servers(g: Given) -> DataFrame:
    """A server per customer; the kind of server follows from the key."""
    host = "concat('h', c_custkey, '/db')"
    rules = [
        ("concat('jdbc:mysql://', {h})", "'MySQL'", "'5.7.25-TiDB-v6.1.0'", "'TiDB 6.1'"),
        ("concat('jdbc:mysql://', {h})", "'MySQL'", "'5.7.25'", "'OceanBase 4.2.1 (r1)'"),
        ("concat('jdbc:oceanbase://', {h})", "'OceanBase'", "'4.2'", "'OceanBase 1.3 (r2)'"),
        ("concat('jdbc:mysql://', {h})", "'MySQL'", "'8.0'", "'MySQL Community'"),
        ("concat('jdbc:postgresql://', {h})", "'PostgreSQL'", "'11.2'", "'PostgreSQL 11.2-YB-2.18.0'"),
        ("concat('jdbc:postgresql://', {h})", "'PostgreSQL'", "'12.3'", "'PostgreSQL 12.3, QuestDB'"),
        ("concat('jdbc:postgresql://', {h})", "'PostgreSQL'", "'15.1'", "'PostgreSQL 15.1'"),
        ("concat('jdbc:db2://', {h})", "'DB2'", "'DSN12015'", "''"),
        ("concat('jdbc:db2://', {h})", "'DB2/LINUX'", "'SQL11050'", "''"),
        ("concat('jdbc:clickhouse://', {h})", "'ClickHouse'", "'23.8'", "''"),
        ("concat('jdbc:cubrid:', {h})", "' CUBRID '", "'11.0'", "''"),
        ("concat('jdbc:databricks://', {h})", "'SparkSQL'", "'3.1'", "''"),
        ("concat('jdbc:duckdb:', {h})", "'DuckDB'", "'1.2'", "''"),
        ("concat('jdbc:ignite:thin://', {h})", "'Apache Ignite'", "'2.16'", "''"),
        ("concat('jdbc:IRIS://', {h})", "'InterSystems IRIS'", "concat(2015 + c_nationkey, '.1')", "''"),
        ("concat('jdbc:timeplus://', {h})", "'Timeplus'", "'2.0'", "''"),
    ]
    columns = ["url", "product", "product_version", "version_text"]
    picked = {
        c: F.expr(
            f"CASE {SERVER_KIND} "
            + " ".join(f"WHEN {i} THEN {r[n].format(h=host)}" for i, r in enumerate(rules))
            + " END"
        )
        for n, c in enumerate(columns)
    }
    return g.customer.select(F.col("c_name").alias("server"), *[e.alias(c) for c, e in picked.items()])


@CHECKS.add(
    """SELECT c_name AS server, ['tidb', 'oceanbase', 'oceanbase', 'mysql', 'yugabytedb', 'questdb',
        'postgresql', 'db2z', 'db2', 'clickhouse', 'cubrid', 'databricks', 'duckdb', 'ignite',
        CASE WHEN c_nationkey >= 4 THEN 'iris' END, 'timeplus'][CAST(c_custkey % 16 + 1 AS INTEGER)] AS dialect
    FROM customer"""
)
def detect_dialect(g: Given) -> DataFrame:
    return fleet.detect_dialect(servers(g)).select("server", "dialect")


@CHECKS.add(
    """SELECT c_name AS server, ['com.mysql.cj.jdbc.Driver', 'com.mysql.cj.jdbc.Driver',
        'com.oceanbase.jdbc.Driver', 'com.mysql.cj.jdbc.Driver', 'org.postgresql.Driver',
        'org.postgresql.Driver', 'org.postgresql.Driver', 'com.ibm.db2.jcc.DB2Driver',
        'com.ibm.db2.jcc.DB2Driver', 'com.clickhouse.jdbc.ClickHouseDriver',
        'cubrid.jdbc.driver.CUBRIDDriver', 'com.databricks.client.jdbc42.Driver', 'org.duckdb.DuckDBDriver',
        'org.apache.ignite.IgniteJdbcThinDriver', 'com.intersystems.jdbc.IRISDriver',
        'com.timeplus.jdbc.TimeplusDriver'][CAST(c_custkey % 16 + 1 AS INTEGER)] AS driver
    FROM customer"""
)
def jdbc_driver_choice(g: Given) -> DataFrame:
    return servers(g).select("server", jdbc.driver_class("url").alias("driver"))


@CHECKS.add(
    """WITH s AS (SELECT c_name AS server,
        ['tidb', 'oceanbase', 'yugabytedb', 'db2z', 'iris', 'duckdb'][CAST(c_custkey % 6 + 1 AS INTEGER)] AS dialect,
        CASE c_custkey % 6 WHEN 4 THEN 2015 + c_nationkey ELSE c_nationkey END AS major,
        c_custkey % 5 AS minor FROM customer)
    SELECT server, dialect, concat(major, '.', minor) AS version, CASE
      WHEN dialect = 'tidb' THEN CASE WHEN major < 5 THEN 'too_old'
        WHEN major > 5 OR minor > 0 THEN 'newer_than_known' ELSE 'ok' END
      WHEN dialect = 'oceanbase' THEN CASE WHEN major < 1 OR major = 1 AND minor < 4 THEN 'too_old'
        WHEN major > 5 OR major = 5 AND minor > 0 THEN 'newer_than_known' ELSE 'ok' END
      WHEN dialect = 'yugabytedb' THEN CASE WHEN major < 11 OR major = 11 AND minor < 2 THEN 'too_old' ELSE 'ok' END
      WHEN dialect = 'db2z' THEN CASE WHEN major < 12 OR major = 12 AND minor < 1 THEN 'too_old'
        WHEN major > 13 OR major = 13 AND minor > 1 THEN 'newer_than_known' ELSE 'ok' END
      WHEN dialect = 'iris' AND major < 2019 THEN 'too_old' ELSE 'ok' END AS status FROM s"""
)
def version_gate(g: Given) -> DataFrame:
    dialects = "array('tidb', 'oceanbase', 'yugabytedb', 'db2z', 'iris', 'duckdb')"
    listed = g.customer.select(
        F.col("c_name").alias("server"),
        F.expr(f"{dialects}[CAST(c_custkey % 6 AS INT)]").alias("dialect"),
        F.expr(
            "concat(CASE c_custkey % 6 WHEN 4 THEN 2015 + c_nationkey ELSE c_nationkey END, '.', c_custkey % 5)"
        ).alias("version"),
    )
    return fleet.version_gate(listed)

"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.checks.base import HIST, Checks, Given, hist, plain_time
from tidemark.functions import scalars
from tidemark.sources import scripts

CHECKS = Checks()


@CHECKS.add(
    """SELECT c_custkey, concat('`', c_mktsegment, '`.`', c_name, '\\`x`') AS backtick,
      concat('"', c_mktsegment, '"."', c_name, '`x"') AS double_quoted FROM customer"""
)
def quote_ident(g: Given) -> DataFrame:
    parts = ["c_mktsegment", F.concat("c_name", F.lit("`x"))]
    return g.customer.select(
        "c_custkey",
        scalars.quote_ident(parts, "backtick").alias("backtick"),
        scalars.quote_ident(parts, "double").alias("double_quoted"),
    )


@CHECKS.add("SELECT c_custkey, c_name AS name, c_mktsegment AS plain FROM customer")
def unquote_ident(g: Given) -> DataFrame:
    quoted = scalars.quote_ident(["c_name"], "double")
    return g.customer.select(
        "c_custkey",
        scalars.unquote_ident(quoted).alias("name"),
        scalars.unquote_ident("c_mktsegment").alias("plain"),
    )


@CHECKS.add(
    """SELECT l_orderkey, l_linenumber, l_quantity,
      concat(l_linenumber, '.', CAST(trunc(l_quantity) AS INTEGER)) AS version,
      [l_linenumber, CAST(trunc(l_quantity) AS INTEGER)] >= [3, 5] AS recent FROM lineitem"""
)
def version_key(g: Given) -> DataFrame:
    """Leading zeros, underscores and zeros at the end make no difference."""
    text = F.expr("concat('00', l_linenumber, '_0', CAST(l_quantity AS INT), '.0')")
    return g.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.array_join(scalars.version_key(text).cast("array<string>"), ".").alias("version"),
        scalars.version_at_least(text, "3.5").alias("recent"),
    )


@CHECKS.add(
    """SELECT p_partkey, CASE WHEN contains(p_name, ' ') THEN split_part(p_name, ' ', 2) END AS second_word,
      CASE WHEN p_size > 10 THEN concat('4.', p_size) END AS version FROM part"""
)
def version_from_text(g: Given) -> DataFrame:
    comment = F.when(F.col("p_size") > 10, F.concat(F.lit("OceanBase 4."), "p_size", F.lit(" (r1)")))
    return g.part.select(
        "p_partkey",
        scalars.version_from_text("p_name").alias("second_word"),
        scalars.version_from_text(comment).alias("version"),
    )


@CHECKS.add(
    """SELECT doc_id, quality = 1 AS quality, CASE WHEN toxic = 0 THEN false END AS toxic,
      toxic = 1 AS bit FROM labels"""
)
def to_bool(g: Given) -> DataFrame:
    return g.labels.select(
        "doc_id",
        scalars.to_bool(F.expr("CASE quality WHEN 1 THEN ' TRUE' ELSE '0' END"), strict=True).alias("quality"),
        scalars.to_bool(F.expr("CASE toxic WHEN 1 THEN 'yes' ELSE 'False' END")).alias("toxic"),
        scalars.to_bool("toxic").alias("bit"),
    )


@CHECKS.add(
    """SELECT p_partkey, CASE WHEN p_size > 10 THEN concat('2.', p_size, '.', p_partkey) END AS version FROM part"""
)
def version_with_build(g: Given) -> DataFrame:
    build = F.when(F.col("p_size") > 10, F.col("p_partkey"))
    version = scalars.version_with_build(F.concat(F.lit("2."), "p_size"), build)
    return g.part.select("p_partkey", version.alias("version"))


@CHECKS.add(
    """SELECT page_id, url, length(html) % 3 = 0 AS user_needed, length(html) % 3 < 2 AS password_needed FROM pages"""
)
def url_credentials(g: Given) -> DataFrame:
    url = F.expr(
        "concat(url, CASE length(html) % 3 WHEN 0 THEN '' WHEN 1 THEN '?user=a' ELSE '?user=a&password=b' END)"
    )
    return g.pages.select(
        "page_id",
        "url",
        scalars.needs_user(url).alias("user_needed"),
        scalars.needs_password(url).alias("password_needed"),
    )


@CHECKS.add("SELECT doc_id, text AS value FROM documents")
def unescape_sql_string(g: Given) -> DataFrame:
    """Quoting a text and reading it back changes nothing."""
    quoted = F.concat(F.lit("'"), F.replace("text", F.lit("'"), F.lit("''")), F.lit("'"))
    return g.documents.select("doc_id", scalars.unescape_sql_string(quoted).alias("value"))


@CHECKS.add(
    """SELECT o_orderkey, 1 AS arg_no, CAST(o_custkey AS VARCHAR) AS arg FROM orders
    UNION ALL SELECT o_orderkey, 2, concat('''a, ''''', o_orderpriority, '''') FROM orders
    UNION ALL SELECT o_orderkey, 3, o_orderstatus FROM orders
    UNION ALL SELECT o_orderkey, 4, '' FROM orders"""
)
def split_args(g: Given) -> DataFrame:
    text = F.expr("""concat(o_custkey, ", 'a, ''", o_orderpriority, "' ,  ", o_orderstatus, ",")""")
    parts = F.posexplode(scalars.split_args(text)).alias("pos", "arg")
    return g.orders.select("o_orderkey", parts).select(
        "o_orderkey", (F.col("pos") + 1).alias("arg_no"), "arg"
    )


@CHECKS.add(
    """SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'main' ELSE c_mktsegment END AS schema
    FROM customer"""
)
def or_default(g: Given) -> DataFrame:
    current = F.expr(
        "CASE c_mktsegment WHEN 'BUILDING' THEN '  ' WHEN 'MACHINERY' THEN NULL ELSE c_mktsegment END"
    )
    return g.customer.select("c_custkey", scalars.or_default(current, "main").alias("schema"))


@CHECKS.add("SELECT event_id, ts FROM events")
def iso_timestamp(g: Given) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    parsed = g.events.select("event_id", scalars.iso_timestamp(text).alias("ts"))
    return plain_time(parsed.withColumn("ts", F.to_utc_timestamp("ts", F.current_timezone())), "ts")


@CHECKS.add(
    f"""WITH {HIST} SELECT script, split_part(substr(script, 2), '__', 1) AS version,
      description FROM hist"""
)
def resolve_names(g: Given) -> DataFrame:
    named = scripts.resolve(hist(g).select("script"), "script")
    return named


@CHECKS.add(
    """SELECT c_custkey, concat('INSERT INTO main.accounts VALUES (', c_custkey, ', ''', c_name, ''') -- ', c_name) AS text
    FROM customer"""
)
def substitute_placeholders(g: Given) -> DataFrame:
    template = F.concat(
        F.lit("INSERT INTO ${schema}.accounts VALUES ("),
        F.col("c_custkey"),
        F.lit(", '${owner}') -- ${owner}"),
    )
    text = scripts.substitute(template, {"schema": "main", "owner": F.col("c_name")})
    return g.customer.select("c_custkey", text.alias("text"))


@CHECKS.add("SELECT CAST(o_orderkey AS VARCHAR) AS version FROM orders WHERE o_orderstatus = 'F'")
def changed_scripts(g: Given) -> DataFrame:
    """Scripts of finished orders were edited after they ran."""
    version = F.col("o_orderkey").cast("string").alias("version")
    ran = F.concat_ws(" ", F.lit("SELECT"), "o_orderkey", "o_custkey", "o_orderpriority")
    now = F.when(F.col("o_orderstatus") == "F", F.concat(ran, F.lit(";"))).otherwise(ran)
    recorded = g.orders.select(
        version, F.lit(True).alias("success"), scripts.script_checksum(ran).alias("checksum")
    )
    return scripts.changed_scripts(g.orders.select(version, now.alias("text")), recorded).select("version")

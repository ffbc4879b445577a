"""References between tables and between rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import save


def incoming_refs(
    tables: DataFrame, refs: DataFrame, key_cols: DataFrame, schema: str | None = None
) -> DataFrame:
    """Per table: how many references come from other tables.

    ``incoming_refs_count`` counts pairs of key columns without matching their
    positions, so a key of n columns counts n times n; ``n_constraints`` counts
    each constraint once. The pairs themselves never exist: columns are counted
    per constraint and table first, and the counts multiply.

    ``schema`` names the schema of all ``tables``. Without it they have a column
    ``table_schema``, and tables of one name in several schemas are counted
    apart. A table is in the schema of its constraints, so one of the same name
    in another schema is another table; with ``schema`` it counts as the same.
    """
    if schema is None and "table_schema" not in tables.columns:
        raise ValueError("tables of several schemas need a column table_schema")
    per_table = key_cols.groupBy("constraint_schema", "constraint_name", "table_name").agg(
        F.count("*").alias("n_cols")
    )
    target = per_table.select(
        F.col("constraint_schema").alias("unique_constraint_schema"),
        F.col("constraint_name").alias("unique_constraint_name"),
        F.col("table_name").alias("to_table"),
        F.col("n_cols").alias("to_cols"),
    )
    if schema is not None:
        target = target.filter(F.col("unique_constraint_schema") == schema)
    source = per_table.withColumnsRenamed({"table_name": "from_table", "n_cols": "from_cols"})
    other = F.col("from_table") != F.col("to_table")
    if schema is None:
        other = other | (F.col("constraint_schema") != F.col("unique_constraint_schema"))
    links = refs.groupBy(
        "constraint_schema",
        "constraint_name",
        "unique_constraint_schema",
        "unique_constraint_name",
    ).agg(F.count("*").alias("n_refs"))
    counts = (
        # Names come first: rows are sorted by them, and schemas, few, would tell hardly any apart.
        links.join(source, ["constraint_name", "constraint_schema"])
        .join(target, ["unique_constraint_name", "unique_constraint_schema"])
        .filter(other)
        .groupBy("unique_constraint_schema", "to_table", "constraint_schema", "constraint_name")
        .agg(F.sum(F.col("n_refs") * F.col("from_cols") * F.col("to_cols")).alias("pairs"))
        .groupBy(F.col("unique_constraint_schema").alias("table_schema"), F.col("to_table").alias("table_name"))
        .agg(F.sum("pairs").alias("pairs"), F.count("*").alias("constraints"))
    )
    keys = ["table_name"] if schema is not None else ["table_schema", "table_name"]
    return tables.join(counts.select(*keys, "pairs", "constraints"), keys, "left").select(
        *tables.columns,
        F.coalesce("pairs", F.lit(0)).alias("incoming_refs_count"),
        F.coalesce("constraints", F.lit(0)).alias("n_constraints"),
    )


def row_ref_counts(parent: DataFrame, child: DataFrame, pk: str, fk: str) -> DataFrame:
    """Per parent row: how many child rows reference it.

    The child is counted by key before the join, so a key with very many rows
    reaches the join as one row.
    """
    counts = child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias(pk)).agg(
        F.count("*").alias("n_refs")
    )
    return parent.join(counts, pk, "left").withColumn("n_refs", F.coalesce("n_refs", F.lit(0)))


#: Bits of one row of a bitmap, and the rows of a bitmap that may be sent to all tasks (4 KB each).
BITS, BITMAP_ROWS = 32_768, 8_192


def fk_violations(child: DataFrame, fk: str | list[str], parent: DataFrame, pk: str | list[str]) -> DataFrame:
    """Child rows whose key has no parent row.

    A key of several columns follows MATCH SIMPLE: if any part is null it refers
    to nothing and is no violation. Parts are compared in the order given.

    Only distinct key values meet the parent. The rows then join the values
    without a parent, usually few, so wide rows seldom move at all. For a key of
    one whole number there is ``fk_violations_dense``.
    """
    fks, pks = ([k] if isinstance(k, str) else list(k) for k in (fk, pk))
    if len(fks) != len(pks):
        raise ValueError("both sides of a reference have the same number of columns")
    values = child.select(*fks).dropna().distinct()
    orphans = values.join(parent.select(*(F.col(p).alias(f) for f, p in zip(fks, pks))), fks, "left_anti")
    return child.join(orphans, fks, "left_semi").select(*child.columns)


def fk_violations_dense(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """``fk_violations`` for whole numbers, by an exact bitmap of the parent's keys.

    Each task sets the bits of its keys, bits of one range are joined, and the
    bitmap is sent to the tasks that read the child, whose rows do not move. It is
    used if it has at most ``BITMAP_ROWS`` ranges with keys (32 MB); else, and so
    for keys spread far apart, the way of ``fk_violations`` is taken.
    """
    keys = parent.select(F.col(pk).cast("long").alias("k")).where("k IS NOT NULL")
    maps = keys.groupBy(F.expr("bitmap_bucket_number(k)").alias("range")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(k))").alias("bits"))
    maps = save(maps, "bitmap")
    if maps.count() > BITMAP_ROWS:
        return fk_violations(child, fk, parent, pk)
    own, mark = set(child.columns), "_"
    while {f"{mark}range", f"{mark}bits"} & own:
        mark += "_"
    maps = F.broadcast(maps.select(F.col("range").alias(f"{mark}range"), F.col("bits").alias(f"{mark}bits")))
    key = F.col(fk).cast("long")
    met = child.join(maps, F.call_function("bitmap_bucket_number", key) == F.col(f"{mark}range"), "left")
    at = F.call_function("bitmap_bit_position", key)
    byte = F.conv(F.hex(F.substring(F.col(f"{mark}bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.call_function("getbit", byte, (at % 8).cast("int")) == 1
    return met.where(F.col(fk).isNotNull() & ~F.coalesce(is_set, F.lit(False))).select(*child.columns)


def independent_objects(objects: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """Objects that nothing references; ``edges`` names the referenced ones."""
    return objects.join(edges.select(*keys).distinct(), keys, "left_anti")

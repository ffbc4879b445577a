"""Dense numbers for rows, and looking forward along them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import save

ROW_BITS = 33  # monotonically_increasing_id: task number above, row number below


def assign_sequence(
    df: DataFrame, order: list[str | Column], start: int = 1, name: str = "seq"
) -> DataFrame:
    """Number the rows densely in the given order, from ``start``.

    Rows are ranged and sorted once and written with the number of their task
    and their place in it. A running sum over one count per task turns both
    into the number. The written table keeps ranges and counts consistent when
    tasks are run again. To continue a sequence start at its maximum plus one.
    """
    spark = df.sparkSession
    key = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = (
        df.withColumn("_from", F.spark_partition_id())
        .repartitionByRange(*key, F.col("_from"))
        .sortWithinPartitions(*key)
        .drop("_from")
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = save(placed, "sequence").withColumn("_task", F.shiftrightunsigned("_place", ROW_BITS))
    # One row per task of the range shuffle: a few thousand numbers at most.
    sizes = sorted(placed.groupBy("_task").count().collect())
    offsets, total = [], start
    for task, n in sizes:
        offsets.append((task, total))
        total += n
    known = spark.createDataFrame(offsets, "_task long, _offset long")
    row = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    numbered = placed.join(F.broadcast(known), "_task")
    return numbered.withColumn(name, F.col("_offset") + row).drop("_task", "_place", "_offset")


def next_position(
    df: DataFrame, keys: list[str], pos: str, value: Column, name: str, block_bits: int = 20
) -> DataFrame:
    """Add the least non-null ``value`` of the later rows with the same keys.

    ``value`` must grow with the number ``pos``, and ``keys`` are not null. A
    key is cut into blocks of numbers: a window looks ahead inside a block, and
    one row per key and block carries the answer from the blocks after it.
    """
    marked = df.withColumns({"_value": value, "_block": F.shiftright(F.col(pos), block_bits)})
    # From the end back to the row before: such a frame only grows, so it costs
    # one step per row. One that looks ahead is computed anew for every row.
    so_far = (W.unboundedPreceding, -1)
    ahead = W.partitionBy(*keys, "_block").orderBy(F.desc(pos)).rowsBetween(*so_far)
    later = W.partitionBy(*keys).orderBy(F.desc("_block")).rowsBetween(*so_far)
    firsts = marked.groupBy(*keys, "_block").agg(F.min("_value").alias("_first"))
    carried = firsts.withColumn("_carry", F.min("_first").over(later)).drop("_first")
    return (
        marked.withColumn("_ahead", F.min("_value").over(ahead))
        .join(carried, [*keys, "_block"])
        .withColumn(name, F.coalesce("_ahead", "_carry"))
        .drop("_value", "_block", "_ahead", "_carry")
    )

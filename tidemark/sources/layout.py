"""Laying tables out in files so that later reads skip most of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.macros import holds
from tidemark.session import save


def refuse_day(df: DataFrame) -> None:
    if "day" in (c.lower() for c in df.columns):
        raise ValueError("day is the name of the partition; rename the column of this name first")


def write_day_partitioned(df: DataFrame, path: str, ts: str, mode: str = "append") -> None:
    """Time-series table: one partition per day, rows in time order in a file.

    A rebalance, not a hash repartition: the shuffle splits a day that is too
    big for one task and joins days that are too small for one file. ``day`` is
    the name of the partition, so a table with such a column is refused.
    """
    refuse_day(df)
    (
        df.withColumn("day", F.to_date(F.col(ts)))
        .hint("rebalance", F.col("day"))
        .sortWithinPartitions("day", ts)
        .write.mode(mode)
        .partitionBy("day")
        .parquet(path)
    )


def cluster_for_lookup(df: DataFrame, cols: list[str], path: str, mode: str = "append") -> None:
    """Give every file its own range of ``cols``, so lookups skip the others.

    The number of the input partition is the last part of the range key. It
    lets a value with very many rows span several files.
    """
    (
        df.withColumn("_from", F.spark_partition_id())
        .repartitionByRange(*[F.col(c) for c in cols], F.col("_from"))
        .sortWithinPartitions(*cols)
        .drop("_from")
        .write.mode(mode)
        .parquet(path)
    )


#: Bits of a rank, so 64 ranks for each column, and rows of the sample that sets their bounds.
RANK_BITS, SAMPLE_ROWS = 6, 50_000


def _bounds(df: DataFrame, cols: list[str], bits: int) -> dict[str, list]:
    """For each column the values that cut a bounded sample into equal parts; a hot value may come several times."""
    share = min(1.0, 2 * SAMPLE_ROWS / max(1, df.count()))
    sample = df.select(*cols).sample(share, seed=1).limit(SAMPLE_ROWS)
    found = {}
    for c in cols:
        part = F.ntile(1 << bits).over(Window.orderBy(c))
        ranked = sample.where(F.col(c).isNotNull()).select(c, part.alias("part")).groupBy("part").agg(F.min(c).alias("v"))
        found[c] = [r["v"] for r in ranked.where("part > 1").orderBy("part").collect()]
    return found


def _rank(value: Column, bounds: list, spread: Column) -> Column:
    """Number of bounds up to a value, by halving; bounds equal to it are shared out by ``spread``."""

    def below(low: int, high: int, or_equal: bool) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        bound = F.lit(bounds[mid])
        return F.when(value >= bound if or_equal else value > bound, below(mid + 1, high, or_equal)).otherwise(below(low, mid, or_equal))

    first, last = below(0, len(bounds), False), below(0, len(bounds), True)
    if len(set(bounds)) == len(bounds):
        return F.when(value.isNull(), 0).otherwise(last)
    return F.when(value.isNull(), 0).otherwise(first + F.pmod(spread, last - first + 1))


def curve_position(df: DataFrame, cols: list[str], bits: int = RANK_BITS) -> Column:
    """Where rows of ``df`` lie on a curve through the ranks of all ``cols``, their bits taken in turn.

    Ranks come from a bounded sample of ``SAMPLE_ROWS`` rows, so each has about as
    many rows however values are spread; a value on very many rows has several
    ranks, by a hash of the row. Nulls have the lowest rank.
    """
    bounds, spread = _bounds(df, cols, bits), F.xxhash64(*df.columns)
    ranks = [_rank(F.col(c), bounds[c], spread) for c in cols]
    position = F.lit(0).cast("long")
    for bit in range(bits):
        for k, rank in enumerate(ranks):
            position = position + F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long"), bit * len(cols) + k)
    return position


def cluster_by_curve(df: DataFrame, cols: list[str], path: str, files: int | None = None, mode: str = "append", bits: int = RANK_BITS) -> None:
    """Give every file its own piece of a curve through all ``cols``, so a lookup by any of them skips most files.

    With n files a narrow range of one of two columns meets about the square root
    of n. The hash of the row is the last part of the range key, so that a piece
    with very many rows spans several files. Rows are sorted by the curve in a
    file, which narrows the ranges of its row groups too.
    """
    place, row = "_place", "_row"
    while {place, row} & set(df.columns):
        place, row = f"_{place}", f"_{row}"
    placed = df.withColumns({place: curve_position(df, cols, bits), row: F.xxhash64(*df.columns)})
    dealt = placed.repartitionByRange(*([files] if files else []), F.col(place), F.col(row))
    dealt.sortWithinPartitions(place, row).drop(place, row).write.mode(mode).parquet(path)


def expire_days(spark: SparkSession, path: str, match: Column, ts: str, cutoff: Column) -> list[str]:
    """Drop matching rows older than the cutoff from a table of ``write_day_partitioned``; returns the days rewritten.

    Days after that of the cutoff are not read. Of the others those that hold such
    a row are found by reading the columns of the condition, and only they are
    written again, by dynamic partition overwrite; a day left without rows is
    removed. Files of all other days stay as they are, so a second call changes
    nothing. Rows for which the condition is unknown stay. The rows that stay are
    first written to the shared folder: if the job is lost, call it again.
    """
    old = spark.read.parquet(path).where(F.col("day") <= F.to_date(cutoff))
    gone = holds(match & (F.col(ts) < cutoff))
    days = save(old.where(gone).select("day").distinct(), "days")
    touched = [r["day"] for r in days.orderBy("day").collect()]  # one row for each day of the table at most
    if not touched:
        return []
    kept = save(old.where(F.col("day").isin(touched)).where(~gone), "kept")
    left = {r["day"] for r in kept.select("day").distinct().collect()}
    writer = kept.hint("rebalance", F.col("day")).sortWithinPartitions("day", ts).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    jvm = spark._jvm
    for day in touched:
        if day not in left:
            folder = jvm.org.apache.hadoop.fs.Path(f"{path}/day={day}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return [str(day) for day in touched]

"""Comparing large tables by digests of their rows, so that few rows move."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import save

#: Buckets of each level; each is a multiple of the one before.
LEVELS = (1 << 12, 1 << 16, 1 << 20)
#: Share of a level's buckets up to which their rows are few enough to be compared themselves.
FEW = 0.01


def _bits(columns: list[str], seed: int) -> Column:
    """A 64-bit hash of a row. Hashes pass over nulls, so which columns are null is hashed as well."""
    return F.xxhash64(F.lit(seed), *(F.col(c) for c in columns), F.array(*(F.col(c).isNull() for c in columns)))


def _names(columns: list[str]) -> tuple[str, ...]:
    """Names for own columns that the tables do not have."""
    mark = "_" * (1 + max((len(c) - len(c.lstrip("_")) for c in columns), default=0))
    return tuple(f"{mark}{name}" for name in ("side", "bucket"))


def differing_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """The rows of both tables, with their side 1 or -1, in buckets whose digests differ.

    The last column is the side. A bucket's digest is its number of rows and the
    sums of both halves of a second 64-bit hash, so the order of rows does not
    matter and repeats count. Tasks send a row for each bucket, not for each row.
    Levels of finer buckets follow while many buckets differ; of these only the
    parts of buckets that differed before are summed. All rows that differ are
    returned unless their bucket's sums agree by chance, about once in 2**64
    differing buckets. Equal rows may come along; the caller compares exactly.
    """
    columns = a.columns
    side, bucket = _names(columns)
    both = a.withColumn(side, F.lit(1)).unionByName(b.withColumn(side, F.lit(-1)))
    place, value = _bits(columns, 1), _bits(columns, 2)
    found, before = None, 0
    for level in LEVELS:
        narrowed = both.withColumn(bucket, place.bitwiseAND(F.lit(level - 1)))
        if found is not None:
            narrowed = _within(narrowed, found, bucket, before)
        sign = F.col(side).cast("long")
        sums = narrowed.groupBy(bucket).agg(
            F.sum(sign).alias("rows"),
            F.sum(sign * F.shiftrightunsigned(value, 32)).alias("high"),
            F.sum(sign * value.bitwiseAND(F.lit((1 << 32) - 1))).alias("low"),
        )
        found = save(sums.where("rows <> 0 OR high <> 0 OR low <> 0").select(bucket), "differing")
        before = level
        if found.count() <= FEW * level:
            break
    rows = _within(both.withColumn(bucket, place.bitwiseAND(F.lit(before - 1))), found, bucket, before)
    return rows.select(*columns, side)


def _within(rows: DataFrame, found: DataFrame, bucket: str, level: int) -> DataFrame:
    """Rows whose bucket of an earlier level differed; at most ``LEVELS[-1]`` numbers are sent to the tasks."""
    key = F.col(bucket).bitwiseAND(F.lit(level - 1))
    return rows.join(F.broadcast(found.withColumnRenamed(bucket, f"{bucket}_")), key == F.col(f"{bucket}_"), "left_semi")


def same_digests(a: DataFrame, b: DataFrame) -> bool:
    """Whether both tables hold the same rows equally often, by digests alone."""
    return differing_rows(a, b).isEmpty()

"""Outcomes per call, holders per key, first rows, and table comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.digests import differing_rows

from tidemark.functions.macros import holds

# Texts that mark a failed utility run in its last message, and
# the first line of the error built from all its messages.
FAILURE_TEXTS = [
    "DSNUGBAC - UTILITY EXECUTION TERMINATED, HIGHEST RETURN CODE=",
    "DSNUGBAC - UTILITY BATCH MEMORY EXECUTION ABENDED",
]
FAILURE_HEADING = "DSNUTILU TERMINATED WITH OUTPUT:"


def call_verdicts(results: DataFrame, failure_texts: list[str] | None = None) -> DataFrame:
    """Per call: number of messages, and whether the last one tells of failure."""
    last = F.max_by("message", "row_no")
    failed = F.lit(False)
    for text in FAILURE_TEXTS if failure_texts is None else failure_texts:
        failed = failed | holds(F.contains(F.col("last_message"), F.lit(text)))
    return (
        results.groupBy("call_id")
        .agg(F.count("*").alias("n_messages"), last.alias("last_message"))
        .withColumn("failed", failed)
    )


def failed_messages(results: DataFrame, failure_texts: list[str] | None = None) -> DataFrame:
    """All messages of the failed calls, as rows; fits a call of any length."""
    failed = call_verdicts(results, failure_texts).filter("failed").select("call_id")
    return results.join(failed, "call_id", "left_semi")


def call_outcome(
    results: DataFrame, failure_texts: list[str] | None = None, heading: str = FAILURE_HEADING
) -> DataFrame:
    """Per call: does it count as failed, and if so the error text.

    The text is a heading and every message in row order, a line each. Only
    rows of failed calls are collected for it. One text is one string; for a
    call with more output than a string holds read ``failed_messages``.
    """
    verdicts = call_verdicts(results, failure_texts)
    lines = F.array_sort(F.collect_list(F.struct("row_no", F.coalesce("message", F.lit("")).alias("m"))))
    body = F.array_join(F.transform(lines, lambda r: F.concat(r["m"], F.lit("\n"))), "")
    texts = (
        failed_messages(results, failure_texts)
        .groupBy("call_id")
        .agg(F.concat(F.lit(heading + "\n"), body).alias("error_text"))
    )
    return verdicts.drop("last_message").join(texts, "call_id", "left")


def competing_holders(df: DataFrame, key: list[str], owner: str) -> DataFrame:
    """Keys held by more than one owner."""
    return (
        df.groupBy(*key).agg(F.count_distinct(owner).alias("n_holders")).filter("n_holders > 1")
    )


def first_per_group(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """First row of each group by a unique order, chosen per task before the shuffle."""
    row = F.min_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(*key).agg(row.alias("_row")).select("_row.*")


def table_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows with different counts in two tables, with the side that has more.

    Digests of buckets of rows are compared first (``operators.digests``, which
    states the chance of a miss). Only rows of buckets that differ move; they are
    counted over all columns, so every row returned differs. Both tables are read
    up to four times.
    """
    columns = a.columns
    rows = differing_rows(a, b)
    side = rows.columns[-1]
    surplus = rows.groupBy(*columns).agg(F.sum(side).alias(side)).filter(F.col(side) != 0)
    return surplus.select(
        *columns,
        F.when(F.col(side) > 0, "left").otherwise("right").alias("side"),
        F.abs(side).alias("n_rows"),
    )


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Both tables hold the same rows equally often."""
    return table_diff(a, b).isEmpty()


def same_set(a: DataFrame, b: DataFrame) -> bool:
    """Both tables hold the same rows, however often."""
    return table_diff(a.distinct(), b.distinct()).isEmpty()

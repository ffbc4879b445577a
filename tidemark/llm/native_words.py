"""Words and shingles with built-in functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a narrow table that may be broadcast: about 64 MB in each executor.
BROADCAST_ROWS = 1_000_000


def words(text: Column | str) -> Column:
    """Runs without white space, lower-cased in A-Z; null has none."""
    low = F.translate(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(low, r"[\x20\x09-\x0D]+"), "")


def shingles(words: str, width: int) -> Column:
    """The distinct runs of ``width`` words of an array column, or the whole sequence if it is shorter."""
    return F.expr(
        f"""CASE WHEN size({words}) >= {width}
            THEN array_distinct(transform(sequence(1, size({words}) - {width - 1}), i -> array_join(slice({words}, i, {width}), ' ')))
            WHEN size({words}) > 0 THEN array(array_join({words}, ' ')) ELSE array() END"""
    )


def digest() -> Column:
    """The digest of ``text`` by which rows that repeat a doc_id are told apart; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))


def spare(docs: DataFrame, *names: str) -> list[str]:
    """The names with as many underscores before them as it takes for none to be a column of ``docs``."""
    taken, lead = {c.lower() for c in docs.columns}, "_"
    while any(lead + name in taken for name in names):
        lead += "_"
    return [lead + name for name in names]


def bounded(table: DataFrame, rows: int) -> DataFrame:
    """A hint to broadcast ``table`` if its ``rows``, counted before, are few enough; else it is shuffled."""
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table

"""Where intermediate tables live."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Where it names none, a single-machine session uses a folder of its warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_folder(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def save(df: DataFrame, label: str, group: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    This cuts the lineage, so a lost executor costs one re-read and not the
    whole history of an iterative job, and it gives the planner true sizes.
    ``group`` is the number of rows of a row group, of which a reader holds all.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**({"parquet.block.row.count.limit": group} if group else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int, size: int) -> Iterator[None]:
    """Python tasks of tables written meanwhile get batches of ``rows`` rows and about ``size`` bytes at most.

    An executor holds a batch several times, in its own memory and that of the
    Python worker. What the session had set comes back at the end.
    """
    names = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)

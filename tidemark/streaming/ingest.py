"""Appending a stream to a table with one partition per day."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.layout import refuse_day, write_day_partitioned


def append_new(batch: DataFrame, path: str, ts: str, keys: list[str]) -> None:
    """Append the rows of a batch whose keys are not yet in their day of the table.

    Only the days of the batch are read, and of them only the keys. A batch that
    comes again adds nothing.
    """
    rows = batch.withColumn("day", F.to_date(F.col(ts))).dropDuplicates([*keys, "day"])
    try:
        old = batch.sparkSession.read.schema(rows.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        days = rows.select("day").distinct()
        held = old.select(*keys, "day").join(days, "day", "left_semi")
        same = [rows[c].eqNullSafe(held[c]) for c in [*keys, "day"]]
        rows = rows.join(held, same, "left_anti")
    write_day_partitioned(rows.drop("day"), path, ts)


#: Where streams keep their state: on the disk of the executors, with changes in the checkpoint.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _to_days(stream: DataFrame, path: str, checkpoint: str, ts: str) -> StreamingQuery:
    return (
        stream.withColumns({"day": F.to_date(F.col(ts)), "_share": F.spark_partition_id()})
        .repartition("day", "_share")
        .drop("_share")
        .writeStream.format("parquet")
        .partitionBy("day")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )


def ingest_stream(
    stream: DataFrame, path: str, checkpoint: str, ts: str, keys: list[str] | None = None, lag: str | None = None
) -> StreamingQuery:
    """Append a stream into day partitions until the source has no more.

    Rows land in the partition of their own day in whatever order they come, and
    late rows are kept. As many tasks share a big day as the batch has partitions.

    With ``keys`` and no ``lag`` a row goes if its day has its key already, from
    this batch or an earlier one; the keys of these days are read, no state is held.

    With ``keys`` and a ``lag`` (``"600 seconds"``) keys are held as state from
    their event time to the lag after it, so state follows the rate of rows and
    not the size of the table. A row whose key is held goes. A row older than the
    newest time seen less the lag is late: its key may be forgotten, so it goes as
    well, and nothing is added twice. Keep such rows by a second stream without
    keys, the raw table; ``late_rows`` tells them. Which of the repeats in one
    batch stays is open. The state is in RocksDB, and its number of partitions is
    that of the shuffle at the first start.
    """
    refuse_day(stream)
    if lag is not None:
        if not keys:
            raise ValueError("a lag needs keys")
        conf = stream.sparkSession.conf
        before = conf.get(PROVIDER)
        conf.set(PROVIDER, ROCKSDB)  # read when the query starts, and from its checkpoint later on
        try:
            kind = stream.schema[ts].dataType  # a watermark needs a timestamp with a zone
            timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lag).dropDuplicatesWithinWatermark(keys)
            return _to_days(timed.withColumn(ts, F.col(ts).cast(kind)), path, checkpoint, ts)
        finally:
            conf.set(PROVIDER, before)
    if keys is not None:
        writer = stream.writeStream.foreachBatch(lambda batch, _: append_new(batch, path, ts, keys))
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    return _to_days(stream, path, checkpoint, ts)


def late_rows(raw: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the raw table whose key never reached the table kept with a lag."""
    same = [raw[k].eqNullSafe(kept[k]) for k in keys]
    return raw.join(kept.select(*keys), same, "left_anti")

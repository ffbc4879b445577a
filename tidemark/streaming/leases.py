"""Leases over a stream of refreshes or requests."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.leases import MICROS, as_sessions, merge_spans, span_slices

MERGE_FIRST = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def lease_sessions_stream(
    stream: DataFrame, key: str, ts: str, ttl_seconds: int, lag: str = "10 minutes"
) -> DataFrame:
    """Spans per key as they close, in append mode.

    A span is emitted once the watermark has passed its end; the last open
    spans stay in state.
    """
    # Refreshes join up in their task first, so a busy key moves as few rows.
    stream.sparkSession.conf.set(MERGE_FIRST, "true")
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lag)
    span = F.session_window(ts, f"{ttl_seconds} seconds")
    return (
        timed.groupBy(key, span.alias("span"))
        .agg(F.count("*").alias("n_refreshes"))
        .select(
            key,
            F.col("span.start").alias("session_start"),
            F.col("span.end").alias("session_end"),
            "n_refreshes",
        )
    )


def keep_sessions(stream: DataFrame, root: str, checkpoint: str, key: str, ts: str, ttl_seconds: int, **options: str) -> StreamingQuery:
    """Keep the spans of all refreshes of a stream in a table, however late they come.

    Batch i writes one folder: its own spans merged with those of the batches
    before it that the lowest set bit of i covers (of batch 12: 9 to 12). So a
    span is written again about log2(batches) times, all spans so far lie in at
    most that many folders, and a batch that is repeated after a failure replaces
    its own folder only. Streams with checkpoints of their own may share a root.
    ``options`` go to the trigger; without any the stream ends with its source.
    """
    home = f"{root}/stream=of-{hashlib.md5(checkpoint.encode()).hexdigest()}"

    def merge(batch: DataFrame, number: int) -> None:
        last = number + 1
        parts = _covering(last - 1, last - (last & -last))
        spans = span_slices(batch, key, ts, ttl_seconds)
        if parts:
            older = batch.sparkSession.read.schema(spans.schema).parquet(*[f"{home}/batch={n}" for n in parts])
            spans = spans.unionByName(older)
        merge_spans(spans, key, ttl_seconds).write.mode("overwrite").parquet(f"{home}/batch={last}")

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(**(options or {"availableNow": True})).start()


def _covering(last: int, first: int = 0) -> list[int]:
    """Folders that hold the batches after ``first`` up to ``last``, each once."""
    folders = []
    while last > first:
        folders.append(last)
        last -= last & -last
    return folders


def read_sessions(spark: SparkSession, root: str, key: str, ttl_seconds: int, lag_seconds: int = 0) -> DataFrame:
    """Spans kept by ``keep_sessions``, with a flag for those that may still grow.

    A span is open if a refresh no more than the lag older than the newest one
    seen could extend it. Later ones extend or join spans all the same. To be read
    between batches; only numbers of batches and one time come to the driver.
    """
    stored = spark.read.parquet(root)
    last = stored.groupBy("stream").agg(F.max("batch").alias("batch"), F.max("e").alias("e")).collect()
    whole = F.lit(False)
    for row in last:
        whole |= (F.col("stream") == row.stream) & F.col("batch").isin(_covering(row.batch))
    spans = merge_spans(stored.filter(whole).select(key, "s", "e", "n"), key, ttl_seconds)
    since = max((row.e for row in last), default=0) - (lag_seconds + ttl_seconds) * MICROS
    return as_sessions(spans.withColumn("is_open", F.col("e") >= since), key, ttl_seconds, "is_open")


def lease_grants_stream(
    stream: DataFrame,
    key: str,
    holder: str,
    ts: str,
    ttl_seconds: int,
    order: str,
    release: str = "release",
) -> DataFrame:
    """Granted requests of a stream; the state of a key is one small row.

    Rules as in ``operators.leases.lease_grants``. Rows of one trigger are put
    in time order; rows of a later trigger come later whatever their time.
    """
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    ttl = ttl_seconds * 1_000_000
    rows = stream.select(
        F.col(key),
        F.col(holder),
        F.col(order),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("at"),
        F.col(release).alias("is_release"),
    ).filter(F.col(key).isNotNull() & F.col(holder).isNotNull())
    holder_type = rows.schema[holder].dataType
    output = T.StructType([f for f in rows.schema if f.name != "is_release"])
    state = T.StructType([T.StructField("owner", holder_type), T.StructField("since", T.LongType())])

    class Grants(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.lease = handle.getValueState("lease", state)

        def handleInputRows(self, key, rows, timerValues):
            import pandas as pd

            owner, since = self.lease.get() if self.lease.exists() else (None, 0)
            batch = pd.concat(list(rows)).sort_values(["at", order], kind="stable")
            granted = []
            for who, at, is_release in zip(batch[holder], batch["at"], batch["is_release"]):
                won = not is_release and (owner is None or at - since > ttl)
                if won:
                    owner, since = who, at
                elif is_release and owner == who:
                    owner = None
                granted.append(won)
            if owner is None:
                self.lease.clear()
            else:
                self.lease.update((owner, since))
            yield batch[granted].drop(columns="is_release")

        def close(self) -> None:
            pass

    grants = rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=Grants(), outputStructType=output, outputMode="append", timeMode="none"
    )
    return grants.select(key, holder, order, F.timestamp_micros("at").alias("granted_at"))

"""A history kept from a stream of inserts, updates and deletes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.macros import holds
from tidemark.operators.history import HISTORY_COLUMNS, HISTORY_SCHEMA
from tidemark.operators.sequences import next_position
from tidemark.plans.snapshots import Table, read_or_empty, read_snapshot, write_snapshot
from tidemark.session import save

COMMITS = T.StructType().add("batch", T.LongType())
EDITED = ["description", "type", "checksum"]


def apply_mutations(state: DataFrame, mutations: DataFrame) -> DataFrame:
    """The history after a set of mutations, each applied in the order of ``seq``.

    ``op`` is ``insert`` (ten columns; ignored if the rank exists), ``update``
    (sets description, type and checksum of a rank) or ``delete_failed`` (drops
    failed rows of a version, or of a description if the version is null).

    Mutations are resolved together. The last update of a rank wins. A row is
    dropped by a later delete of its version, or by a delete of a description
    that comes while the row has it.
    """
    rank = "installed_rank"
    old = state.select(*HISTORY_COLUMNS, F.lit(-1).cast("long").alias("seq"))
    new = mutations.filter("op = 'insert'").select(*HISTORY_COLUMNS, "seq")
    new = new.groupBy(rank).agg(F.min_by(F.struct(*new.columns), "seq").alias("r")).select("r.*")
    rows = save(old.unionByName(new.join(old.select(rank), rank, "left_anti")), "mutations")

    # Every state a row goes through: as inserted, and after each update.
    begun = rows.select(rank, "success", F.col("seq").alias("begin"))
    first = rows.select(rank, "seq", *EDITED)
    updates = mutations.filter("op = 'update'").select(rank, "seq", *EDITED)
    states = first.unionByName(updates).join(begun, rank).filter("seq >= begin")
    states = save(states, "mutations")
    latest = states.groupBy(rank).agg(F.max_by(F.struct(*EDITED), "seq").alias("now"))

    deletes = mutations.filter("op = 'delete_failed'")
    by_version = (
        deletes.filter("version IS NOT NULL").groupBy("version").agg(F.max("seq").alias("deleted"))
    )
    by_text = deletes.filter("version IS NULL").select("description", "seq", F.lit(True).alias("kills"))
    until = next_position(states, [rank], "seq", F.col("seq"), "until").filter(~F.col("success"))
    timeline = until.select(rank, "description", "seq", "until").unionByName(
        by_text, allowMissingColumns=True
    )
    timeline = next_position(
        timeline, ["description"], "seq", F.when(F.col("kills"), F.col("seq")), "deleted"
    )
    hit = holds(F.col("deleted") < F.coalesce("until", F.lit(2**63 - 1)))
    dead = timeline.filter(F.col(rank).isNotNull() & hit).select(rank).distinct()

    kept = (
        rows.join(by_version, "version", "left")
        .filter(~holds(~F.col("success") & (F.col("deleted") > F.col("seq"))))
        .join(dead, rank, "left_anti")
        .join(latest, rank)
    )
    return kept.select(
        *[F.col(f"now.{c}").alias(c) if c in EDITED else F.col(c) for c in HISTORY_COLUMNS]
    )


def read_state(spark: SparkSession, root: str) -> tuple[int, DataFrame]:
    """Number of the last committed batch, and the history after it."""
    batch = read_or_empty(spark, f"{root}/commits", COMMITS).agg(F.max("batch")).first()[0]
    if batch is None:
        return -1, spark.createDataFrame([], HISTORY_SCHEMA)
    return batch, read_snapshot(spark, root, batch)["history"].rows


def stream_mutations(stream: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Keep the history below ``root`` up to date with a stream of mutations.

    A trigger writes the next snapshot and then commits its number, so a batch
    that runs twice has the effect of one. The whole history is rewritten per
    trigger: take large triggers for a large history.
    """

    def advance(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        done, state = read_state(spark, root)
        if number <= done:
            return
        # The batch feeds several joins; computed once, it can be computed again.
        after = apply_mutations(state, batch.persist())
        write_snapshot(spark, root, number, {"history": Table(after)})
        spark.createDataFrame([(number,)], COMMITS).coalesce(1).write.mode("append").parquet(
            f"{root}/commits"
        )
        batch.unpersist()

    return (
        stream.writeStream.foreachBatch(advance)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

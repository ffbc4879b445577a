"""Streams over the events, run until the source has no more."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.checks.base import HIST, HIST_COLUMNS, Checks, Given, hist, plain_time
from tidemark.operators import leases
from tidemark.session import scratch_path
from tidemark.streaming.ingest import ingest_stream as ingest
from tidemark.streaming.leases import keep_sessions, read_sessions
from tidemark.streaming.leases import lease_grants_stream as grants_of_stream
from tidemark.streaming.leases import lease_sessions_stream as sessions_of_stream
from tidemark.streaming.mutations import read_state
from tidemark.streaming.mutations import stream_mutations as mutate

CHECKS = Checks()
TTL = 6 * 3600


def event_stream(g: Given) -> DataFrame:
    # A pattern, since the table may be one file or a folder of files.
    return g.spark.readStream.schema(g.events.schema).parquet(f"{g.folder}/events.parquet*")


def drained(g: Given, stream: DataFrame, label: str) -> DataFrame:
    """Everything an append stream emits, as a table."""
    path = scratch_path(g.spark, label)
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", scratch_path(g.spark, f"{label}-state"))
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return g.spark.read.schema(stream.schema).parquet(path)


@CHECKS.add("SELECT CAST(ts AS DATE) AS day, count(*) AS n_events FROM events GROUP BY 1")
def ingest_stream(g: Given) -> DataFrame:
    path = scratch_path(g.spark, "ingest")
    ingest(event_stream(g), path, scratch_path(g.spark, "ingest-state"), "ts").awaitTermination()
    return g.spark.read.parquet(path).groupBy("day").agg(F.count("*").alias("n_events"))


@CHECKS.add("SELECT event_id, user_id, event_type, ts, CAST(ts AS DATE) AS day FROM events")
def ingest_stream_lag(g: Given) -> DataFrame:
    """Every third event is delivered twice, in a batch of its own or in one with others; each stays once."""
    twice = F.explode(F.when(F.col("event_id") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("delivery")
    events = event_stream(g).select("event_id", "user_id", "event_type", "ts", twice)
    path, state = scratch_path(g.spark, "lagged"), scratch_path(g.spark, "lagged-state")
    for _ in range(2):  # the second start finds nothing new
        ingest(events, path, state, "ts", keys=["event_id"], lag="600 seconds").awaitTermination()
    kept = g.spark.read.parquet(path).select("event_id", "user_id", "event_type", "ts", "day")
    return plain_time(kept, "ts")


SESSIONS = f"""WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events),
  s AS (SELECT user_id, ts, sum(CASE WHEN before IS NULL OR ts > before + INTERVAL {TTL} SECOND THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM e)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL {TTL} SECOND AS session_end,
  count(*) AS n_refreshes FROM s GROUP BY user_id, n"""


@CHECKS.add(SESSIONS)
def lease_sessions(g: Given) -> DataFrame:
    spans = leases.lease_sessions(g.events, "user_id", "ts", TTL)
    return plain_time(spans, "session_start", "session_end")


@CHECKS.add(
    f"""WITH w AS ({SESSIONS})
    SELECT * FROM w WHERE session_end <= (SELECT max(ts) - INTERVAL 600 SECOND FROM events)"""
)
def lease_sessions_stream(g: Given) -> DataFrame:
    """Spans that have closed; open ones stay in state."""
    spans = sessions_of_stream(event_stream(g), "user_id", "ts", TTL)
    return plain_time(drained(g, spans, "sessions"), "session_start", "session_end")


@CHECKS.add(SESSIONS)
def lease_sessions_kept(g: Given) -> DataFrame:
    """All spans, open ones too; a second stream brings every third event late and joins spans."""
    root = scratch_path(g.spark, "kept")
    for late in (False, True):
        events = event_stream(g).filter((F.col("event_id") % 3 == 0) == late)
        keep_sessions(events, root, scratch_path(g.spark, "kept-state"), "user_id", "ts", TTL).awaitTermination()
    spans = read_sessions(g.spark, root, "user_id", TTL).drop("is_open")
    return plain_time(spans, "session_start", "session_end")


def requests(df: DataFrame) -> DataFrame:
    """Events as lease requests for 64 keys; a purchase is a release."""
    return df.select(
        (F.col("event_id") % 64).alias("lease"),
        "user_id",
        "ts",
        "event_id",
        (F.col("event_type") == "purchase").alias("release"),
    )


GRANTS = f"""WITH RECURSIVE ev AS (
    SELECT event_id % 64 AS lease, user_id, event_id, ts, event_type = 'purchase' AS release FROM events),
  freed AS (
    SELECT e.event_id, min(r.ts) AS at FROM ev e JOIN ev r
      ON r.lease = e.lease AND r.user_id = e.user_id AND r.release AND r.ts > e.ts
    WHERE NOT e.release GROUP BY 1),
  link AS (
    SELECT e.event_id, min(n.ts) AS next_ts FROM ev e JOIN ev n
      ON n.lease = e.lease AND NOT n.release AND n.ts > e.ts LEFT JOIN freed f ON f.event_id = e.event_id
    WHERE NOT e.release AND (n.ts > e.ts + INTERVAL {TTL} SECOND OR n.ts > f.at) GROUP BY 1),
  first_asked AS (SELECT lease, min(ts) AS ts FROM ev WHERE NOT release GROUP BY 1),
  chain(event_id) AS (
    SELECT e.event_id FROM ev e JOIN first_asked f ON f.lease = e.lease AND f.ts = e.ts
    UNION ALL
    SELECT n.event_id FROM chain c JOIN link l ON l.event_id = c.event_id
      JOIN ev p ON p.event_id = c.event_id JOIN ev n ON n.lease = p.lease AND n.ts = l.next_ts)
SELECT lease, user_id, event_id, ts AS granted_at FROM ev WHERE event_id IN (SELECT event_id FROM chain)"""


@CHECKS.add(GRANTS)
def lease_grants(g: Given) -> DataFrame:
    granted = leases.lease_grants(requests(g.events), "lease", "user_id", "ts", TTL, "event_id")
    return plain_time(granted, "granted_at")


@CHECKS.add(GRANTS)
def lease_grants_jumps(g: Given) -> DataFrame:
    """Kept under its former name: every key is solved by joins now."""
    granted = leases.lease_grants(
        requests(g.events), "lease", "user_id", "ts", TTL, "event_id"
    )
    return plain_time(granted, "granted_at")


@CHECKS.add(GRANTS)
def lease_grants_stream(g: Given) -> DataFrame:
    granted = grants_of_stream(requests(event_stream(g)), "lease", "user_id", "ts", TTL, "event_id")
    return plain_time(drained(g, granted, "grants"), "granted_at")


def mutations(events: Given) -> DataFrame:
    """Each event inserts a row; a click also edits an earlier row, a purchase
    deletes failed rows of its version, or of a description if it has none."""
    rows = hist(events)
    number = (F.col("installed_rank") - 1).cast("long") * 3
    insert = F.struct(F.lit("insert").alias("op"), number.alias("seq"), *rows.columns)

    def other(op: str, place: int, **values: Column) -> Column:
        kept = ["script", "installed_by", "installed_on", "execution_time", "success"]
        fields = {c: values.get(c, F.col(c) if c in kept else F.lit(None)) for c in rows.columns}
        return F.struct(
            F.lit(op).alias("op"),
            (number + place).alias("seq"),
            *[v.cast(rows.schema[c].dataType).alias(c) for c, v in fields.items()],
        )

    edit = other(
        "update",
        1,
        installed_rank=F.shiftright(F.col("installed_rank") - 1, 1) + 1,
        description=F.lit("clicked"),
        type=F.lit("SQL"),
        checksum=F.col("installed_rank"),
    )
    text = F.when(F.col("version").isNull(), "error")
    remove = other("delete_failed", 2, version=F.col("version"), description=text)
    ops = F.array_compact(
        F.array(
            insert,
            F.when(F.col("description") == "click", edit),
            F.when(F.col("description") == "purchase", remove),
        )
    )
    return rows.select(F.explode(ops).alias("m")).select("m.*")


@CHECKS.add(
    f"""WITH {HIST},
      i AS (SELECT *, CAST(installed_rank - 1 AS BIGINT) * 3 AS seq FROM hist),
      u AS (SELECT (installed_rank - 1) // 2 + 1 AS r, seq + 1 AS seq, installed_rank AS checksum
        FROM i WHERE description = 'click'),
      last_u AS (SELECT r, arg_max(checksum, seq) AS new_checksum, min(seq) AS first_seq FROM u GROUP BY r),
      dv AS (SELECT version, max(seq + 2) AS at FROM i WHERE description = 'purchase' AND version IS NOT NULL GROUP BY 1),
      dd AS (SELECT seq + 2 AS at FROM i WHERE description = 'purchase' AND version IS NULL),
      j AS (SELECT i.*, new_checksum, first_seq, dv.at AS version_at FROM i
        LEFT JOIN last_u ON r = installed_rank LEFT JOIN dv ON dv.version = i.version)
    SELECT installed_rank, version, CASE WHEN first_seq IS NULL THEN description ELSE 'clicked' END AS description,
      CASE WHEN first_seq IS NULL THEN type ELSE 'SQL' END AS type, script,
      CASE WHEN first_seq IS NULL THEN checksum ELSE new_checksum END AS checksum,
      installed_by, installed_on, execution_time, success
    FROM j WHERE success OR NOT (coalesce(version_at > seq, false)
      OR EXISTS (SELECT 1 FROM dd WHERE dd.at > j.seq AND dd.at < coalesce(j.first_seq, 9223372036854775807)))"""
)
def stream_mutations(g: Given) -> DataFrame:
    root = scratch_path(g.spark, "mutations")

    class Streamed(Given):
        events = event_stream(g)

    stream = mutations(Streamed(g.spark, g.folder))
    mutate(stream, root, scratch_path(g.spark, "mutations-state")).awaitTermination()
    return plain_time(read_state(g.spark, root)[1].select(*HIST_COLUMNS.split(", ")), "installed_on")

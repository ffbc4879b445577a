"""The history table: layouts, edits, order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.checks.base import HIST, HIST_COLUMNS, Checks, Given, hist, plain_time
from tidemark.operators import groups, history
from tidemark.session import scratch_path
from tidemark.sources import layout

CHECKS = Checks()
BOUND = ", ".join(history.BOUND_COLUMNS)


@CHECKS.add(
    f"""WITH {HIST} SELECT {HIST_COLUMNS},
      CASE WHEN execution_time < 300 THEN 'bit' WHEN execution_time < 600 THEN 'text' ELSE 'bool' END AS server
    FROM hist"""
)
def unify_histories(g: Given) -> DataFrame:
    """Three servers, with success as a bit, as text and as a boolean."""
    h = hist(g)
    ok = F.col("success")
    servers = {
        "bit": h.filter("execution_time < 300").withColumn("success", ok.cast("int")),
        "text": h.filter("execution_time BETWEEN 300 AND 599").withColumn(
            "success", F.upper(ok.cast("string"))
        ),
        "bool": h.filter("execution_time >= 600").select(*reversed(h.columns)),
    }
    return plain_time(history.unify_histories(servers), "installed_on")


@CHECKS.add(f"WITH {HIST} SELECT {HIST_COLUMNS}, concat('s', installed_rank % 12) AS server FROM hist")
def unify_history_files(g: Given) -> DataFrame:
    """Twelve servers in three layouts, each in a folder of its own."""
    h, root = hist(g).withColumn("server", F.concat(F.lit("s"), F.col("installed_rank") % 12)), scratch_path(g.spark, "servers")
    ok = F.col("success")
    layouts = [ok, ok.cast("int"), F.upper(ok.cast("string"))]
    for k, success in enumerate(layouts):
        rows = h.where(F.col("installed_rank") % 3 == k).withColumn("success", success)
        rows.write.partitionBy("server").mode("append").parquet(f"{root}/{k}")
    paths = {f"s{n}": f"{root}/{n % 3}/server=s{n}" for n in range(12)}
    return plain_time(history.unify_history_files(g.spark, paths), "installed_on")


@CHECKS.add(f"WITH {HIST} SELECT {BOUND} FROM hist")
def append_history(g: Given) -> DataFrame:
    path = scratch_path(g.spark, "history")
    history.append_history(hist(g), path)
    return g.spark.read.schema(history.HISTORY_SCHEMA).parquet(path).drop("installed_on")


@CHECKS.add(f"WITH {HIST} SELECT {HIST_COLUMNS} FROM hist WHERE installed_rank > 500 AND type <> 'TABLE'")
def history_after(g: Given) -> DataFrame:
    return history.history_after(hist(g), 500)


@CHECKS.add(f"WITH {HIST} SELECT installed_rank, description FROM hist")
def ordered_history(g: Given) -> DataFrame:
    return history.ordered_history(hist(g)).select("installed_rank", "description")


@CHECKS.add(
    "SELECT * FROM events WHERE NOT coalesce(event_type IN ('error', 'click') AND ts < TIMESTAMP '2024-01-15', false)"
)
def expire_days(g: Given) -> DataFrame:
    """A table with a partition for each day, of which only old ones are written again."""
    path = scratch_path(g.spark, "expired")
    layout.write_day_partitioned(g.events, path, "ts")
    cutoff = F.lit("2024-01-15").cast("timestamp_ntz")
    layout.expire_days(g.spark, path, F.col("event_type").isin("error", "click"), "ts", cutoff)
    return g.spark.read.parquet(path).drop("day")


@CHECKS.add(
    "SELECT * FROM events WHERE NOT coalesce(event_type = 'error' AND ts < TIMESTAMP '2024-01-15', false)"
)
def expire_rows(g: Given) -> DataFrame:
    cutoff = F.lit("2024-01-15").cast("timestamp_ntz")
    return history.expire_rows(g.events, F.col("event_type") == "error", "ts", cutoff)


@CHECKS.add(
    """SELECT * REPLACE (CASE WHEN event_type = 'view' THEN TIMESTAMP '2030-01-01' ELSE ts END AS ts)
    FROM events"""
)
def refresh_rows(g: Given) -> DataFrame:
    now = F.lit("2030-01-01").cast("timestamp_ntz")
    return history.refresh_rows(g.events, F.col("event_type") == "view", "ts", now)


@CHECKS.add(
    f"WITH {HIST} SELECT {HIST_COLUMNS} FROM hist WHERE NOT (NOT success AND coalesce(version = '1.7', false))"
)
def delete_failed_version(g: Given) -> DataFrame:
    return history.delete_failed(hist(g), version="1.7")


@CHECKS.add(f"WITH {HIST} SELECT {HIST_COLUMNS} FROM hist WHERE success OR description <> 'error'")
def delete_failed_description(g: Given) -> DataFrame:
    return history.delete_failed(hist(g), description="error")


@CHECKS.add(
    f"""WITH {HIST} SELECT {HIST_COLUMNS.replace('description, type', "CASE WHEN hit THEN 'renamed' ELSE description END AS description, CASE WHEN hit THEN 'JDBC' ELSE type END AS type").replace('checksum', 'CASE WHEN NOT hit THEN checksum END AS checksum')}
    FROM (SELECT *, description = 'signup' AS hit FROM hist)"""
)
def update_by_rank(g: Given) -> DataFrame:
    """The given null overwrites the checksum."""
    h = hist(g)
    updates = h.filter("description = 'signup'").select(
        "installed_rank",
        F.lit("renamed").alias("description"),
        F.lit("JDBC").alias("type"),
        F.lit(None).cast("int").alias("checksum"),
    )
    return history.update_by_rank(h, updates)


@CHECKS.add(
    """SELECT event_type, date_trunc('minute', ts) AS at, count(DISTINCT user_id) AS n_holders
    FROM events GROUP BY 1, 2 HAVING count(DISTINCT user_id) > 1"""
)
def competing_holders(g: Given) -> DataFrame:
    minute = F.expr("ts - make_dt_interval(0, 0, 0, extract(SECOND FROM ts))")
    return groups.competing_holders(g.events.withColumn("at", minute), ["event_type", "at"], "user_id")


@CHECKS.add(
    """SELECT event_id, ts, user_id, event_type, value, props FROM
      (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
    WHERE n = 1"""
)
def first_per_group(g: Given) -> DataFrame:
    return groups.first_per_group(g.events, ["user_id"], ["ts", "event_id"])

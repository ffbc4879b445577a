import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import leases
from tidemark.operators.history import HISTORY_COLUMNS, HISTORY_SCHEMA
from tidemark.session import scratch_path
from tidemark.streaming.ingest import ingest_stream, late_rows
from tidemark.streaming.leases import _covering, keep_sessions, lease_grants_stream, lease_sessions_stream, read_sessions
from tidemark.streaming.mutations import apply_mutations, read_state, stream_mutations

T0 = datetime(2025, 1, 1)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def test_sessions_at_the_boundary(spark, rows_of):
    rows = [("a", 0), ("a", 10), ("a", 20), ("a", 31), ("b", 5), ("a", 10), (None, 3)]
    df = spark.createDataFrame([(k, at(t)) for k, t in rows] + [("a", None)], "k string, ts timestamp")
    assert rows_of(leases.lease_sessions(df, "k", "ts", 10)) == [
        ("a", at(0), at(30), 4),
        ("a", at(31), at(41), 1),
        ("b", at(5), at(15), 1),
        (None, at(3), at(13), 1),
    ]


def test_sessions_across_parts(spark, monkeypatch, rows_of):
    monkeypatch.setattr(leases, "PART_BITS", 2)
    rng = random.Random(5)
    times = sorted(rng.randrange(-400, 2000) for _ in range(300))
    df = spark.createDataFrame([("k", at(t)) for t in times], "k string, ts timestamp")
    expected, run = [], [times[0]]
    for t in times[1:]:
        if t - run[-1] > 7:
            expected.append(run)
            run = []
        run.append(t)
    expected.append(run)
    got = rows_of(leases.lease_sessions(df, "k", "ts", 7))
    assert sorted(got) == sorted(("k", at(r[0]), at(r[-1] + 7), len(r)) for r in expected)


def replay(events, ttl):
    held, granted = {}, []
    for key, who, n, t, release in sorted(events, key=lambda e: (e[3], e[2])):
        owner = held.get(key)
        if release:
            if owner and owner[0] == who:
                del held[key]
        elif owner is None or t - owner[1] > ttl:
            held[key] = (who, t)
            granted.append((key, who, n, at(t)))
    return sorted(granted)


def lease_events(spark, seed, n=400):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b"]
    events = [(rng.choice(keys), rng.randrange(3), i, rng.randrange(600), rng.random() < 0.4) for i in range(n)]
    df = spark.createDataFrame(
        [(k, w, i, at(t), r) for k, w, i, t, r in events],
        "k string, who long, id long, ts timestamp, release boolean",
    )
    return events, df


@pytest.mark.parametrize("seed", [1, 2])
def test_grants(spark, rows_of, seed):
    events, df = lease_events(spark, seed=seed)
    got = leases.lease_grants(df, "k", "who", "ts", 10, "id")
    assert rows_of(got) == sorted(replay(events, 10), key=repr)


def test_grant_rules(spark, rows_of):
    rows = [
        (1, 7, 0, False),  # free: granted
        (2, 8, 5, False),  # held: refused
        (3, 8, 6, True),  # not the holder: no effect
        (4, 7, 8, False),  # the holder asks again: refused
        (5, 8, 10, False),  # held for the TTL exactly: refused
        (6, 8, 11, False),  # held for longer: granted
        (7, 7, 12, True),  # the old holder: no effect
        (8, 8, 13, True),  # freed
        (9, 9, 13, False),  # granted
    ]
    df = spark.createDataFrame(
        [("k", who, n, at(t), r) for n, who, t, r in rows], "k string, who long, id long, ts timestamp, release boolean"
    )
    got = leases.lease_grants(df, "k", "who", "ts", 10, "id")
    assert [r[2] for r in rows_of(got)] == [1, 6, 9]


def as_stream(spark, df, batches):
    """The rows of each batch as one file, read one file per trigger."""
    path = scratch_path(spark, "source")
    for keep in batches:
        df.filter(keep).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def run_to_table(spark, stream):
    path = scratch_path(spark, "sink")
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", scratch_path(spark, "state"))
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def test_grants_stream_keeps_state(spark, rows_of):
    events, df = lease_events(spark, seed=3, n=200)
    middle = F.col("ts") < F.lit(at(300))
    stream = as_stream(spark, df, [middle, ~middle])
    got = run_to_table(spark, lease_grants_stream(stream, "k", "who", "ts", 10, "id"))
    assert rows_of(got) == sorted(replay(events, 10), key=repr)


def test_sessions_stream_is_the_batch_without_open_spans(spark, rows_of):
    df = spark.createDataFrame([("k", at(t)) for t in (0, 5, 100, 105, 900, 2000)], "k string, ts timestamp")
    got = run_to_table(spark, lease_sessions_stream(as_stream(spark, df, [F.lit(True)]), "k", "ts", 10))
    closed = leases.lease_sessions(df, "k", "ts", 10).filter(F.col("session_end") <= F.lit(at(1400)))
    assert rows_of(got) == rows_of(closed) and len(rows_of(got)) == 3


def test_kept_sessions_are_those_of_all_rows_after_each_trigger(spark, root, rows_of, monkeypatch):
    monkeypatch.setattr(leases, "PART_BITS", 2)
    rng = random.Random(8)
    rows = [(rng.choice(["hot", "hot", "a", None]), at(rng.randrange(-300, 1500)), rng.randrange(7)) for _ in range(300)]
    df = spark.createDataFrame([*rows, ("a", None, 2)], "k string, ts timestamp, part int")
    batches = [F.col("part") == n for n in range(7)]
    keep_sessions(as_stream(spark, df, batches), root, f"{root}-state", "k", "ts", 7).awaitTermination()
    got = read_sessions(spark, root, "k", 7)
    assert rows_of(got.drop("is_open")) == rows_of(leases.lease_sessions(df, "k", "ts", 7))
    assert spark.read.parquet(root).select("batch").distinct().count() == 7
    newest = max(t for _, t, _ in rows)
    assert all(r.is_open == (r.session_end >= newest) for r in got.collect())


def test_kept_sessions_join_by_a_late_row_and_stay_at_a_restart(spark, root, rows_of):
    df = spark.createDataFrame([("k", at(t), t == 10) for t in (0, 5, 15, 20, 900, 10)], "k string, ts timestamp, late boolean")
    stream = as_stream(spark, df, [~F.col("late")])
    for _ in range(2):  # the second start finds nothing new
        keep_sessions(stream, root, f"{root}-state", "k", "ts", 6).awaitTermination()
        assert [(r[1], r[2], r[3]) for r in rows_of(read_sessions(spark, root, "k", 6))] == [
            (at(0), at(11), 2), (at(15), at(26), 2), (at(900), at(906), 1)
        ]
    keep_sessions(as_stream(spark, df, [F.col("late")]), root, f"{root}-other", "k", "ts", 6).awaitTermination()
    assert rows_of(read_sessions(spark, root, "k", 6)) == [("k", at(0), at(26), 5, False), ("k", at(900), at(906), 1, True)]


def test_folders_of_batches_cover_each_batch_once():
    for last in range(1, 70):
        held = [b for n in _covering(last) for b in range(n - (n & -n) + 1, n + 1)]
        assert sorted(held) == list(range(1, last + 1)) and len(_covering(last)) <= 7


def test_ingest_keeps_late_rows_and_drops_repeats(spark, root):
    rows = [(1, at(86400 * 5)), (1, at(86400 * 5)), (2, at(0)), (3, at(86400 * 5 + 60))]
    df = spark.createDataFrame(rows, "id int, ts timestamp")
    late = F.col("id") == 2
    ingest_stream(as_stream(spark, df, [~late, late]), root, f"{root}-state", "ts").awaitTermination()
    counts = {str(r["day"]): r["count"] for r in spark.read.parquet(root).groupBy("day").count().collect()}
    assert counts == {"2025-01-01": 1, "2025-01-06": 3}
    once = f"{root}-once"
    stream = as_stream(spark, df, [F.lit(True)])
    ingest_stream(stream, once, f"{once}-state", "ts", keys=["id"]).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(once).collect()) == [1, 2, 3]


def test_keyed_ingest_keeps_late_rows_over_triggers(spark, root):
    df = spark.createDataFrame(
        [(1, at(86400 * 5), 0), (3, at(86400 * 5 + 60), 0), (2, at(0), 1), (1, at(86400 * 5), 1), (None, at(5), 2), (None, at(6), 2), (2, at(0), 2)],
        "id int, ts timestamp, part int",
    )
    for again in ("one", "two"):  # a second stream brings everything once more
        stream = as_stream(spark, df, [F.col("part") == k for k in range(3)])
        ingest_stream(stream, root, f"{root}-{again}", "ts", keys=["id"]).awaitTermination()
        assert sorted((r["id"] or 0) for r in spark.read.parquet(root).collect()) == [0, 1, 2, 3]
    with pytest.raises(ValueError):
        ingest_stream(as_stream(spark, df.withColumn("day", F.lit("mon")), [F.lit(True)]), root, f"{root}-x", "ts")


MUTATION = (
    "op string, seq long, installed_rank int, version string, description string, type string, script string, "
    "checksum int, installed_by string, installed_on timestamp, execution_time int, success boolean"
)


def insert(seq, rank, version, description, success):
    return ("insert", seq, rank, version, description, "SQL", "s", 1, "me", T0, 1, success)


def update(seq, rank, description):
    return ("update", seq, rank, None, description, "SQL", None, None, None, None, None, None)


def delete(seq, version=None, description=None):
    return ("delete_failed", seq, None, version, description, None, None, None, None, None, None, None)


MUTATIONS = [
    insert(1, 1, "1", "a", False),
    insert(2, 2, "1", "a", True),
    insert(3, 3, None, "b", False),
    delete(4, version="1"),  # rank 1 goes
    insert(5, 4, "1", "c", False),  # comes later, stays
    update(6, 3, "z"),
    delete(7, description="b"),  # rank 3 is called z by now
    update(8, 4, "b"),
    update(9, 4, "d"),
    insert(10, 5, None, "q", False),
    delete(11, description="q"),  # rank 5 goes
    update(12, 5, "r"),
    insert(13, 2, "9", "again", False),  # the rank exists
    update(14, 99, "nobody"),
]
LEFT = [(2, "a", 1), (3, "z", None), (4, "d", None)]


def test_mutations_in_order(spark, rows_of):
    empty = spark.createDataFrame([], HISTORY_SCHEMA)
    after = apply_mutations(empty, spark.createDataFrame(MUTATIONS, MUTATION))
    assert after.columns == HISTORY_COLUMNS
    assert rows_of(after, "installed_rank", "description", "checksum") == LEFT


def test_mutations_batch_by_batch(spark, root, rows_of):
    df = spark.createDataFrame(MUTATIONS, MUTATION)
    cuts = [F.col("seq") <= 3, F.col("seq").between(4, 7), F.col("seq") > 7]
    stream = as_stream(spark, df, cuts)
    stream_mutations(stream, root, f"{root}-state").awaitTermination()
    batch, state = read_state(spark, root)
    assert batch == 2
    assert rows_of(state, "installed_rank", "description", "checksum") == LEFT
    # The same batches again change nothing.
    stream_mutations(stream, root, f"{root}-again").awaitTermination()
    assert rows_of(read_state(spark, root)[1], "installed_rank", "description", "checksum") == LEFT


def test_ingest_with_a_lag_over_triggers_and_a_restart(spark, root):
    rows = lambda *r: spark.createDataFrame([(i, f"2024-01-01 {t}", v) for i, t, v in r], "id long, t string, v string").select(
        "id", F.col("t").cast("timestamp").alias("ts"), "v"
    )
    source, raw, kept = f"{root}/source", f"{root}/raw", f"{root}/kept"
    schema = rows((0, "00:00:00", "")).schema
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")

    def arrive(*r):
        rows(*r).coalesce(1).write.mode("append").parquet(source)
        for path, how in ((raw, {}), (kept, {"keys": ["id"], "lag": "600 seconds"})):
            ingest_stream(spark.readStream.schema(schema).parquet(source), path, f"{path}-state", "ts", **how).awaitTermination()
        return sorted((r["id"], r["v"]) for r in spark.read.parquet(kept).collect())

    assert arrive((1, "00:00:00", "a"), (2, "00:05:00", "a"), (2, "00:05:00", "a")) == [(1, "a"), (2, "a")]
    # A repeat within the lag, one late by less than the lag, and time going on.
    assert arrive((2, "00:05:00", "b"), (3, "00:01:00", "a"), (4, "02:00:00", "a")) == [(1, "a"), (2, "a"), (3, "a"), (4, "a")]
    # Behind the watermark: neither the repeat nor the late new one gets in; the raw table has both.
    assert arrive((1, "00:00:00", "c"), (5, "00:30:00", "a"), (6, "02:30:00", "a")) == [(1, "a"), (2, "a"), (3, "a"), (4, "a"), (6, "a")]
    whole = spark.read.parquet(raw)
    assert whole.count() == 9
    assert [r["id"] for r in late_rows(whole, spark.read.parquet(kept), ["id"]).collect()] == [5]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider
    with pytest.raises(ValueError, match="lag"):
        ingest_stream(spark.readStream.schema(schema).parquet(source), kept, f"{kept}-x", "ts", lag="1 second")

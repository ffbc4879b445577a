from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.history import append_history
from tidemark.plans import columns
from tidemark.plans import steps as s
from tidemark.plans.migrate import (
    ChangedStep,
    baseline,
    baseline_row,
    current_tables,
    history_path,
    migrate,
    pending,
    read_history,
)
from tidemark.sources import catalog, layout

TRADES = "instrument string, side string, qty double, price double, ts timestamp"


def trade_steps(spark, ts=None):
    rows = spark.createDataFrame(
        [
            ("SYM1", "BUY", "100", "12.56", "2025-05-09T00:01:00.000000Z"),
            ("SYM2", "BUY", "120", "10.11", "2025-05-09T00:02:00.000000Z"),
            ("SYM1", "SELL", "50", "12.44", "2025-05-10T00:03:00.000000Z"),
        ],
        "instrument string, side string, qty string, price string, ts string",
    )
    return [
        s.step("1", "Create trades table", s.create_table("trades", TRADES, ts)),
        s.step("2", "Insert trades", s.insert_rows("trades", rows)),
        s.step("3", "Rename table", s.rename_table("trades", "trades_table")),
        s.step("4", "Add venue column", s.rename_table("trades_table", "trades"), s.add_column("trades", "venue", "string")),
        s.step("5", "Alter column type", s.change_type("trades", "venue", "varchar(10)")),
        s.step("6", "Drop venue column", s.drop_column("trades", "venue")),
        s.step("7", "Drop trades table", s.drop_table("trades")),
    ]


GOLDEN = [
    ("SYM1", "BUY", 100.0, 12.56, datetime(2025, 5, 9, 0, 1)),
    ("SYM1", "SELL", 50.0, 12.44, datetime(2025, 5, 10, 0, 3)),
    ("SYM2", "BUY", 120.0, 10.11, datetime(2025, 5, 9, 0, 2)),
]


def descriptions(spark, root):
    return [r["description"] for r in read_history(spark, root).orderBy("installed_rank").collect()]


@pytest.mark.parametrize("target", ["1", "2", "3", "4", "5", "6", "7"])
def test_each_target(spark, root, rows_of, target):
    result = migrate(spark, root, trade_steps(spark), target)
    assert result.applied == [str(n) for n in range(1, int(target) + 1)]
    assert result.rewrites == (0 if target == "7" else 1)
    name = "trades_table" if target == "3" else "trades"
    assert list(result.tables) == ([] if target == "7" else [name])
    if target in "23456":
        table = result.tables[name]
        assert rows_of(table, *table.columns[:5]) == GOLDEN
        assert (table.columns[-1] == "venue") == (target in "45")
    if target == "1":
        assert result.tables[name].isEmpty()
    history = read_history(spark, root)
    assert history.filter("success").count() == int(target)


def test_one_step_at_a_time_gives_the_same(spark, root, rows_of):
    steps = trade_steps(spark, ts="ts")
    rewrites = [migrate(spark, root, steps, str(n)).rewrites for n in range(1, 7)]
    # Step 3 only renames, so the files stay.
    assert rewrites == [1, 1, 0, 1, 1, 1]
    table = current_tables(spark, root)["trades"]
    assert table.ts == "ts" and rows_of(table.rows) == GOLDEN
    assert [r["installed_rank"] for r in read_history(spark, root).orderBy("installed_rank").collect()] == [1, 2, 3, 4, 5, 6]


def test_repeat_does_nothing(spark, root, rows_of):
    steps = trade_steps(spark)[:2]
    for expected in (["1", "2"], [], []):
        result = migrate(spark, root, steps)
        assert result.applied == expected
        assert rows_of(result.tables["trades"]) == GOLDEN
    assert descriptions(spark, root) == ["Create trades table", "Insert trades"]


def test_only_new_steps(spark, root):
    migrate(spark, root, trade_steps(spark)[:2])
    more = spark.createDataFrame([("SYM3",)], "instrument string")
    result = migrate(spark, root, [*trade_steps(spark)[:2], s.step("003", "add more rows", s.insert_rows("trades", more))])
    assert result.applied == ["003"] and result.tables["trades"].count() == 4
    assert descriptions(spark, root)[-1] == "add more rows"


def test_failure_commits_nothing(spark, root, rows_of):
    migrate(spark, root, trade_steps(spark)[:2])
    bad = s.step("3", "Retype", s.change_type("trades", "side", "int"))
    with pytest.raises(Exception):
        migrate(spark, root, [*trade_steps(spark)[:2], bad])
    assert rows_of(current_tables(spark, root)["trades"].rows) == GOLDEN
    assert len(descriptions(spark, root)) == 2
    good = s.step("3", "Retype", s.change_type("trades", "side", "int", on_error="null"))
    result = migrate(spark, root, [*trade_steps(spark)[:2], good])
    assert result.tables["trades"].filter("side IS NOT NULL").isEmpty()


def test_changed_step_is_refused(spark, root):
    migrate(spark, root, trade_steps(spark)[:1])
    other = s.step("1", "Create trades table", s.create_table("trades", "id int"))
    with pytest.raises(ChangedStep, match="1"):
        migrate(spark, root, [other])


def test_step_errors(spark, root):
    def run(*changes):
        migrate(spark, root, [s.step("1", "x", s.create_table("t", "a int"), *changes)])

    for change in (
        s.drop_column("t", "b"),
        s.add_column("t", "a", "int"),
        s.rename_table("u", "v"),
        s.drop_table("u"),
        s.change_type("t", "b", "int"),
        s.insert_rows("t", spark.createDataFrame([(1,)], "z int")),
    ):
        with pytest.raises(ValueError):
            run(change)
    run(s.drop_table("u", if_exists=True), s.add_column("t", "b", "string", F.lit("x")))


def test_six_steps_are_one_projection(spark, root):
    tables = {}
    for one in trade_steps(spark)[:6]:
        for change in one.changes:
            tables = change.apply(spark, tables)
    plan = tables["trades"].rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") <= 1 and "venue" not in plan


def test_baseline(spark, root):
    baseline(spark, root, "1")
    assert not current_tables(spark, root)
    assert descriptions(spark, root) == ["<< Baseline >>"]
    with pytest.raises(ValueError):
        baseline(spark, root, "2")
    start = s.step("1.1", "make", s.create_table("t", "a int"))
    result = migrate(spark, root, [s.step("1.0", "skipped", s.create_table("u", "a int")), start])
    assert result.applied == ["1.1"] and list(result.tables) == ["t"]
    assert descriptions(spark, root) == ["<< Baseline >>", "make"]


def test_pending(spark):
    available = spark.createDataFrame([(v,) for v in ["10", "2", "1.10", "1.9", "001", "x"]], "version string")
    done = spark.createDataFrame(
        [("1", "SQL", True), ("2", "SQL", False), (None, "SQL", True)], "version string, type string, success boolean"
    )

    def names(df):
        return [r["version"] for r in df.collect()]

    assert names(pending(available, done)) == ["1.9", "1.10", "2", "10"]
    assert names(pending(available, done, "2.0")) == ["1.9", "1.10", "2"]
    started = done.unionByName(baseline_row(spark, "1.9").select(*done.columns))
    assert names(pending(available, started)) == ["1.10", "2", "10"]


def test_readers_see_the_last_commit_only(spark, root, rows_of):
    from tidemark.plans.snapshots import Table, write_snapshot

    migrate(spark, root, trade_steps(spark)[:2])
    write_snapshot(spark, root, 3, {"trades": Table(spark.range(5))})
    assert rows_of(current_tables(spark, root)["trades"].rows) == GOLDEN
    assert migrate(spark, root, trade_steps(spark)[:3]).applied == ["3"]
    assert rows_of(current_tables(spark, root)["trades_table"].rows) == GOLDEN


def test_failed_rows_do_not_hide_a_snapshot(spark, root, rows_of):
    migrate(spark, root, trade_steps(spark)[:2])
    failed = read_history(spark, root).limit(1).withColumns({"installed_rank": F.lit(9), "success": F.lit(False)})
    append_history(failed, history_path(root))
    assert rows_of(current_tables(spark, root)["trades"].rows) == GOLDEN


def test_ensure_columns(spark, rows_of):
    df = spark.createDataFrame([(1, "7", "k")], "id int, ts string, extra string")
    wanted = T.StructType.fromDDL("id long, lock_id long, ts int")
    fixed = columns.ensure_columns(df, wanted)
    assert fixed.columns == ["id", "lock_id", "ts", "extra"] and rows_of(fixed) == [(1, None, 7, "k")]
    assert columns.ensure_columns(df, wanted, "recreate").isEmpty()
    assert columns.ensure_columns(df, T.StructType.fromDDL("id int"), "recreate") is df
    drift = columns.column_drift(
        columns.columns_of(spark.createDataFrame([], wanted), "t"), columns.columns_of(df, "t"), ["table_name", "column_name"]
    )
    assert rows_of(drift, "column_name", "drift") == [("extra", "extra"), ("id", "type"), ("lock_id", "missing"), ("ts", "type")]


def test_lost_values(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "v string")
    assert s.lost_values(df, "v", "int").first()[0] == 1


def test_catalog_tables(spark, root, rows_of):
    columns_text = "id INT, text STRING DEFAULT 'none'"
    catalog.create_table(spark, "first_t", columns_text, location=root)
    catalog.create_table(spark, "first_t", columns_text, location=root)
    catalog.insert_into(spark, "first_t", spark.createDataFrame([(1,)], "id int"))
    catalog.rename_table(spark, "first_t", "second_t")
    catalog.add_table_column(spark, "second_t", "more", "double")
    assert rows_of(spark.table("second_t")) == [(1, "none", None)]
    assert catalog.table_exists(spark, "second_t") and not catalog.table_exists(spark, "first_t")
    catalog.drop_table(spark, "second_t")
    catalog.drop_table(spark, "second_t", if_exists=True)
    assert not catalog.table_exists(spark, "second_t")


def test_day_partitions(spark, root):
    df = spark.range(2000).select(
        F.expr("CASE WHEN id < 1500 THEN timestamp'2024-01-02' ELSE timestamp'2024-01-01' + make_dt_interval(id DIV 100) END").alias("ts"),
        "id",
    )
    layout.write_day_partitioned(df, root, "ts")
    back = spark.read.parquet(root)
    assert back.count() == 2000
    one = back.filter(F.col("day") == "2024-01-02")
    assert one.count() == 1500
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString()


def test_clustered_files_have_their_own_ranges(spark, root):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("k"), "id").repartition(5)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        layout.cluster_for_lookup(df, ["k"], root)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    spans = (
        spark.read.parquet(root)
        .groupBy(F.input_file_name())
        .agg(F.min("k").alias("low"), F.max("k").alias("high"))
        .orderBy("low")
        .collect()
    )
    assert len(spans) > 1
    assert all(a["high"] <= b["low"] for a, b in zip(spans, spans[1:]))


def test_hot_value_spans_files(spark, root):
    df = spark.range(0, 8000, 1, 8).select(F.lit(1).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        layout.cluster_for_lookup(df, ["k"], root)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert spark.read.parquet(root).select(F.input_file_name()).distinct().count() > 1

"""Operators that exist so that less of a large table is read or moved."""

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.operators import digests, groups, history, refs
from tidemark.session import scratch_path
from tidemark.sources.layout import cluster_by_curve, expire_days, write_day_partitioned

ORDERS = "/root/testdata/sf0.01/orders.parquet"


def files_of(path):
    import pathlib

    return {str(f.relative_to(path)) for f in pathlib.Path(path).rglob("*.parquet")}


def local(spark, label):
    return scratch_path(spark, label).removeprefix("file:")


def test_diff_of_bags_with_nulls(spark, rows_of):
    a = spark.createDataFrame([(None, "x", 1.0), ("x", None, 1.0), (None, None, -0.0), ("y", "y", 2.0), ("y", "y", 2.0)], "_side string, bucket string, v double")
    b = spark.createDataFrame([("x", None, 1.0), ("x", None, 1.0), (None, None, 0.0), ("y", "y", 2.0)], "_side string, bucket string, v double")
    assert rows_of(groups.table_diff(a, b)) == sorted([(None, "x", 1.0, "left", 1), ("x", None, 1.0, "right", 1), ("y", "y", 2.0, "left", 1)], key=repr)
    assert digests.same_digests(a, a.orderBy("v")) and not digests.same_digests(a, b)
    assert groups.table_diff(a.where("false"), a.where("false")).isEmpty()
    assert groups.table_diff(a.where("false"), a).agg(F.sum("n_rows")).first()[0] == 5


def test_diff_equals_counting_all_rows(spark, rows_of):
    rng = random.Random(2)
    rows = [(rng.randrange(50), rng.choice(["a", "b", None])) for _ in range(4000)]
    other = [r for r in rows if rng.random() < 0.9] + rows[:100]
    a, b = (spark.createDataFrame(x, "n int, s string") for x in (rows, other))
    both = a.withColumn("k", F.lit(1)).union(b.withColumn("k", F.lit(-1))).groupBy("n", "s").agg(F.sum("k").alias("k")).where("k <> 0")
    want = sorted(((r["n"], r["s"], "left" if r["k"] > 0 else "right", abs(r["k"])) for r in both.collect()), key=repr)
    assert rows_of(groups.table_diff(a, b)) == want


def test_few_differences_move_few_rows(spark):
    a = spark.read.parquet(ORDERS)
    changed = F.pmod(F.xxhash64("o_orderkey"), F.lit(1000)) == 0
    b = a.withColumn("o_totalprice", F.when(changed, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    moved = digests.differing_rows(a, b)
    n = a.where(changed).count()
    assert 2 * n <= moved.count() < 0.05 * 2 * a.count()
    assert groups.table_diff(a, b).count() == 2 * n


def test_curve_lets_a_lookup_by_any_column_skip_files(spark, rows_of):
    df = spark.range(40_000).select((F.col("id") * 7919 % 40_000).alias("a"), (F.col("id") * 104_729 % 40_000).alias("b"), F.col("id").cast("string").alias("s"))
    path = local(spark, "curve")
    cluster_by_curve(df, ["a", "b"], path, files=256)
    files = [pq.ParquetFile(f"{path}/{f}") for f in files_of(path)]
    for column, name in enumerate("ab"):
        ranges = [(s.min, s.max) for f in files for g in [f.metadata.row_group(0)] for s in [g.column(column).statistics]]
        met = sum(low <= 20_100 and high >= 20_000 for low, high in ranges)
        assert len(files) > 200 and met < 0.1 * len(files), (name, met, len(files))
    assert rows_of(spark.read.parquet(path)) == rows_of(df)


def test_curve_with_a_hot_value_nulls_and_few_rows(spark, rows_of):
    df = spark.range(3000).select(F.when(F.col("id") < 1000, 7).when(F.col("id") > 2900, None).otherwise(F.col("id")).alias("_place"), (F.col("id") % 5).cast("string").alias("s"))
    path = local(spark, "hot")
    cluster_by_curve(df, ["_place", "s"], path, files=16)
    assert rows_of(spark.read.parquet(path)) == rows_of(df)
    holding = sum(7 in pq.read_table(f"{path}/{f}").column("_place").to_pylist() for f in files_of(path))
    assert holding >= 4
    cluster_by_curve(df.where("false"), ["_place"], f"{path}-none")
    assert spark.read.schema(df.schema).parquet(f"{path}-none").count() == 0


def test_composite_references(spark, rows_of):
    child = spark.createDataFrame([(1, 1, "ok"), (1, 2, "bad"), (None, 9, "null"), (9, None, "null"), (None, None, "null"), (1, 2, "bad")], "x int, y int, v string")
    parent = spark.createDataFrame([(1, 1), (2, 1), (None, 2)], "b int, a int")
    assert rows_of(refs.fk_violations(child, ["x", "y"], parent, ["b", "a"]), "v") == [("bad",), ("bad",)]
    assert rows_of(refs.fk_violations(child, "x", parent, "b"), "x", "y") == [(9, None)]
    with pytest.raises(ValueError, match="number of columns"):
        refs.fk_violations(child, ["x", "y"], parent, "b")


def test_dense_references_do_not_move_the_child(spark, rows_of, monkeypatch):
    keys = [*range(1, 100), 32_768, 32_769, 65_536, -5, 0, 10**12]
    parent = spark.createDataFrame([(k,) for k in keys] + [(None,)], "k long")
    child = spark.createDataFrame([(k, 1) for k in [*keys, *range(90, 120), -6, -4, 32_767, 65_537, 10**12 + 1, None]], "fk long, _range int")
    want = rows_of(refs.fk_violations(child, "fk", parent, "k"))
    found = refs.fk_violations_dense(child, "fk", parent, "k")
    assert rows_of(found) == want and len(want) == 25
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    monkeypatch.setattr(refs, "BITMAP_ROWS", 1)  # keys too far apart for a bitmap
    assert rows_of(refs.fk_violations_dense(child, "fk", parent, "k")) == want
    assert rows_of(refs.fk_violations_dense(child, "fk", parent.where("false"), "k")) == rows_of(child.where("fk IS NOT NULL"))


def test_expiry_rewrites_only_days_that_it_touches(spark, rows_of):
    rows = [(d, h, "lock" if h == 5 or d == 2 else "row") for d in range(1, 8) for h in range(0, 24)]
    df = spark.createDataFrame(rows, "d int, h int, kind string").select("*", F.make_timestamp(F.lit(2024), F.lit(1), "d", "h", F.lit(0), F.lit(0)).alias("ts"))
    path = local(spark, "expiry")
    write_day_partitioned(df, path, "ts")
    before = files_of(path)
    cutoff = F.lit("2024-01-04 03:00:00").cast("timestamp")
    assert expire_days(spark, path, F.col("kind") == "lock", "ts", cutoff) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    after = files_of(path)
    assert {f for f in before if f > "day=2024-01-04"} == {f for f in after if f > "day=2024-01-04"}
    assert not any(f.startswith("day=2024-01-02") for f in after)  # nothing is left of it
    want = history.expire_rows(df, F.col("kind") == "lock", "ts", cutoff)
    assert rows_of(spark.read.parquet(path), "d", "h") == rows_of(want, "d", "h")
    assert expire_days(spark, path, F.col("kind") == "lock", "ts", cutoff) == [] and files_of(path) == after


def test_one_scan_for_each_layout(spark, rows_of):
    root = scratch_path(spark, "many servers+1")
    base = spark.range(120).select(
        F.col("id").cast("int").alias("installed_rank"), F.lit("1").alias("version"), F.lit("d").alias("description"), F.lit("SQL").alias("type"), F.lit("s").alias("script"),
        F.lit(1).alias("checksum"), F.lit("me").alias("installed_by"), F.current_timestamp().alias("installed_on"), F.lit(1).alias("execution_time"),
        (F.col("id") % 2 == 0).alias("success"), (F.col("id") % 40).alias("server"),
    )
    for k, success in enumerate([F.col("success"), F.col("success").cast("int"), F.col("success").cast("string")]):
        base.where(F.col("server") % 3 == k).withColumn("success", success).write.partitionBy("server").parquet(f"{root}/{k}")
    paths = {f"host {n}": f"{root}/{n % 3}/server={n}" for n in range(40)}
    found = history.unify_history_files(spark, paths)
    assert rows_of(found, "server", "installed_rank", "success") == rows_of(
        base.select(F.concat(F.lit("host "), "server").alias("server"), "installed_rank", "success")
    )
    assert found._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 4  # three layouts and the names

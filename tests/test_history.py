from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import history as h

T0 = datetime(2025, 1, 1)


@pytest.fixture
def small(spark):
    rows = [
        (1, None, "<< Baseline >>", "BASELINE", "b", None, "me", T0, 0, True),
        (2, "1", "first", "SQL", "V1", 11, "me", T0, 5, True),
        (3, "2", "second", "SQL", "V2", 12, "me", T0, 5, False),
        (4, None, "view", "SQL", "R", 13, "me", T0, 5, False),
        (5, "3", "made", "TABLE", "V3", None, "me", T0, 5, True),
    ]
    return spark.createDataFrame(rows, h.HISTORY_SCHEMA)


def ranks(df):
    return [r["installed_rank"] for r in df.collect()]


def test_layouts_unify(spark):
    bit = spark.createDataFrame(
        [(True, 1, "d", "SQL", "s", "me", T0, 1)],
        "success boolean, installed_rank long, description string, type string, script string, "
        "installed_by string, installed_on timestamp, execution_time long",
    )
    text = bit.select(*reversed(bit.columns)).withColumn("success", F.lit("FALSE")).withColumn("version", F.lit("1"))
    number = bit.withColumn("success", F.lit(1))
    got = h.unify_histories({"a": bit, "b": text, "c": number})
    assert got.columns == [*h.HISTORY_COLUMNS, "server"]
    assert sorted((r["server"], r["version"], r["success"]) for r in got.collect()) == [
        ("a", None, True),
        ("b", "1", False),
        ("c", None, True),
    ]
    with pytest.raises(ValueError, match="script"):
        h.conform(bit.drop("script"))


def test_append_fills_the_time(spark, small, root):
    h.append_history(small, root)
    h.append_history(small.withColumn("installed_rank", F.col("installed_rank") + 5), root)
    got = spark.read.schema(h.HISTORY_SCHEMA).parquet(root)
    assert got.count() == 10
    assert got.filter(F.col("installed_on") > F.lit(T0)).count() == 10


def test_after_rank(small):
    assert ranks(h.history_after(small, 2)) == [3, 4]
    assert ranks(h.history_after(small, 2, skip_markers=False)) == [3, 4, 5]
    assert ranks(h.history_after(small, 9)) == []


def test_delete_failed(small):
    assert ranks(h.delete_failed(small, version="2")) == [1, 2, 4, 5]
    assert ranks(h.delete_failed(small, version="1")) == [1, 2, 3, 4, 5]
    assert ranks(h.delete_failed(small, description="view")) == [1, 2, 3, 5]
    with pytest.raises(ValueError):
        h.delete_failed(small)


def test_update_by_rank(spark, small):
    updates = spark.createDataFrame(
        [(2, "new", "JDBC", None), (99, "x", "y", 1)],
        "installed_rank int, description string, type string, checksum int",
    )
    got = {r["installed_rank"]: r for r in h.update_by_rank(small, updates).collect()}
    assert len(got) == 5
    assert (got[2]["description"], got[2]["type"], got[2]["checksum"]) == ("new", "JDBC", None)
    assert got[3]["checksum"] == 12


def test_expire_and_refresh(spark):
    old, new = datetime(2020, 1, 1), datetime(2021, 1, 1)
    rows = [("lock", old), ("lock", new), (None, old), ("lock", None), ("other", old)]
    df = spark.createDataFrame(rows, "label string, ts timestamp")
    left = h.expire_rows(df, F.col("label") == "lock", "ts", F.lit(new))
    assert sorted(left.collect(), key=repr) == sorted(df.collect()[1:], key=repr)
    moved = h.refresh_rows(df, F.col("label") == "lock", "ts", F.lit(T0))
    assert [r["ts"] for r in moved.collect()] == [T0, T0, old, T0, old]

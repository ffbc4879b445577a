from types import SimpleNamespace

import pytest

import __spark_entry__ as entry_points
from tidemark.checks import ALL
from tidemark.session import save, shared_folder


def fake(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, *default: folder or (default[0] if default else "/lake/warehouse/")),
        sparkContext=SimpleNamespace(master=master),
    )


def test_shared_folder():
    assert shared_folder(fake("yarn", "hdfs://n/checkpoints/")) == "hdfs://n/checkpoints"
    assert shared_folder(fake("local[2]")) == "/lake/warehouse/_scratch"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(fake("yarn"))


def test_save_cuts_the_plan(spark):
    kept = save(spark.range(10).filter("id > 3"), "test")
    assert kept.count() == 6
    assert "Range" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_flagship(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["instrument", "side", "qty", "price", "ts"]
    assert dict(df.dtypes)["qty"] == "int" and df.count() > 0


def test_every_query_has_sql():
    queries, sql = entry_points.queries(), entry_points.oracle_sql()
    assert len(ALL) > 70 and set(ALL) <= set(sql) <= set(queries)

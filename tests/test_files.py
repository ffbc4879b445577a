import uuid

import pytest

from tidemark.plans.files import (
    baseline_schema,
    clean_schema,
    migrate_files,
    read_schema_history,
    repair_schema,
)
from tidemark.plans.migrate import ChangedStep

FIRST = """-- tables
CREATE TABLE ${schema}.stations(code INT, label STRING) USING parquet;
CREATE TABLE tides(station INT, metres INT) USING parquet;

INSERT INTO ${schema}.stations(code, label) VALUES (1, 'Dover; pier');
INSERT INTO ${schema}.stations(code, label) VALUES (2, '');
"""
SECOND = """CREATE FUNCTION ${schema}.is_unnamed(label STRING) RETURNS BOOLEAN RETURN label = '';
CREATE VIEW ${schema}.named_stations AS
SELECT * FROM ${schema}.stations WHERE NOT ${schema}.is_unnamed(label);
"""
MORE = "INSERT INTO ${schema}.stations(code, label) VALUES (3, 'Leith')"


@pytest.fixture
def schema(spark):
    name = f"s_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "V001__stations.sql").write_text(FIRST)
    (tmp_path / "V002__names.sql").write_text(SECOND)
    return tmp_path


def history(spark, schema):
    rows = read_schema_history(spark, schema).orderBy("installed_rank").collect()
    return [(r["installed_rank"], r["version"], r["description"], r["success"]) for r in rows]


def test_migrate_repeat_next_and_clean(spark, schema, folder, rows_of):
    before = spark.catalog.currentDatabase()
    assert migrate_files(spark, str(folder), schema) == ["001", "002"]
    assert migrate_files(spark, str(folder), schema) == []
    assert spark.catalog.currentDatabase() == before
    tables = {t.name for t in spark.catalog.listTables(schema)}
    assert tables == {"named_stations", "schema_history", "stations", "tides"}
    assert rows_of(spark.table(f"{schema}.named_stations")) == [(1, "Dover; pier")]
    assert history(spark, schema) == [(1, "001", "stations", True), (2, "002", "names", True)]

    (folder / "V003__one_more_station.sql").write_text(MORE)
    assert migrate_files(spark, str(folder), schema) == ["003"]
    assert spark.table(f"{schema}.stations").count() == 3
    assert history(spark, schema)[-1] == (3, "003", "one more station", True)

    (folder / "V001__stations.sql").write_text(FIRST + "-- edited")
    with pytest.raises(ChangedStep, match="001"):
        migrate_files(spark, str(folder), schema)

    assert len(clean_schema(spark, schema)) == 5
    assert not spark.catalog.listTables(schema)
    assert spark.sql(f"SHOW USER FUNCTIONS IN {schema}").isEmpty()


def test_target_and_baseline(spark, schema, folder):
    baseline_schema(spark, schema, "1")
    assert {t.name for t in spark.catalog.listTables(schema)} == {"schema_history"}
    assert migrate_files(spark, str(folder), schema, target="1.5") == []
    assert history(spark, schema) == [(1, "1", "<< Baseline >>", True)]
    with pytest.raises(ValueError):
        baseline_schema(spark, schema, "2")


def test_failure_is_recorded_and_repaired(spark, schema, folder):
    bad = folder / "V001_1__bad.sql"
    bad.write_text("INSERT INTO stations VALUES (7, 'x'); SELECT * FROM nowhere")
    with pytest.raises(Exception, match="nowhere"):
        migrate_files(spark, str(folder), schema)
    assert [h[1:] for h in history(spark, schema)] == [("001", "stations", True), ("001_1", "bad", False)]
    repair_schema(spark, schema)
    bad.write_text("SELECT 1")
    assert migrate_files(spark, str(folder), schema) == ["001_1", "002"]
    assert [h[0] for h in history(spark, schema)] == [1, 2, 3]


def test_unknown_placeholder(spark, schema, folder):
    (folder / "V003__x.sql").write_text("SELECT '${who}'")
    with pytest.raises(Exception, match="no value for placeholder"):
        migrate_files(spark, str(folder), schema)
    assert migrate_files(spark, str(folder), schema, {"who": "me"}) == ["001", "002", "003"]

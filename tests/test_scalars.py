import zlib
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import scalars as s
from tidemark.sources import jdbc, scripts


def values(spark, expr, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_quote_styles(spark):
    inputs = ["a", "a`b", 'a"b', ""]
    assert values(spark, lambda c: s.quote_ident([c]), inputs) == ["`a`", "`a\\`b`", '`a"b`', "``"]
    assert values(spark, lambda c: s.quote_ident([c], "double"), inputs) == ['"a"', '"a`b"', '"a"b"', '""']
    assert values(spark, lambda c: s.quote_ident([F.lit("s"), c], "spark"), ["a`b"]) == ["`s`.`a``b`"]


def test_unquote(spark):
    inputs = ["`a`", '"a b"', "plain", None, "``", "`x\ny`"]
    assert values(spark, s.unquote_ident, inputs) == ["a", "a b", "plain", None, "", "x\ny"]


def test_version_key(spark):
    inputs = ["001", "1", "5.0", "5", "1_2.0_0", "0", "0.0", "10.02", "", "v1", None, "1..2", " 2.1 "]
    expected = [[1], [1], [5], [5], [1, 2], [0], [0], [10, 2], None, None, None, None, [2, 1]]
    assert values(spark, s.version_key, inputs) == expected


def test_version_order(spark):
    inputs = ["4.9", "5", "5.0.0", "5.0.1", "10", None]
    assert values(spark, lambda c: s.version_at_least(c, "5.0"), inputs) == [False, True, True, True, True, None]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(0, 30), min_size=1, max_size=4), min_size=2, max_size=20))
def test_version_order_is_numeric(spark, versions):
    def trimmed(v):
        while len(v) > 1 and v[-1] == 0:
            v = v[:-1]
        return v

    texts = [".".join(map(str, v)) for v in versions]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.orderBy(s.version_key("v"), "v").select(s.version_key("v")).collect()]
    assert got == sorted(trimmed(v) for v in versions)


def test_version_from_text(spark):
    inputs = ["OceanBase 4.2.1 (r1)", "one", "", "   ", None, "a  b"]
    assert values(spark, s.version_from_text, inputs) == ["4.2.1", None, None, None, None, ""]


def test_version_with_build(spark):
    df = spark.createDataFrame([("2.1", 7), (None, 7), ("2.1", None)], "v string, b int")
    assert [r[0] for r in df.select(s.version_with_build("v", "b")).collect()] == ["2.1.7", None, None]


def test_to_bool(spark):
    inputs = ["1", "0", "TRUE", "False", " true ", "yes", "", None]
    assert values(spark, s.to_bool, inputs) == [True, False, True, False, True, None, None, None]
    assert values(spark, s.to_bool, [1, 0, 2, None], "int") == [True, False, None, None]
    assert values(spark, s.to_bool, [True, False, None], "boolean") == [True, False, None]
    with pytest.raises(Exception, match="not a boolean"):
        values(spark, lambda c: s.to_bool(c, strict=True), ["yes"])
    assert values(spark, lambda c: s.to_bool(c, strict=True), ["1", None]) == [True, None]


def test_url_credentials(spark):
    inputs = ["jdbc:x://h", "jdbc:x://h?user=a", "jdbc:x://h?user=a&password=b"]
    assert values(spark, s.needs_user, inputs) == [True, False, False]
    assert values(spark, s.needs_password, inputs) == [True, True, False]


def test_unescape(spark):
    inputs = ["'it''s'", "''", "''''", "raw", "'a\nb'", None, "'"]
    assert values(spark, s.unescape_sql_string, inputs) == ["it's", "", "'", "raw", "a\nb", None, "'"]


def test_split_args(spark):
    inputs = ["a, 'b,c' ,NULL", "", "'it''s, ok',2", "a,", ",", "1, ' lone", "x" * 100_000 + ",'" + "y," * 50_000 + "'"]
    got = values(spark, s.split_args, inputs)
    assert got[:6] == [["a", "'b,c'", "NULL"], [""], ["'it''s, ok'", "2"], ["a", ""], ["", ""], ["1", "' lone"]]
    assert [len(x) for x in got[6]] == [100_000, 100_002]


def test_or_default(spark):
    assert values(spark, lambda c: s.or_default(c, "main"), ["a", "", "  ", None]) == ["a", "main", "main", "main"]


def test_iso_timestamp(spark):
    got = values(spark, lambda c: s.iso_timestamp(c).cast("string"), ["2025-05-09T00:01:00.000001Z", None])
    assert got == ["2025-05-09 00:01:00.000001", None]
    assert isinstance(values(spark, s.iso_timestamp, ["2025-05-09T00:01:00Z"])[0], datetime)


def test_cast_or_null(spark):
    inputs = ["1", " -7 ", "+3", "x", "1.5", "", "99999999999", None]
    df = spark.createDataFrame([(v,) for v in inputs], "v string")
    guarded = s.cast_or_null(F.col("v"), df.schema["v"].dataType, "int")
    assert [tuple(r) for r in df.select(guarded, F.col("v").try_cast("int")).collect()] == [
        (v, v) for v in [1, -7, 3, None, None, None, None, None]
    ]


def test_drivers(spark):
    urls = ["jdbc:ignite:thin://h", "jdbc:p6spy:db2://h", "jdbc:db2://h", "jdbc:IRIS://h", "jdbc:iris://h", "x", None]
    got = values(spark, jdbc.driver_class, urls)
    assert got == [jdbc.driver_for_url(u) if u else None for u in urls]
    assert got[4] is None and got[0] == "org.apache.ignite.IgniteJdbcThinDriver"


def test_jdbc_options():
    plain = jdbc.jdbc_options("jdbc:duckdb:x", "t")
    assert plain == {"url": "jdbc:duckdb:x", "driver": "org.duckdb.DuckDBDriver", "dbtable": "t"}
    split = jdbc.jdbc_options("jdbc:duckdb:x", "t", "id", (3, 90), 4)
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("3", "91", "4")
    with pytest.raises(ValueError, match="no driver"):
        jdbc.jdbc_options("jdbc:unknown:x?password=secret", "t")


def test_resolve(spark):
    df = spark.createDataFrame([("V003__add_more_rows.sql",), ("V1_2__x.sql",), ("R__view.sql",)], "name string")
    got = [tuple(r) for r in scripts.resolve(df).select("version", "description").collect()]
    assert got == [("003", "add more rows"), ("1_2", "x"), (None, None)]


def test_substitute(spark):
    got = values(spark, lambda c: scripts.substitute(c, {"a": "1", "b": F.lit("${x}")}, strict=False), ["${a}-${a}", "${b}", None])
    assert got == ["1-1", "${x}", None]
    with pytest.raises(Exception, match="no value for placeholder"):
        values(spark, lambda c: scripts.substitute(c, {"a": "1"}), ["${a} ${c}"])


def test_checksum(spark):
    texts = ["", "a", "hello world", "é"]
    signed = [zlib.crc32(t.encode()) for t in texts]
    assert values(spark, scripts.script_checksum, texts) == [c - 2**32 if c >= 2**31 else c for c in signed]


def test_read_scripts(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "V1__x.sql").write_text("SELECT 1;\nSELECT 2;\n")
    (tmp_path / "a" / "V2__y.sql").write_text("-- none")
    (tmp_path / "notes.txt").write_text("no")
    got = {r["path"].split("/")[-1]: r["text"] for r in scripts.read_scripts(spark, str(tmp_path)).collect()}
    assert got == {"V1__x.sql": "SELECT 1;\nSELECT 2;\n", "V2__y.sql": "-- none"}


def test_changed_scripts(spark):
    now = spark.createDataFrame([("1", "a"), ("2.0", "b"), ("3", "c")], "version string, text string")
    crc = [zlib.crc32(t) for t in (b"a", b"x", b"y")]
    rows = [("001", True, crc[0]), ("2", True, crc[1]), ("3", True, None), ("3", False, crc[2])]
    rows = [(v, ok, c - 2**32 if c and c >= 2**31 else c) for v, ok, c in rows]
    history = spark.createDataFrame(rows, "version string, success boolean, checksum int")
    assert [r["version"] for r in scripts.changed_scripts(now, history).collect()] == ["2.0"]

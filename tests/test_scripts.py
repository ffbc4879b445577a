import pytest

from tidemark.operators import fleet, statements


def split(spark, text, dialect="plain"):
    df = spark.createDataFrame([("a.sql", text), ("b.sql", "SELECT 1")], "path string, text string")
    got = statements.split_statements(df, dialect).orderBy("path", "stmt_no").collect()
    assert got[-1]["path"] == "b.sql"
    numbers = [r["stmt_no"] for r in got[:-1]]
    assert numbers == list(range(1, len(numbers) + 1))
    return [r["sql"] for r in got[:-1]]


def test_plain(spark):
    assert split(spark, "SELECT 1;\nSELECT 'a;b''c' ; -- end; \n /* x; */ SELECT \"d;e\"") == [
        "SELECT 1",
        "SELECT 'a;b''c'",
        'SELECT "d;e"',
    ]
    assert split(spark, "") == []
    assert split(spark, " ;; -- only\n;") == []
    assert split(spark, "a -- b; c\n+ d;e") == ["a -- b; c\n+ d", "e"]
    assert split(spark, "a - b / c $ 'x") == ["a - b / c $ 'x"]
    assert split(spark, "SELECT 1 // 2; x") == ["SELECT 1 // 2", "x"]


def test_dialect_quotes(spark):
    text = "CREATE FUNCTION f AS $$ a; b $$; // c; d\nx"
    assert split(spark, text, "timeplus") == ["CREATE FUNCTION f AS $$ a; b $$", "x"]
    assert split(spark, "a $t$ x; $$ ; $t$; b", "ignite") == ["a $t$ x; $$ ; $t$", "b"]


def test_blocks(spark):
    text = (
        "create procedure p() begin\n if a then x; elseif b then y; end if;\n"
        " while c do z; end while; loop w; end loop; repeat v; until d end repeat;\n"
        " set e = case when f then 1 else 2 end; end;\nselect 1;"
    )
    got = split(spark, text, "db2z")
    assert len(got) == 2 and got[0].endswith("end; end") and got[1] == "select 1"


def test_block_words_that_open_nothing(spark):
    texts = [
        "DROP TABLE IF EXISTS a",
        "CREATE UNIQUE INDEX IF NOT EXISTS b",
        "CREATE TABLE t (s TIMESTAMP GENERATED ALWAYS AS ROW BEGIN, e TIMESTAMP GENERATED AS ROW END)",
        "INSERT INTO begin_log VALUES (1)",
    ]
    assert split(spark, ";\n".join(texts), "db2z") == texts


def test_stray_end_is_ignored(spark):
    assert split(spark, "x END; y; BEGIN z; END; w", "db2z") == ["x END", "y", "BEGIN z; END", "w"]


def test_terminator(spark):
    text = "a;\n--#SET TERMINATOR @\nb; c@ d@\n--#other\n--#SET TERMINATOR ;\ne; f@"
    assert split(spark, text, "db2z") == ["a", "b; c", "d", "e", "f@"]


def test_long_script(spark):
    text = ";\n".join(f"INSERT INTO t VALUES ({n}, 'x;{n}')" for n in range(20_000))
    assert len(split(spark, text)) == 20_000


def test_classify(spark):
    rows = ["create table t", "select 'drop' from t", "-- drop\n insert into x", "ALTER t", "select created from drops", "call p()", "select 1 from \"alter\""]
    df = spark.createDataFrame([("p", n, sql) for n, sql in enumerate(rows)], "path string, stmt_no int, sql string")
    got = [(r["kind"], r["transactional"]) for r in statements.classify_statements(df).orderBy("stmt_no").collect()]
    assert got == [
        ("CREATE", False),
        ("SELECT", True),
        ("INSERT", True),
        ("ALTER", False),
        ("SELECT", True),
        ("CALL", True),
        ("SELECT", True),
    ]


def test_calls(spark):
    rows = ["CALL SYSPROC.DSNUTILU('a''b, (c)', -12, null, X'01', 2147483648)", "call p()", "CALLED(1)", "SELECT 1"]
    df = spark.createDataFrame([("p", n, sql) for n, sql in enumerate(rows)], "path string, stmt_no int, sql string")
    got = statements.extract_calls(df).orderBy("arg_no").collect()
    assert {r["procedure"] for r in got} == {"SYSPROC.DSNUTILU"}
    assert [(r["arg_no"], r["kind"], r["str_value"], r["int_value"]) for r in got] == [
        (1, "string", "a'b, (c)", None),
        (2, "int", None, -12),
        (3, "null", None, None),
        (4, "raw", "X'01'", None),
        (5, "raw", "2147483648", None),
    ]


def test_calls_with_comments_or_without_arguments(spark):
    rows = [
        "CALL p(1) -- note", "CALL q(2) /* x */", "/* a */ CALL r /* b */ ('', '-- no; /* x */', /* c, ( */ 3)", "CALL s()", "call app.t", "CALL u( ) -- ()",
        "CALL v w", "SELECT 1 -- CALL x(1)",
    ]
    df = spark.createDataFrame([("p", n, sql) for n, sql in enumerate(rows)], "path string, stmt_no int, sql string")
    columns = ["stmt_no", "procedure", "arg_no", "kind", "str_value", "int_value"]
    got = [tuple(r) for r in statements.extract_calls(df, bare=True).select(columns).orderBy("stmt_no", "arg_no").collect()]
    with_arguments = [
        (0, "p", 1, "int", None, 1), (1, "q", 1, "int", None, 2),
        (2, "r", 1, "string", "", None), (2, "r", 2, "string", "-- no; /* x */", None), (2, "r", 3, "int", None, 3),
    ]
    assert got == [*with_arguments, *((n, p, None, None, None, None) for n, p in [(3, "s"), (4, "app.t"), (5, "u")])]
    assert [tuple(r) for r in statements.extract_calls(df).select(columns).orderBy("stmt_no", "arg_no").collect()] == with_arguments


@pytest.mark.parametrize(
    "server, dialect",
    [
        (("jdbc:mysql://h", "MySQL", "8.0", "OceanBase 4.2"), "oceanbase"),
        (("jdbc:mysql://h", "MySQL", "5.7-TiDB-v6", "x"), "tidb"),
        (("jdbc:mysql://h", "MySQL", "5.7", None), "mysql"),
        (("jdbc:postgresql://h", "PostgreSQL", "11", "PostgreSQL 11.2-YB-2.1 on x"), "yugabytedb"),
        (("jdbc:postgresql://h", "PostgreSQL", "11", "PostgreSQL 11.2-yb-2.1"), "postgresql"),
        (("jdbc:postgresql://h", "PostgreSQL", "12", "PostgreSQL 12.3, QuestDB"), "questdb"),
        (("jdbc:db2://h", "DB2", "DSN12", ""), "db2z"),
        (("jdbc:db2://h", "DB2/NT64", "SQL11", ""), "db2"),
        (("jdbc:IRIS://h", "InterSystems IRIS", "2018.1", ""), None),
        (("jdbc:IRIS://h", "InterSystems IRIS", "2021.1", ""), "iris"),
        (("jdbc:duckdb:", "DuckDB", "1", ""), "duckdb"),
        ((None, "DuckDB", "1", ""), None),
    ],
)
def test_dialects(spark, server, dialect):
    df = spark.createDataFrame([server], "url string, product string, product_version string, version_text string")
    assert fleet.detect_dialect(df).first()["dialect"] == dialect


def test_version_gate(spark):
    rows = [("db2z", "12.0"), ("db2z", "12.1"), ("db2z", "13.2"), ("tidb", "5.0.0"), ("iris", "2018.9"), ("duckdb", "0.1"), ("tidb", "x")]
    df = spark.createDataFrame(rows, "dialect string, version string")
    assert [r["status"] for r in fleet.version_gate(df).collect()] == [
        "too_old",
        "ok",
        "newer_than_known",
        "ok",
        "too_old",
        "ok",
        "unknown",
    ]


def test_pieces_stay_in_their_task(spark):
    """Only whole scripts are dealt to the tasks: no sort, window or second shuffle of their many pieces."""
    text = "BEGIN a; END; /* ; */ CREATE TABLE IF NOT EXISTS b; " * 2_000
    df = spark.createDataFrame([(7, text), (8, None)], "path long, text string")
    got = statements.split_statements(df, "db2z")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan and "Sort" not in plan
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [("path", "bigint"), ("stmt_no", "int"), ("sql", "string")]
    rows = got.orderBy("stmt_no").collect()
    assert [(r["path"], r["stmt_no"]) for r in rows] == [(7, n) for n in range(1, 4_001)]
    assert {r["sql"] for r in rows} == {"BEGIN a; END", "CREATE TABLE IF NOT EXISTS b"}

import pytest
from pyspark.sql import functions as F

from tidemark.functions.macros import non_empty_text
from tidemark.operators import constraints as c
from tidemark.operators import groups, layers, objects, refs
from tidemark.operators.sequences import assign_sequence, next_position


def test_fk_violations(spark, rows_of):
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    child = spark.createDataFrame([(1, 1), (2, 9), (3, None), (4, 9)], "n int, ref int")
    assert rows_of(c_df := refs.fk_violations(child, "ref", parent, "id")) == [(2, 9), (4, 9)]
    assert c_df.columns == ["n", "ref"]
    same = spark.createDataFrame([(1, None), (2, 1), (3, 7), (4, 4)], "id int, ref int")
    assert rows_of(refs.fk_violations(same, "ref", same, "id")) == [(3, 7)]


def test_row_ref_counts(spark, rows_of):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(1,), (1,), (None,), (5,)], "ref int")
    assert rows_of(refs.row_ref_counts(parent, child, "id", "ref")) == [(1, 2), (2, 0)]


def test_incoming_refs(spark, rows_of):
    tables = spark.createDataFrame([("a",), ("b",), ("loop",)], "table_name string")
    links = spark.createDataFrame(
        [("s", "fk_ab", "s", "pk_a"), ("s", "fk_loop", "s", "pk_loop"), ("s", "fk_two", "s", "pk_a2")],
        "constraint_schema string, constraint_name string, unique_constraint_schema string, unique_constraint_name string",
    )
    keys = [
        ("pk_a", "a", "id"),
        ("pk_a2", "a", "x"),
        ("pk_a2", "a", "y"),
        ("pk_loop", "loop", "id"),
        ("fk_ab", "b", "a_id"),
        ("fk_two", "b", "x"),
        ("fk_two", "b", "y"),
        ("fk_loop", "loop", "parent"),
    ]
    cols = spark.createDataFrame(
        [("s", *k) for k in keys],
        "constraint_schema string, constraint_name string, table_name string, column_name string",
    )
    expected = [("a", 5, 2), ("b", 0, 0), ("loop", 0, 0)]
    assert rows_of(refs.incoming_refs(tables, links, cols, schema="s")) == expected


def test_incoming_refs_of_several_schemas(spark, rows_of):
    tables = spark.createDataFrame([("A", "t"), ("B", "t"), ("B", "u"), ("A", "v")], "table_schema string, table_name string")
    links = spark.createDataFrame(
        [("A", "fk_v", "A", "pk_t"), ("B", "fk_u", "B", "pk_t"), ("B", "fk_u2", "B", "pk_t"), ("A", "fk_t", "B", "pk_t"), ("B", "fk_t", "B", "pk_t")],
        "constraint_schema string, constraint_name string, unique_constraint_schema string, unique_constraint_name string",
    )
    keys = [("A", "pk_t", "t"), ("B", "pk_t", "t"), ("A", "fk_v", "v"), ("B", "fk_u", "u"), ("B", "fk_u2", "u"), ("A", "fk_t", "t"), ("B", "fk_t", "t")]
    cols = spark.createDataFrame([(*k, "c") for k in keys], "constraint_schema string, constraint_name string, table_name string, column_name string")
    expected = [("A", "t", 1, 1), ("A", "v", 0, 0), ("B", "t", 3, 3), ("B", "u", 0, 0)]
    assert rows_of(refs.incoming_refs(tables, links, cols)) == expected
    with pytest.raises(ValueError, match="table_schema"):
        refs.incoming_refs(tables.drop("table_schema"), links, cols)


def test_independent_objects(spark, rows_of):
    listed = spark.createDataFrame([("s", "a"), ("s", "b"), ("t", "a")], "schema string, name string")
    used = spark.createDataFrame([("s", "a"), ("s", "a")], "schema string, name string")
    assert rows_of(refs.independent_objects(listed, used, ["schema", "name"])) == [("s", "b"), ("t", "a")]


def peel(spark, nodes, edges):
    n = spark.createDataFrame([(x,) for x in nodes], "node string")
    e = spark.createDataFrame(edges, "src string, dst string")
    return {r["node"]: r["layer"] for r in layers.peel_layers(n, e).collect()}


def test_layers(spark):
    assert peel(spark, "abcd", [("a", "b"), ("b", "c"), ("a", "c"), ("c", "c")]) == {"a": 0, "b": 1, "c": 2, "d": 0}
    assert peel(spark, "ab", []) == {"a": 0, "b": 0}
    assert peel(spark, "ab", [("a", "a"), ("a", "z")]) == {"a": 0, "b": 0}


def test_layers_blocked(spark):
    with pytest.raises(layers.BlockedObjects, match="3 objects"):
        peel(spark, "abcd", [("a", "b"), ("b", "c"), ("c", "b"), ("c", "d")])
    with pytest.raises(layers.BlockedObjects, match="outside"):
        peel(spark, "ab", [("z", "a")])


def test_layers_name_the_cycle(spark):
    # a leads in, e and f lead out; the way b-c-d-b is the cycle.
    edges = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "b"), ("d", "e"), ("e", "f")]
    with pytest.raises(layers.BlockedObjects, match="in cycles: b, c, d$"):
        peel(spark, "abcdef", edges)
    with pytest.raises(layers.BlockedObjects, match="3 objects remain.*in cycles: x, y, z$"):
        peel(spark, "abxyz", [("a", "b"), ("x", "y"), ("y", "z"), ("z", "x")])


def test_layers_of_mixed_graphs(spark):
    import random

    for seed in range(4):
        rng = random.Random(seed)
        names = [f"n{k}" for k in range(60)]
        # Mostly chains, with some edges across; sources have smaller numbers.
        edges = {(names[k], names[k + 1]) for k in range(59) if k % 13} | {
            (names[i], names[j]) for i, j in (sorted(rng.sample(range(60), 2)) for _ in range(seed * 6))
        }
        want = {n: 0 for n in names}
        for n in names:
            for a, b in edges:
                if a == n:
                    want[b] = max(want[b], want[a] + 1)
        for n in names:  # edges go up, so one pass in order is enough
            want[n] = max([0, *(want[a] + 1 for a, b in edges if b == n)])
        assert peel(spark, names, sorted(edges)) == want


def test_layers_of_a_long_chain(spark, monkeypatch):
    n, rounds = 100_000, []
    saved = layers.save
    monkeypatch.setattr(layers, "save", lambda df, label: rounds.append(label) or saved(df, label))
    nodes = spark.range(n).select(F.col("id").alias("node"))
    edges = spark.range(n - 1).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    found = layers.peel_layers(nodes, edges)
    assert found.where("layer <> node").count() == 0 and found.count() == n
    assert len(rounds) < 32


def test_clean_plan(spark):
    rows = [
        ("s", "parent", "TABLE", False),
        ("s", "child", "TABLE", False),
        ("s", "v", "VIEW", False),
        ("s", "m", "MACRO", False),
        ("s", "hidden", "VIEW", True),
        ("s", "telemetry", "TABLE", False),
        ("s", "p", "PROCEDURE", False),
    ]
    listed = spark.createDataFrame(rows, "schema string, name string, kind string, internal boolean")
    edges = spark.createDataFrame([("s.child", "s.parent"), ("s.parent", "s.parent")], "src string, dst string")
    assert [r["statement"] for r in layers.clean_plan(listed, edges, "duckdb").collect()] == [
        'DROP MACRO "s"."m" CASCADE',
        'DROP VIEW "s"."v" CASCADE',
        'DROP TABLE "s"."child" CASCADE',
        'DROP TABLE "s"."parent" CASCADE',
    ]
    plan = [r["statement"] for r in layers.clean_plan(listed, edges, "databricks").collect()]
    assert plan == ["DROP TABLE `s`.`child`", "DROP TABLE `s`.`parent`", "DROP VIEW `s`.`v`"]


def test_insert_if_absent(spark, rows_of):
    old = spark.createDataFrame([(1, "a", 1.0)], "id int, name string, v double")
    new = spark.createDataFrame([(9.0, 1, "x"), (2.0, 2, "y"), (1.0, 2, "z"), (3.0, 3, None)], "v double, id int, name string")
    got = c.insert_if_absent(old, new, ["id"], order=["v"])
    assert rows_of(got) == [(1, "a", 1.0), (2, "z", 1.0), (3, None, 3.0)]
    keys = c.insert_if_absent(old.select("id"), new.select("id"), ["id"])
    assert rows_of(keys) == [(1,), (2,), (3,)]


def test_key_and_null_checks(spark, rows_of):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, None), (2, None), (3, "c")], "a int, b string")
    assert rows_of(c.duplicate_keys(df, ["a", "b"])) == [(1, "a", 2, "duplicate"), (2, None, 2, "null"), (None, "b", 1, "null")]
    assert rows_of(c.null_violations(df, ["a", "b"])) == [("a", 1), ("b", 2)]


def test_check_passes_unknown(spark, rows_of):
    df = spark.createDataFrame([(1,), (5,), (None,)], "a int")
    assert rows_of(c.check_violations(df, "small", F.col("a") < 3)) == [(5, "small")]
    text = spark.createDataFrame([("ab",), ("abc",), (None,)], "t string")
    assert rows_of(c.check_violations(text, "len", c.max_length("t", 2))) == [("abc", "len")]


def test_objects(spark, rows_of):
    rows = [
        ("s", "a  ", "T", "me", False),
        ("s", "SYS.x", "T", "me", False),
        ("s", "sys.x", "T", "me", False),
        ("s", "Telemetry_Config", "T", "me", False),
        ("s", "__T0", "T", "me", False),
        ("s", "v", "V", "you", False),
        ("s", "hidden", "V", "you", True),
    ]
    df = spark.createDataFrame(rows, "schema string, name string, kind string, owner string, internal boolean")
    assert rows_of(objects.user_objects(df), "name") == [("SYS.x",), ("a  ",), ("v",)]
    assert rows_of(objects.objects_of_kind(df, ["T"], "me", "s"), "name")[-1] == ("sys.x",)
    assert ("a",) in rows_of(objects.objects_of_kind(df, ["T"]), "name")
    asked = spark.createDataFrame([("s", "v"), ("s", "V"), ("x", "v")], "schema string, name string")
    assert rows_of(objects.exists_many(asked, df.unionAll(df), ["schema", "name"])) == [
        ("s", "V", False),
        ("s", "v", True),
        ("x", "v", False),
    ]
    schemas = spark.createDataFrame([("s",), ("empty",)], "schema string")
    assert rows_of(objects.emptiness(schemas, df, ["T", "V"])) == [("empty", 0, 0, 0, True), ("s", 5, 2, 7, False)]
    left = objects.tables_without_views(df, df.filter("kind = 'V'"), ["schema", "name"])
    assert left.count() == 5
    assert objects.all_objects({"A": asked, "B": asked}).groupBy("kind").count().count() == 2


def test_call_outcome(spark):
    bad = "DSNUGBAC - UTILITY EXECUTION TERMINATED, HIGHEST RETURN CODE=8"
    rows = [(1, 1, "start"), (1, 2, bad), (2, 1, bad), (2, 2, "done"), (3, 1, None), (4, 10, "late " + bad), (4, 9, None)]
    df = spark.createDataFrame(rows, "call_id long, row_no int, message string")
    got = {r["call_id"]: (r["n_messages"], r["failed"], r["error_text"]) for r in groups.call_outcome(df).collect()}
    assert got == {
        1: (2, True, f"DSNUTILU TERMINATED WITH OUTPUT:\nstart\n{bad}\n"),
        2: (2, False, None),
        3: (1, False, None),
        4: (2, True, f"DSNUTILU TERMINATED WITH OUTPUT:\n\nlate {bad}\n"),
    }
    assert groups.failed_messages(df).count() == 4


def test_groups(spark, rows_of):
    df = spark.createDataFrame([("k", "a", 2), ("k", "b", 1), ("j", "a", 3), ("j", "a", 4)], "key string, who string, n int")
    assert rows_of(groups.competing_holders(df, ["key"], "who")) == [("k", 2)]
    assert rows_of(groups.first_per_group(df, ["key"], ["n"])) == [("j", "a", 3), ("k", "b", 1)]


def test_table_diff(spark, rows_of):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "a int, b string")
    b = spark.createDataFrame([("x", 1), (None, 2), ("y", 3)], "b string, a int")
    assert rows_of(groups.table_diff(a, b)) == [(1, "x", "left", 1), (3, "y", "right", 1)]
    assert groups.same_rows(a, a.select("a", "b")) and not groups.same_rows(a, a.distinct())
    assert groups.same_set(a, a.distinct()) and not groups.same_set(a, b)


def test_non_empty_text(spark, rows_of):
    df = spark.createDataFrame([(1, "x"), (2, ""), (3, None), (4, " ")], "id int, text string")
    assert rows_of(non_empty_text(df, "text"), "id") == [(1,), (4,)]


def test_sequence_is_dense_with_a_hot_key(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, 7).otherwise(F.col("id")).alias("k"), "id")
    got = assign_sequence(df.repartition(7), ["k", "id"], start=5).collect()
    expected = sorted((r["k"], r["id"]) for r in got)
    assert [(r["k"], r["id"]) for r in sorted(got, key=lambda r: r["seq"])] == expected
    assert sorted(r["seq"] for r in got) == list(range(5, 1005))
    assert assign_sequence(df.filter("id < 0"), ["id"]).count() == 0


def test_next_position_across_blocks(spark):
    rows = [(p, "a" if p % 3 else "b", p % 7 == 0) for p in range(200)]
    df = spark.createDataFrame(rows, "pos long, k string, hit boolean")
    got = next_position(df, ["k"], "pos", F.when(F.col("hit"), F.col("pos")), "nxt", block_bits=3)
    for r in got.collect():
        later = [p for p, k, hit in rows if k == r["k"] and hit and p > r["pos"]]
        assert r["nxt"] == (min(later) if later else None)


def test_incoming_refs_sorts_by_name_first(spark):
    """Schemas are few, so rows sorted by them first are compared in full."""
    tables = spark.createDataFrame([("s", "t")], "table_schema string, table_name string")
    cols = spark.createDataFrame([("s", "fk", "t")], "constraint_schema string, constraint_name string, table_name string")
    names = "constraint_schema string, constraint_name string, unique_constraint_schema string, unique_constraint_name string"
    links = spark.createDataFrame([("s", "fk", "s", "pk")], names)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = refs.incoming_refs(tables, links, cols)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin [constraint_name" in plan and "SortMergeJoin [unique_constraint_name" in plan

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm.contamination import contained, decontaminated
from tidemark.llm.exact import CHUNK, drop_exact_copies, exact_groups
from tidemark.llm.jaccard import one_of_each
from tidemark.llm.licences import learn, licence_paragraphs
from tidemark.llm.lines import drop_repeated_lines
from tidemark.llm.shards import lookup_table, place


def test_exact_groups(documents, rows_of):
    long = "The ferry at four. " * 5000
    docs = documents((1, "a"), (2, "a"), (3, None), (4, ""), (5, "a "), (6, long), (7, long + "x"), (8, long), (None, "a"), extra="1 AS row;2 AS recipe")
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_groups(docs).collect()}
    assert got == {
        (1, 2, 3, False), (2, 2, 3, True), (None, 2, 3, False), (3, 4, 2, False), (4, 4, 2, True), (5, 5, 1, True),
        (6, 8, 2, False), (7, 7, 1, True), (8, 8, 2, True),
    }
    assert rows_of(drop_exact_copies(docs), "doc_id") == [(2,), (4,), (5,), (7,), (8,)]
    assert exact_groups(docs.where("false")).count() == 0


def test_exact_keeps_one_of_repeated_rows(documents, rows_of):
    docs = documents((1, "a"), (1, "a"), (1, "b"), (0, "a"))
    assert rows_of(exact_groups(docs), "doc_id", "keep_id", "group_size", "kept") == [
        (0, 1, 3, False), (1, 1, 1, True), (1, 1, 3, False), (1, 1, 3, True),
    ]
    assert rows_of(drop_exact_copies(docs), "doc_id", "text") == [(1, "a"), (1, "b")]


def test_chunks_make_up_the_text_and_follow_its_content(documents):
    rng = random.Random(1)
    text = " ".join(rng.choice(["the", "fast", "feet", "tall", "to", "of", "a", "river"]) + "x" * rng.randint(0, 9) for _ in range(6000))
    docs = documents((0, text), (1, "moved by this " + text), (2, "日本" * 5000))
    rows = docs.select("text", F.regexp_extract_all("text", F.lit(CHUNK), F.lit(0)).alias("c")).collect()
    assert all("".join(r.c) == r.text for r in rows)
    assert len(set(rows[0].c) & set(rows[1].c)) > len(rows[0].c) / 2


def test_repeated_lines(documents, rows_of):
    a, b, c, d, e = "one", "two", "three", "four", "five"
    docs = documents(
        (1, "\n".join([a, b, c, d])), (2, "\n".join([e, a, b, c, d, e])), (3, "\n".join([a, b])), (4, "\n".join([b, c, d])),
        (5, None), (6, ""), (7, "\n\n\n\n"), (8, "\n\n\n\n"), (9, "\n".join([e] * 5)), extra="3 AS n_lines;4 AS at",
    )
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in drop_repeated_lines(docs).collect()}
    assert got == {
        1: ("one\ntwo\nthree\nfour", 4, 0), 2: ("five\nfive", 6, 4), 3: ("one\ntwo", 2, 0), 4: ("", 3, 3), 5: (None, 0, 0), 6: ("", 1, 0),
        7: ("\n\n\n\n", 5, 0), 8: ("\n\n\n\n", 5, 0), 9: ("five", 5, 4),
    }
    assert drop_repeated_lines(docs).columns == ["doc_id", "text", "at", "n_lines", "n_removed"]
    assert drop_repeated_lines(docs.where("false")).count() == 0


def test_lookup_table_is_even_and_stable():
    names = [f"s{k}" for k in range(10)]
    table = lookup_table(names, 1009)
    shares = [table.count(k) for k in range(10)]
    assert max(shares) - min(shares) <= 1 and sum(shares) == 1009
    fewer = lookup_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 9)
    assert moved < 1009 / 5
    for wrong in ((names, 1000), (names, 7), ([], 7)):
        with pytest.raises(ValueError):
            lookup_table(*wrong)


def test_place(documents, rows_of):
    docs = documents((1, "x"), (1, "y"), (None, "z"), extra="'mine' AS shard")
    rows = place(docs, F.col("doc_id"), ["a", "b", "c"], 101).collect()
    assert len(rows) == 3 and all(r.shard in "abc" for r in rows)
    assert len({r.slot for r in rows if r.doc_id == 1}) == 1
    assert place(docs.where("false"), F.col("doc_id"), ["a"], 3).count() == 0


def test_contained_items(spark, documents, rows_of):
    item = " ".join(f"q{k}" for k in range(40))
    most = " ".join(f"q{k}" for k in range(31))  # 27 of 36 shingles
    less = " ".join(f"q{k}" for k in range(30))
    long = " ".join(f"w{k}" for k in range(20_000))
    docs = documents(
        (1, f"{long} {item.upper()} {long}"), (2, most), (3, less), (4, None), (5, ""), (6, "zero One\ttwo three"), (7, "one x two"),
        (None, item), extra="1 AS item;2 AS words",
    )
    items = spark.createDataFrame([(10, item), (11, "one two"), (12, None), (13, " "), (14, item), (None, item)], "item_id long, text string")
    assert rows_of(contained(docs, items), "doc_id", "item_id", "n_item", "n_shared") == [
        (1, 10, 36, 36), (1, 14, 36, 36), (2, 10, 36, 27), (2, 14, 36, 27), (6, 11, 1, 1),
    ]
    assert rows_of(decontaminated(docs, items), "doc_id") == sorted([(3,), (4,), (5,), (7,), (None,)], key=repr)
    assert contained(docs, items.where("false")).count() == 0 and contained(docs.where("false"), items).count() == 0


def test_licences(documents, rows_of):
    plain = [f"The ferry number {k} leaves the old harbour at noon and returns with the tide." for k in range(60)]
    docs = documents(
        *enumerate(plain), (100, "Some words.\nReleased under the MIT License.\nMore words."), (101, "licensed under the apache license, version 2.0"),
        (102, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
        (103, "A licence to sail is needed on the lake."), (104, None), (105, ""), (None, "All rights reserved."), extra="1 AS family;2 AS p",
    )
    found = licence_paragraphs(docs, learn(docs))
    assert rows_of(found.where("confirmed"), "doc_id", "paragraph", "family") == sorted(
        [(100, 1, "MIT"), (101, 0, "Apache-2.0"), (102, 0, "GPL"), (None, 0, "Proprietary")], key=repr
    )
    assert licence_paragraphs(docs.where("false"), learn(docs)).count() == 0


NAMES = "doc sign starts lines id digest sha gone winner _id _digest _sha _gone _sign _lines __id component stays times".split()


@pytest.mark.parametrize("work", [drop_repeated_lines, drop_exact_copies, one_of_each, lambda docs: decontaminated(docs, docs.sparkSession.createDataFrame([(1, "p q r s t u")], "item_id long, text string"))])
def test_own_columns_of_any_name_stay(documents, rows_of, work):
    docs = documents((1, "a\nb\nc\nd"), (2, "a\nb\nc\nd"), (2, "a\nb\nc\nd"), (3, "p q r s t u"), (None, None), extra=";".join(f"'{n}' AS {n}" for n in NAMES))
    got = work(docs)
    assert got.columns[:2] == ["doc_id", "text"] and set(NAMES) <= set(got.columns)
    kept = {
        drop_repeated_lines: [1, 2, 2, 3, None], drop_exact_copies: [2, 3, None], one_of_each: [1, 3, None],
    }.get(work, [1, 2, 2, None])
    rows = got.collect()
    assert sorted((r.doc_id for r in rows), key=repr) == sorted(kept, key=repr)
    assert all(r[n] == n for r in rows for n in NAMES)

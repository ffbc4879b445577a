import hashlib
import itertools
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from tidemark.llm import conversations
from tidemark.llm.conversations import damaged, messages, repair, report

SHAPE = re.compile(r"\A(s?(ua)+)?\Z")
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        said = lambda v: " " if v is None else str(v)
        fate = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        role, text = said(role), said(text)
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def faults(rows):
    found, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(" \t\n\r\x0b\x0c")
        found.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def cheapest(rows, flaws):
    """Every path of edits, by plain recursion over messages done and roles written."""
    step = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, last):
        options = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
        options += [(c + 5, "I" + a, ((n, ""), *m)) for n in step[last] if n != "s" for c, a, m in [inserted(i, n)]]
        return min([*options, *moved(i, last)])

    @lru_cache(None)
    def inserted(i, last):  # after one insertion another may follow, and then a message must
        options = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
        if last == "u":
            again = [(0, "", ())] if i == len(rows) else []
            options += [(c + 5, "I" + a, (("a", ""), *m)) for c, a, m in [*again, *moved(i, "a")]]
        return min([*options, *moved(i, last)], default=(10**9, "", ()))

    def moved(i, last):
        if i == len(rows):
            return
        _, role, text = rows[i]
        c, a, m = best(i + 1, last)
        yield c + 2, "D" + a, m
        if flaws[i] not in ("b", "d"):
            more = 5 * (flaws[i] == "t")
            if role[:1] and role[0] in step[last]:
                c, a, m = best(i + 1, role[0])
                yield c + more, "K" + a, ((role, text), *m)
            for n in step[last].replace("s", ""):
                c, a, m = best(i + 1, n)
                yield c + more + 1, "R" + a, (({"u": "user", "a": "assistant"}[n], text), *m)

    import sys

    sys.setrecursionlimit(20_000)
    return best(0, "")


def brute(given, rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn, role, text))
    out = []
    for conv in {r[0] for r in given}:
        mine = sorted(by_conv[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        flaws = faults(mine)
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in itertools.pairwise(mine))
        cost, audit, left = cheapest(mine, flaws)
        assert SHAPE.match("".join(r[:1] for r, _ in left).replace("user", "u"))
        full = {"u": "user", "a": "assistant"}
        text = "\n".join(f"{full.get(r, r)}:{t}" for r, t in left)
        out.append((conv, gaps, flaws.count("b"), flaws.count("d"), flaws.count("t"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


HARD = [
    (1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 2, "assistant", "Hi."), (1, 9, "user", "no end"),
    (2, None, None, None), (2, None, "user", "Late?"), (2, 3, "tool", "Out."), (2, 3, "tool", "Out."), (2, 3, "", "x!"),
    (None, 0, "user", "a."), (None, None, "assistant", "b."), (3, 5, "system", ""), (4, 1, "user", " \t\n"), (5, 2, "user", "é?"),
    (6, 1, "user", "One."), (6, 1, "assistant", "Two."), (6, 2, "user", "One."), (6, 4, "assistant", "Two."), (7, 1, "U", "Capital."),
]


def test_equals_brute_force_on_hard_rows(spark, rows_of):
    rows = table(spark, HARD)
    assert rows_of(report(rows, repair(rows)), *COLUMNS) == brute(HARD, [(c, t, r or " " if r is None else r, " " if x is None else x) for c, t, r, x in HARD])


def test_equals_brute_force_on_all_short_orders(spark, rows_of):
    kinds = [("system", "s."), ("user", "u."), ("assistant", "a."), ("user", "cut"), ("user", "")]
    rows = [
        (n, k, role, text if text in ("", "cut") else f"{k}{text}")
        for n, chosen in enumerate(itertools.chain.from_iterable(itertools.product(kinds, repeat=m) for m in range(1, 5)))
        for k, (role, text) in enumerate(chosen)
    ]
    assert rows_of(report(table(spark, rows), repair(table(spark, rows))), *COLUMNS) == brute(rows, rows)


def test_query_equals_brute_force_on_the_given_table(spark, rows_of):
    given = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in given.select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(report(given, repair(damaged(given))), *COLUMNS) == brute(rows, hurt(rows))


def test_long_conversations_are_solved_in_parts(spark, rows_of, monkeypatch):
    given = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("turn", "role", "text").collect()]
    rows = [(n % 2, k if k % 7 else None, role, text) for n in range(2) for k, (_, role, text) in enumerate(given[: 60 + 20 * n])]
    rows += [(0, 3, "user", "again.")] * 40 + [(9, 0, "user", "short.")]
    monkeypatch.setattr(conversations, "PART", 8)
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(conversations)  # so that tasks see the small parts
    try:
        found = repair(table(spark, rows))
        assert found.where("part > 3").count() > 5
        assert rows_of(report(table(spark, rows), found), *COLUMNS) == brute(rows, rows)
    finally:
        cloudpickle.unregister_pickle_by_value(conversations)


def test_messages_and_other_columns(spark, rows_of):
    rows = table(spark, [(1, 0, "assistant", "x.")]).selectExpr("*", "1 as part", "2 as blank", "3 as long_id", "4 as times")
    found = repair(rows)
    assert rows_of(messages(found), "conv_id", "position", "role", "text") == []
    assert rows_of(found, "audit", "cost") == [("D", 2)]
    assert repair(rows.where("false")).count() == report(rows.where("false"), repair(rows.where("false"))).count() == 0


def test_ranks_order_the_audits():
    import numpy as np

    kinds, faults_ = np.array([1, 3, 3, 2, 2, 3, 0, 2]), np.array([0, 0, 2, 3, 0, 0, 0, 1])
    solved = conversations.Solved(kinds, faults_, np.array([8]), conversations.LAST_EXITS[None, :], np.array([True]))

    def audit(node):
        letters = ""
        while solved.label[node]:
            letters += conversations.LETTERS[solved.label[node]]
            node = solved.pointers[0][node]
        return letters

    nodes = range(len(solved.label))
    assert all((audit(a) < audit(b)) == (solved.ranks[a] < solved.ranks[b]) for a in nodes for b in nodes)


@pytest.mark.parametrize("empty", ["conv_id", "turn", "role", "text"])
def test_a_column_of_nulls(spark, rows_of, empty):
    rows = [tuple(None if n == empty else v for n, v in zip(("conv_id", "turn", "role", "text"), r)) for r in HARD]
    clean = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert rows_of(report(table(spark, rows), repair(table(spark, rows))), *COLUMNS) == brute(rows, clean)

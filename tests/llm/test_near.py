import random
import re

import numpy as np
import pytest

from tidemark.llm import near
from tidemark.llm.near import near_components

COLUMNS = ["doc_id", "n_shingles", "component_id", "kept"]


def brute(docs, width=3, percent=85):
    sets = []
    for _, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set()))
    group = list(range(len(docs)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {k for x in s for k in holders[x] if k < i}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                group[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        r = root(i)
        if d is not None and (low.get(r) is None or d < low[r]):
            low[r] = d
    out = [(d, len(s), c, d == c) for i, ((d, _), s) in enumerate(zip(docs, sets)) for c in [low.get(root(i)) if s else d]]
    return sorted(out, key=repr)


def copies(groups, size, edits, words=90, seed=1):
    """Groups of texts that differ from each other in some words each."""
    rng = random.Random(seed)
    texts = []
    for g in range(groups):
        base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(edits + 1)):
                text[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(text))
    return texts


def test_hard_rows(documents, rows_of):
    docs = [
        (5, "One two three four"), (3, "one TWO three four"), (9, "one two"), (2, "one  two\n"), (8, ""), (7, None), (6, " \t"), (1, "É two three"), (4, "é two three"),
        (None, "one two three four"), (None, "alone among the others"), (5, "one two"), (5, "One two three four"), (11, "alone among the others"),
    ]
    found = near_components(documents(*docs, extra="'x' as node;1 as component;'y' as digest;2 as id;3 as n"))
    assert rows_of(found, *COLUMNS) == brute(docs)


def test_empty_table(documents):
    assert near_components(documents("a").where("false")).count() == 0
    assert near_components(documents("", None)).count() == 2


@pytest.mark.parametrize("edits", [2, 4, 8])
def test_equals_brute_force_around_the_threshold(documents, rows_of, edits):
    docs = list(enumerate(copies(40, 5, edits, seed=edits) + copies(1, 60, edits, seed=10 + edits)))
    assert rows_of(near_components(documents(*docs)), *COLUMNS) == brute(docs)


def test_given_documents(spark, rows_of):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert rows_of(near_components(docs), *COLUMNS) == brute([tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("depth", [0, 3])
def test_large_nodes_branch_and_are_compared_in_the_end(documents, rows_of, monkeypatch, depth):
    monkeypatch.setattr(near, "SMALL", 8)
    monkeypatch.setattr(near, "DEPTH", depth)
    docs = list(enumerate(copies(2, 60, 6, seed=3) + copies(10, 3, 3, seed=4)))
    assert rows_of(near_components(documents(*docs)), *COLUMNS) == brute(docs)


def test_very_long_text(documents, rows_of):
    long = " ".join(f"word{n}" for n in range(60_000))
    docs = [(1, long), (2, long + " end"), (3, "word1 word2 word3")]
    assert rows_of(near_components(documents(*docs)), *COLUMNS) == brute(docs)


def test_minwise_tokens_agree_as_often_as_sets_do():
    rng = np.random.default_rng(7)
    shares = []
    for _ in range(40):
        common, one, two = rng.integers(0, 2**64, 170, np.uint64), rng.integers(0, 2**64, 15, np.uint64), rng.integers(0, 2**64, 15, np.uint64)
        shares.append(np.mean(near.minwise(np.concatenate([common, one])) == near.minwise(np.concatenate([common, two]))))
    assert abs(np.mean(shares) - 0.85) < 0.01


@pytest.mark.parametrize("held", [1 << 20, 500])
def test_no_table_holds_the_pairs_of_a_large_group(documents, rows_of, monkeypatch, held):
    """Nearly all pairs of the group come near the threshold, and few of them link."""
    monkeypatch.setattr(near, "HELD", held, raising=False)
    made, save = [], near.save

    def counted(df, label):
        table = save(df, label)
        made.append((table.count(), label))
        return table

    monkeypatch.setattr(near, "save", counted)
    rng = random.Random(6)
    base = [f"w{n}" for n in range(300)]
    texts = [" ".join(f"x{rng.randrange(10**6)}" if n in at else w for n, w in enumerate(base)) for at in (rng.sample(range(300), 5) for _ in range(250))]
    docs = list(enumerate(texts + copies(5, 4, 3, seed=5)))
    assert rows_of(near_components(documents(*docs)), *COLUMNS) == brute(docs)
    assert max(made)[0] <= near.TREES * 4 * len(docs), max(made)

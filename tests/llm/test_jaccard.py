import random
import re

from tidemark.llm.components import components
from tidemark.llm.jaccard import linked_components, one_of_each


def brute(texts, percent=75):
    def cut(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())

    sets = {i: cut(t) for i, t in texts}
    group = {i: i for i in sets}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    return sorted((i, len(sets[i]), group[i]) for i in sets)


def near_copies(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    bases = [[word() for _ in range(rng.choice([3, 5, 8, 40, 120]))] for _ in range(6)]
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
            words[rng.randrange(len(words))] = word()
        yield i, rng.choice([" ", "\n", "\t "]).join(words).upper() if rng.random() < 0.2 else " ".join(words)


def test_same_as_all_pairs(documents, rows_of):
    rows = [*near_copies(1, 150), (900, ""), (901, "  \n"), (902, "one two"), (903, "ONE\ttwo"), (904, "é é é é é é")]
    assert rows_of(linked_components(documents(*rows))) == sorted(brute(rows), key=repr)


def test_chain_of_links_and_other_thresholds(documents, rows_of):
    words = [f"w{k}" for k in range(60)]
    rows = [(10 - n, " ".join(words[3 * n : 3 * n + 40])) for n in range(7)]
    for percent in (75, 90):
        assert rows_of(linked_components(documents(*rows), percent=percent)) == sorted(brute(rows, percent), key=repr)


def test_nulls_repeats_and_long_texts(documents, rows_of):
    long = " ".join(f"w{k % 977}x{k}" for k in range(60_000))
    docs = documents((1, None), (2, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, ""), (5, long), (6, long + " end"))
    got = rows_of(linked_components(docs))
    assert got == sorted(
        [(1, 0, 1), (2, 2, 2), (2, 2, 2), (None, 2, 2), (None, 0, None), (5, 59_996, 5), (6, 59_997, 5)], key=repr
    )


def test_empty_table_and_clashing_columns(documents, rows_of):
    assert rows_of(linked_components(documents((1, "a")).where("false"))) == []
    docs = documents((3, "a b c"), (4, "A b c"), extra="7 AS component_id;8 AS n;9 AS sign;'x' AS id")
    assert rows_of(linked_components(docs)) == [(3, 1, 3), (4, 1, 3)]
    assert rows_of(one_of_each(docs), "doc_id", "id") == [(3, "x")]


def test_components_of_paths_stars_and_loops(spark, rows_of):
    links = [(k, k + 1) for k in range(100, 164)] + [(5, k) for k in range(6, 40)] + [(7, 7), (2, None), (41, 40), (40, 41)]
    got = dict(rows_of(components(spark.createDataFrame(links, "a long, b long"))))
    want = {k: 100 for k in range(100, 165)} | {k: 5 for k in range(5, 40)} | {40: 40, 41: 40}
    assert got == want

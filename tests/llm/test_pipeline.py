import random
import re

import corpus_pipeline
from tidemark.llm.contamination import decontaminated
from tidemark.llm.jaccard import linked_components, one_of_each
from tidemark.session import scratch_path

ORDER = lambda r: (r[0] is None, r[0] or 0, r[1].encode())


def cut(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def groups(rows):
    sets = [cut(t) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    return group


def one_by_hand(rows):
    group = groups(rows)
    kept = [min((r for r, h in zip(rows, group) if h == g), key=ORDER) for g in set(group)]
    return sorted(kept, key=repr)


def clean_by_hand(rows, items):
    held = lambda text: any(i and 100 * len(i & cut(text)) >= 75 * len(i) for i in map(cut, items))
    return [r for r in rows if not held(r[1])]


def exact_by_hand(rows):
    kept = {}
    for doc_id, text in rows:
        if text not in kept or kept[text] is None or (doc_id is not None and doc_id > kept[text]):
            kept[text] = doc_id
    return [(d, t) for t, d in kept.items()]


def fixture(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["ka", "ro", "mi", "tu"]) for _ in range(rng.randint(1, 4)))
    bases = [[word() for _ in range(rng.choice([8, 40, 80]))] for _ in range(12)]
    items = [" ".join(word() for _ in range(12)) for _ in range(3)]
    rows = []
    for _ in range(160):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            words[rng.randrange(len(words))] = word()
        if rng.random() < 0.1:
            words += [*rng.choice(items).split(), *(word() for _ in range(5))]
        rows.append((rng.choice([None, *range(40)]), " ".join(words)))
    return rows + rows[:10], items


def test_near_copies_by_doc_id_and_text(documents, rows_of):
    words = [f"w{k}" for k in range(60)]
    base, near, third = " ".join(words), " ".join(words[:-1] + ["x"]), " ".join(words[:-1] + ["y"])
    clean = "an unrelated clean text of the same identifier"
    rows = [(1, base), (2, near), (2, clean), (2, clean), (3, clean + " a"), (3, clean)]
    assert rows_of(one_of_each(documents(*rows)), "doc_id", "text") == one_by_hand(rows) == [(1, base), (2, clean)]
    rows = [(5, third), (5, near), (7, base)]
    assert rows_of(one_of_each(documents(*rows)), "doc_id", "text") == [(5, near)]
    rows = [(None, base), (None, near), (None, third), (9, clean), (None, clean)]
    assert rows_of(one_of_each(documents(*rows)), "doc_id", "text") == one_by_hand(rows)


def test_links_through_rows_without_an_id(documents, rows_of):
    words = [f"w{k}" for k in range(56)]
    rows = [(1, " ".join(words[:44])), (None, " ".join(words[5:49])), (2, " ".join(words[10:54]))]
    assert len(set(groups(rows))) == 1 and len(set(groups([rows[0], rows[2]]))) == 2
    assert {r.component_id for r in linked_components(documents(*rows)).collect()} == {1}
    rows = [(1, "a b c d e f"), (1, "p q r s t u"), (2, "p q r s t u")]
    got = linked_components(documents(*rows))
    assert rows_of(got) == [(1, 2, 1), (1, 2, 1), (2, 2, 1)]


def test_near_copies_like_brute_force(documents, rows_of):
    rows, _ = fixture(3)
    rows += [(None, "")]
    assert rows_of(one_of_each(documents(*rows)), "doc_id", "text") == one_by_hand(rows)


def test_items_are_found_in_each_row(spark, documents, rows_of):
    item = " ".join(f"q{k}" for k in range(40))
    items = spark.createDataFrame([(1, "other"), (None, item)], "item_id long, text string")
    docs = documents((1, f"x {item}"), (1, "clean"), (None, item), (None, "clean"), (2, None))
    assert rows_of(decontaminated(docs, items), "doc_id", "text") == sorted([(1, "clean"), (2, None), (None, "clean"), (None, item)], key=repr)
    assert rows_of(decontaminated(docs, items, unnamed=True), "doc_id", "text") == sorted([(1, "clean"), (2, None), (None, "clean")], key=repr)


def test_whole_pipeline_like_brute_force(spark, rows_of):
    rows, items = fixture(5)
    folder = scratch_path(spark, "pipeline")
    german = [(1000 + k, " ".join(random.Random(k).choices(["schpfl", "ober", "engober", "pfleng"], k=60)), "yy") for k in range(60)]
    docs = spark.createDataFrame([(i, t, "xx") for i, t in rows] + german, "doc_id long, text string, lang string")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    known = [tuple(r) for r in corpus_pipeline.known_language(spark, docs, folder).select("doc_id", "text").collect()]
    want = clean_by_hand(one_by_hand(exact_by_hand(known)), items)
    assert len(known) > 150 and 10 < len(want) < len(known)
    assert rows_of(corpus_pipeline.run(spark, folder), "doc_id", "text") == sorted(want, key=repr)

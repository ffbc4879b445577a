import random
import re

import numpy as np
import pyarrow as pa

from tidemark.llm import language, pieces, quality
from tidemark.llm.html_text import extract_text, main_text
from tidemark.llm.samples import held_out
from tidemark.llm.words import PIECE, shingle_sets, word_hashes

SYLLABLES = {"xx": ["ka", "ro", "mi", "tu"], "yy": ["sch", "eng", "pfl", "ober"]}


def prose(lang, n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_words_are_those_of_the_pattern():
    texts = ["", None, "a b\tA", " a ", "é\x0bÉ B", "x" * (PIECE + 10) + " y", "b " * PIECE, "\xa0 z"]
    hashes, begins = word_hashes(pa.array(texts))
    known = {}
    for text, begin, end in zip(texts, begins[:-1], begins[1:]):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        assert len(words) == end - begin
        for word, value in zip(words, hashes[begin:end].tolist()):
            assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known)
    assert [len(s) for s in shingle_sets(pa.array(["a b c d e f", "a b", "", "a a a a a a a"]), 5)] == [2, 1, 0, 1]


def test_language_held_out_accuracy_and_odd_rows(spark):
    rows = [(k, prose(lang := ("xx", "yy")[k % 2], 3 + k % 200, k), lang, "s") for k in range(300)]
    rows += [(1000, None, "xx", "s"), (1001, "", None, "s"), (1002, "12 !?", "yy", "s"), (None, prose("xx", 30, 1).upper(), None, "s"), (1003, prose("yy", 60_000, 5), None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    found = language.identify(docs, language.learn(docs)).withColumn("held", held_out()).collect()
    right = [r.lang == r.lang_pred for r in found if r.held and r.doc_id is not None and r.doc_id < 300]
    assert len(right) > 40 and np.mean(right) > 0.95
    odd = {r.doc_id: (r.lang_pred, r.score) for r in found if r.doc_id is None or r.doc_id >= 1000}
    assert odd[1000] == odd[1001] == odd[1002] == ("und", 0.0)
    assert odd[None][0] == "xx" and odd[1003][0] == "yy" and all(0 <= r.score <= 1 for r in found)
    none = docs.where("false")
    assert language.learn(none) is None and language.identify(none, None).count() == 0
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}


def test_pooled_and_scored_alike():
    network = language.train([prose("xx", 30, 1), prose("yy", 30, 2)], ["xx", "yy"])
    windows, counts = language.windows_of(np.frombuffer(prose("xx", 50, 3).encode(), np.uint8)[:150], np.array([0, 0, 100, 150]))
    assert counts.tolist() == [0, 1, 1] and windows.shape == (2, language.WINDOW)
    high, _ = network.pooled(windows)
    logits = np.maximum(high, 0) @ network.dense + network.bias
    want = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    assert np.allclose(network.scores(windows), want, atol=1e-4)


def best_by_table(vocabulary, rare, text):
    """Sums of scores over all ways to cut a short text."""
    scores = {piece: score for piece, _, score in vocabulary.pieces}
    best = [0.0]
    for end in range(1, len(text) + 1):
        ways = [best[b] + scores[text[b:end]] for b in range(end) if text[b:end] in scores]
        best.append(max([*ways, best[end - 1] + rare]))
    return best[-1]


def test_pieces_take_the_best_path():
    vocabulary = pieces.Vocabulary.load()
    encoder = pieces.Encoder(vocabulary)
    score = {i: s for _, i, s in vocabulary.pieces}
    rng = random.Random(3)
    for _ in range(200):
        chunk = "▁" + "".join(rng.choice("etaoin shré日").replace(" ", "") for _ in range(rng.randint(1, 30)))
        ids = encoder.best_path(chunk)
        rare = sum(1 for i in ids if i in vocabulary.bytes_)
        marks = sum(1 for i in ids if i in vocabulary.bytes_ and vocabulary.parts[i][0] & 0xC0 != 0x80)
        got = sum(score[i] for i in ids if i in score) + marks * encoder.rare
        assert abs(got - best_by_table(vocabulary, encoder.rare, chunk)) < 1e-6, (chunk, rare)


def test_pieces_round_trip(documents):
    texts = ["Hello world", " two  spaces ", "a▁b", "▁", "", None, "line\nline\r\n\ttab", "日本語 \U0001f600 \x00", "x" * 50_000, "<s> </s> <0x41>"]
    docs = documents(*texts, extra="array(1) AS ids;'k' AS decoded")
    vocabulary = pieces.Vocabulary.load()
    rows = pieces.decode(pieces.encode(docs, vocabulary), vocabulary).collect()
    assert [r.decoded for r in sorted(rows, key=lambda r: r.doc_id)] == texts
    assert all(r.restored for r in pieces.round_trip(docs, vocabulary).collect())
    assert pieces.round_trip(docs.where("false"), vocabulary).count() == 0
    odd = docs.selectExpr("array(-1, 1, 99999999, null) AS ids").limit(1)
    assert pieces.decode(odd, vocabulary).first().decoded == ""


def test_quality_grades_held_out_rows(spark):
    rng = random.Random(5)
    rows, ratings = [], []
    for k in range(400):
        grade = k % 3
        words = prose("xx", rng.randint(20, 200), k).split()
        if grade == 0:
            words[rng.randrange(len(words))] = "dreadful"
        if grade == 1:
            words = [w + "%%" if rng.random() < 0.5 else w for w in words]
        rows.append((k, " ".join(words), "z"))
        ratings.append((k, grade))
    rows += [(900, None, "z"), (901, " ", "z"), (None, "ka ro", "z"), (902, "ka " * 100_000, "z")]
    ratings += [(5000, 1), (3, None), (4, 7), (None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, selected string")
    model = quality.learn(docs, spark.createDataFrame(ratings, "doc_id long, grade int"), 3)
    assert (np.diff(model.thresholds) >= 0).all()
    found = quality.grade(docs, model).withColumn("held", held_out()).collect()
    right = [r.selected == (r.doc_id % 3 == 2) for r in found if r.held and (r.doc_id or 0) < 400 and r.doc_id is not None]
    assert len(right) > 60 and np.mean(right) > 0.8
    assert all((r.expected_grade, r.selected) == (0.0, False) for r in found if r.doc_id in (900, 901))
    assert all(0 <= r.expected_grade <= 2 and 0 <= r.p_top <= 1 for r in found)
    assert quality.learn(docs, spark.createDataFrame([], "doc_id long, grade int"), 3) is None
    assert not any(r.selected for r in quality.grade(docs, None).collect())


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><a href="/">Home, all, news</a></nav><div class="cookie-notice">We use cookies, many, of them.</div>
<div id="content"><h2>A  &amp; B</h2><p>First, with <b>bold</b>,\n and&nbsp;more text, so that it counts.<p>Second &lt;i&gt; paragraph, unclosed, with commas.
<script>var t = "</p><p>no";</script><ul><li>one, two<li>three</ul><form><input value="x"><p>Sign up, now, here.</p></form>
<div class="comments"><p>Great post, really, thanks, all.</p></div></div>
<div class="side"><a href="/a">link, link, link</a></div><aside><p>See also, this, that.</p></aside><footer>&copy; us, them</footer></body></html>"""


def test_main_text_of_pages():
    assert main_text(PAGE) == "A & B\nFirst, with bold, and more text, so that it counts.\nSecond <i> paragraph, unclosed, with commas.\none, two\nthree"
    assert main_text("<article><h1>T</h1><section><p>a, b, c, d, e</p></section><section><p>f</p></section></article>") == "T\na, b, c, d, e\nf"
    assert main_text("just text &amp more") == "just text & more"
    assert main_text("<p>1 < 2, a <b x='>'>c</b><br>d <!-- no --> e") == "1 < 2, a c d e"
    assert [main_text(x) for x in (None, "", "<script>x", "<!-- ", "<", "<p></p>")] == ["", "", "", "", "<", ""]
    assert main_text("<div>" * 20_000 + "deep, text" + "</div>" * 20_000) == "deep, text"


def test_extract_text_keeps_rows(spark, rows_of):
    pages = spark.createDataFrame([(1, None, "u"), (2, PAGE, "v"), (2, PAGE, "v"), (3, "x" * 300_000, "w")], "page_id long, html string, text string")
    rows = {r.page_id: r.text for r in extract_text(pages).collect()}
    assert rows[1] == "" and rows[2] == main_text(PAGE) and len(rows[3]) == 300_000
    assert extract_text(pages).count() == 4 and extract_text(pages.where("false")).columns == ["page_id", "text"]

import bisect
import hashlib
import itertools
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import alignment
from tidemark.llm.alignment import Aligner, Closed, Pair, align
from tidemark.session import save, small_batches

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def pair():
    return Pair.load()


def brute(docs):
    """Both libraries on whole texts, groups and links by definition."""
    one, two = Tokenizer.from_file(alignment.MODEL_A), sentencepiece.SentencePieceProcessor(model_file=alignment.MODEL_B)
    one.encode_special_tokens = True
    byte_of = alignment._byte_of()
    vocabulary = {i: t for t, i in one.get_vocab().items()}
    bytes_a = lambda i: bytes(byte_of[c] for c in vocabulary[i])
    bytes_b = lambda i: bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode()
    rows, holders = [], Counter()
    for doc_id, text in docs:
        a, b = (one.encode(" " + text, add_special_tokens=False).ids, two.encode(text)) if text else ([], [])
        raw_a, raw_b = b"".join(map(bytes_a, a)), b"".join(map(bytes_b, b))
        if not text or raw_a != (" " + text).encode() or raw_b != raw_a:
            rows.append((doc_id, [], [], [], Counter()))
            continue
        ends_a = list(itertools.accumulate(len(bytes_a(i)) for i in a))
        ends_b = list(itertools.accumulate(len(bytes_b(i)) for i in b))
        cuts = sorted(set(ends_a) & set(ends_b))
        groups = [([], []) for _ in cuts]
        for side, ids, ends in ((0, a, ends_a), (1, b, ends_b)):
            for i, end in zip(ids, ends):
                groups[bisect.bisect_left(cuts, end)][side].append(i)
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        holders.update(links.keys())
        rows.append((doc_id, a, b, groups, links))
    highest = defaultdict(int)
    for (x, _), n in holders.items():
        highest[x] = max(highest[x], n)
    out = []
    for doc_id, a, b, groups, links in rows:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((
            doc_id, len(a), len(b), len(groups), sum(links.values()), sum(n for p, n in links.items() if holders[p] == highest[p[0]]),
            sum(n * holders[p] for p, n in links.items()), hashlib.sha256(text.encode()).hexdigest() if text else "",
        ))
    return sorted(out, key=repr)


HARD = [
    "Hello, world! It's 3.14 — naïve café\n\nnext  line\tand  tabs ",
    "  two spaces first and a trailing newline\n",
    "<|endoftext|> and <s> </s> <unk> <0x41> are plain",
    "日本語の文章です。\n改行 の 後 👩‍👩‍👧 emoji 한국어 텍스트",
    "a sign ▁ that one of them cannot spell",
    "nul \x00 and \x1c and   and  no break",
    "x" * 3000,
    "line\nline\nline\r\nline \n line",
    "", None, " ", "\n", "a", "ends with space ", "Hello, world! It's 3.14",
]


def test_equals_whole_texts_tokenized_by_both_libraries(documents, rows_of, pair):
    docs = list(enumerate(HARD)) + [(3, HARD[0]), (None, HARD[1])]
    assert rows_of(align(documents(*docs), pair), *COLUMNS) == brute(docs)


def test_equals_brute_force_on_the_given_documents(spark, rows_of, pair):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").where("length(text) < 4000")
    assert rows_of(align(docs, pair), *COLUMNS) == brute([tuple(r) for r in docs.collect()])


def test_long_texts_go_through_fragments(spark, documents, rows_of, pair, monkeypatch):
    texts = [" ".join(t for t in HARD if t and "▁" not in t) * 3, "no places " + "y" * 400 + " end", HARD[4] * 20, "日本" * 300, "short"]
    docs = list(enumerate(texts))
    monkeypatch.setattr(alignment, "CHUNK", 97)
    monkeypatch.setattr(alignment, "FAN", 2)
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(alignment)  # so that tasks see the small ranges
    try:
        found = rows_of(align(documents(*docs), pair), *COLUMNS)
    finally:
        cloudpickle.unregister_pickle_by_value(alignment)
    assert found == brute(docs)


def test_joining_fragments_is_associative(pair):
    aligner = Aligner(pair)
    same = lambda f: (f.prefix, f.cut, f.suffix, f.closed.groups, f.closed.n_links, f.closed.pairs.tolist(), f.closed.times.tolist())
    text = " " + HARD[0] + " " + HARD[3]
    for i, j in itertools.combinations(range(1, len(text), 3), 2):
        x, y, z = (aligner.fragment(t) for t in (text[:i], text[i:j], text[j:]))
        left, right = aligner.joined(aligner.joined(x, y), z), aligner.joined(x, aligner.joined(y, z))
        assert same(left) == same(right) == same(aligner.fragment(text))


def test_sums_of_nothing():
    assert Closed.join([Closed(), Closed()]).groups == b""


def test_faster_library_gives_the_same_tokens(spark, pair):
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").where("text is not null").collect()]
    fast, plain = Aligner(pair), Aligner(Pair(pair.a, pair.b))
    words = list({w for t in texts for w in fast.cut.split(" " + t)})
    assert fast._ids(words)[0] == plain._ids(words)[0]


def test_other_columns_and_empty_tables(documents, rows_of, pair):
    docs = documents("one two", extra="1 as block;2 as pairs;'x' as at")
    assert align(docs, pair).count() == 1
    assert align(documents((1, "x")).where("doc_id > 1"), pair).count() == 0


def test_a_block_is_aligned_in_parts(pair, monkeypatch):
    texts = [f"{k} {k + 1} " + "some words, and a name\n" * 1500 for k in range(40)] + ["", None, "▁"]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    sizes, codes = [], Aligner.codes
    monkeypatch.setattr(Aligner, "codes", lambda self, words: sizes.append(len(words)) or codes(self, words))
    monkeypatch.setattr(alignment, "_numbers", lambda offset: iter(range(9)))
    blocks = list(alignment._short_texts(pair)(iter([batch])))
    assert sum(sizes) > 4 * 50_000 and max(sizes) < 50_000 + 10_000
    assert len(blocks) == 1  # parts of a block are one row
    monkeypatch.setattr(alignment, "PART", 1)
    assert list(alignment._short_texts(pair)(iter([batch]))) == blocks


def test_batches_and_row_groups_stay_small(spark, documents, pair):
    names = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    before = [spark.conf.get(n) for n in names]
    sizes = lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches)
    with small_batches(spark, 10, 1 << 20):
        found = save(spark.range(0, 100, 1, 1).mapInArrow(sizes, "n long"), "sizes", 3)
    assert [r.n for r in found.collect()] == [10] * 10
    files = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in found.inputFiles()]
    assert max(m.row_group(k).num_rows for m in files for k in range(m.num_row_groups)) == 3
    with pytest.raises(ZeroDivisionError), small_batches(spark, 10, 1 << 20):
        1 / 0
    assert align(documents("one two"), pair).count() == 1
    assert [spark.conf.get(n) for n in names] == before

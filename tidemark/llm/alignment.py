"""Two tokenizers' tokens of each text, aligned by the bytes where both end.

A text is a sequence of words that neither tokenizer joins: a word begins at a
space or line end that stands between two characters that are no white space.
What a byte range of a text holds is a *fragment*: an open prefix (the end of a
word begun before), the closed groups of its whole words, and an open suffix
(a word not yet ended); a range within one word is open as a whole. Joining
fragments is associative, so the ranges of a very long text may be read by any
tasks and joined as a tree.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import release
from tidemark.session import save, small_batches

MODEL_A = "/opt/tokenizers/byte_bpe_50k.json"
RANKS_A = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MODEL_B = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of a text that are one fragment; longer texts are read as several.
CHUNK = 1 << 16
#: Fragments joined by one task.
FAN = 8
#: Words of a block of documents, for which links are counted together.
BLOCK = 400_000
#: Words of its documents that are aligned at once.
PART = 50_000
#: Rows and bytes of a batch that a Python task gets.
BATCH, BATCH_BYTES = 256, 1 << 22
#: Rows of a row group of written blocks, ranges and fragments, which may have megabytes each.
GROUP = 8
#: Words, and their characters, whose alignment a task remembers from block to block.
REMEMBERED, REMEMBERED_CHARACTERS = 200_000, 4_000_000

#: Links of a group that are written out one by one; those of a larger group are counted by its distinct ids.
LARGE = 4096
#: No pairs, and no times.
NONE = np.zeros(0, np.uint64), np.zeros(0, np.int64)

#: How the first tokenizer cuts a text before merging bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters below this one are in the same classes in every version of Unicode that libraries use.
SETTLED = "ɐ"


def _byte_of() -> dict[str, int]:
    """The byte that a character of a byte-level vocabulary stands for: printable ones are themselves."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


@dataclass(frozen=True)
class Pair:
    """The files of both tokenizers, read on the driver; executors need none.

    ``ranks`` is the vocabulary of ``a`` in the form of a faster library, used for
    words of settled characters only; empty to do without.
    """

    a: str = field(repr=False)
    b: bytes = field(repr=False)
    ranks: bytes = field(default=b"", repr=False)

    @staticmethod
    def load(a: str = MODEL_A, b: str = MODEL_B, ranks: str | None = RANKS_A) -> Pair:
        with open(a, encoding="utf-8") as one, open(b, "rb") as two:
            read = Pair(one.read(), two.read())
        if ranks is None:
            return read
        with open(ranks, "rb") as three:
            return Pair(read.a, read.b, three.read())


@dataclass
class Closed:
    """What the closed groups of a part of a text add up to."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    ok: bool = True
    groups: bytes = b""
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    times: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @staticmethod
    def join(parts: list[Closed]) -> Closed:
        pairs, where = np.unique(np.concatenate([p.pairs for p in parts]), return_inverse=True)
        times = np.zeros(len(pairs), np.int64)
        np.add.at(times, where, np.concatenate([p.times for p in parts]))
        add = lambda name: sum(getattr(p, name) for p in parts)
        return Closed(
            add("n_a"), add("n_b"), add("n_groups"), add("n_links"), all(p.ok for p in parts),
            b";".join(p.groups for p in parts if p.groups), pairs, times,
        )


@dataclass
class Fragment:
    """An open prefix and, if a word begins in it, closed groups and an open suffix."""

    prefix: str
    cut: bool = False
    closed: Closed = field(default_factory=Closed)
    suffix: str = ""


class Aligner:
    """Both tokenizers, and the aligned words seen so far."""

    def __init__(self, pair: Pair) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(pair.a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pair.b)
        byte_of, vocabulary = _byte_of(), self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(byte_of[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.fast = None
        if pair.ranks:
            import base64

            ranks = {base64.b64decode(k): int(v) for k, v in (line.split() for line in pair.ranks.splitlines() if line)}
            self.fast = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("pieces that go over the begin of a word cannot be cut by words")
        # The second tokenizer puts a space before what it reads; its piece can be taken away
        # again from a line end only if no piece holds a line end.
        self.cut = re.compile(r"(?<=\S)(?= \S)" if any("\n" in p for p in pieces) else r"(?<=\S)(?=[ \n]\S)")
        self.length_a, self.length_b = (np.array([len(x) for x in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        self.width = max(len(self.bytes_a), len(self.bytes_b))
        self.written = [f"{i}{after}" for after in ",|;\n" for i in range(self.width)]
        self.forget()

    def forget(self) -> None:
        self.code: dict[str, int] = {}
        self.characters = 0
        self.groups: list[str] = []
        # Of each word: n_a, n_b, n_groups, n_links, whether its tokens spell it; and its links from ``begins`` on.
        self.sums, self.begins = np.zeros((0, 5), np.int64), np.zeros(1, np.int64)
        self.pairs, self.times = NONE

    def _ids(self, words: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        plain = [self.fast is not None and max(w) < SETTLED for w in words]
        rest = iter(self.a.encode_batch([w for w, p in zip(words, plain) if not p], add_special_tokens=False))
        second = self.b.encode([w[1:] if w[0] == " " else w for w in words], num_threads=1)
        encode = self.fast.encode_ordinary if self.fast else None
        return [encode(w) if p else next(rest).ids for w, p in zip(words, plain)], [b if w[0] == " " else b[1:] for w, b in zip(words, second)]

    def _learn(self, words: list[str]) -> None:
        """Tokens, groups and links of new words, all words at once."""
        a, b = self._ids(words)
        good = np.ones(len(words), bool)
        for side, parts in ((a, self.bytes_a), (b, self.bytes_b)):
            for k, (word, ids) in enumerate(zip(words, side)):
                if b"".join([parts[i] for i in ids]) != word.encode():
                    good[k] = False
        for k in np.flatnonzero(~good).tolist():
            a[k] = b[k] = []
        n_a, n_b = (np.fromiter(map(len, side), np.int64, len(words)) for side in (a, b))
        flat_a, flat_b = (np.fromiter(chain.from_iterable(side), np.int64, n.sum()) for side, n in ((a, n_a), (b, n_b)))
        ends_a, ends_b = np.cumsum(self.length_a[flat_a]), np.cumsum(self.length_b[flat_b])
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(ends, ends_a), np.searchsorted(ends, ends_b)
        in_a, in_b = np.bincount(group_a, minlength=len(ends)), np.bincount(group_b, minlength=len(ends))
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        word = np.repeat(np.arange(len(words)), n_a)[first_a]  # of each group
        size = in_a * in_b
        sums = np.stack([n_a, n_b, np.bincount(word, minlength=len(words)), np.bincount(word, size, len(words)).astype(np.int64), good], axis=1)

        g = np.repeat(np.arange(len(ends)), np.where(size <= LARGE, size, 0))
        starts = np.flatnonzero(np.diff(g, prepend=-1))
        nth = np.arange(len(g)) - np.repeat(starts, np.diff(np.append(starts, len(g))))
        owner = [word[g]]
        pairs, times = [flat_a[first_a[g] + nth // in_b[g]] << 32 | flat_b[first_b[g] + nth % in_b[g]]], [np.ones(len(g), np.int64)]
        for k in np.flatnonzero(size > LARGE).tolist():
            own_a, times_a = np.unique(flat_a[first_a[k] : first_a[k] + in_a[k]], return_counts=True)
            own_b, times_b = np.unique(flat_b[first_b[k] : first_b[k] + in_b[k]], return_counts=True)
            pairs.append((own_a[:, None] << 32 | own_b[None, :]).ravel())
            times.append((times_a[:, None] * times_b[None, :]).ravel())
            owner.append(np.full(len(pairs[-1]), word[k]))
        owner, pairs, times = np.concatenate(owner), np.concatenate(pairs), np.concatenate(times)
        if (size > LARGE).any():
            order = np.argsort(owner, kind="stable")
            owner, pairs, times = owner[order], pairs[order], times[order]

        # Each token is written with what follows it: a comma within its side of a group, or what ends the side.
        codes = np.zeros(len(flat_a) + len(flat_b), np.int64)
        codes[first_b[group_a] + np.arange(len(flat_a))] = flat_a + self.width * (np.diff(group_a, append=-1) != 0)
        last = np.diff(word, append=-1) != 0
        after = np.where(np.diff(group_b, append=-1) != 0, 2 + last[group_b], 0)
        codes[(first_a + in_a)[group_b] + np.arange(len(flat_b))] = flat_b + self.width * after
        texts = iter("".join(map(self.written.__getitem__, codes.tolist())).split("\n"))
        self.groups += [next(texts) if k else "" for k in good.tolist()]

        self.code.update(zip(words, range(len(self.code), len(self.code) + len(words))))
        self.characters += sum(map(len, words))
        self.sums = np.concatenate([self.sums, sums])
        self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(np.bincount(owner, minlength=len(words)))])
        self.pairs = np.concatenate([self.pairs, pairs.astype(np.uint64)])
        self.times = np.concatenate([self.times, times])

    def codes(self, words: list[str]) -> np.ndarray:
        """Numbers of words, which stand for their aligned tokens until ``forget``."""
        new = [w for w in dict.fromkeys(words) if w not in self.code]
        if new:
            self._learn(new)
        return np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))

    def links(self, owner: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct ``owner, pair`` of words and how often each is linked, by owner and pair."""
        begins, pairs, times = self.begins, self.pairs, self.times
        keys, seen = np.unique(owner * len(self.code) + codes, return_counts=True)
        owner, codes = np.divmod(keys, len(self.code))
        n = begins[codes + 1] - begins[codes]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begins[codes], n)
        ids, where = np.unique(pairs[at], return_inverse=True)
        keys = np.repeat(owner, n) * max(1, len(ids)) + where
        keys, where = np.unique(keys, return_inverse=True)
        total = np.bincount(where, times[at] * np.repeat(seen, n), len(keys)).astype(np.int64)
        owner, ids_at = np.divmod(keys, max(1, len(ids)))
        return owner, ids[ids_at], total

    def close(self, words: list[str]) -> Closed:
        """The closed groups of whole words that follow each other."""
        if not words:
            return Closed()
        codes = self.codes(words)
        _, pairs, times = self.links(np.zeros(len(codes), np.int64), codes)
        n_a, n_b, n_groups, n_links, n_good = self.sums[codes].sum(axis=0).tolist()
        groups = ";".join(g for c in codes.tolist() if (g := self.groups[c])).encode()
        return Closed(n_a, n_b, n_groups, n_links, n_good == len(codes), groups, pairs, times)

    def fragment(self, text: str) -> Fragment:
        """What a range of a text holds; the first range of a text begins with the space before it."""
        first, *rest = self.cut.split(text)
        return Fragment(first, True, self.close(rest[:-1]), rest[-1]) if rest else Fragment(first)

    def joined(self, left: Fragment, right: Fragment) -> Fragment:
        """The fragment of both ranges; joining is associative."""
        words = self.cut.split((left.suffix if left.cut else left.prefix) + right.prefix)
        if left.cut and right.cut:
            return Fragment(left.prefix, True, Closed.join([left.closed, self.close(words), right.closed]), right.suffix)
        if left.cut:
            return Fragment(left.prefix, True, Closed.join([left.closed, self.close(words[:-1])]), words[-1])
        if right.cut:
            if len(words) == 1:
                return Fragment(words[0], True, right.closed, right.suffix)
            return Fragment(words[0], True, Closed.join([self.close(words[1:]), right.closed]), right.suffix)
        return Fragment(words[0], True, self.close(words[1:-1]), words[-1]) if len(words) > 1 else Fragment(words[0])

    def whole(self, fragment: Fragment) -> Closed:
        """The groups of a text, when its first and last word are known to be whole."""
        parts = [self.close([fragment.prefix])]
        return Closed.join([*parts, fragment.closed, self.close([fragment.suffix])]) if fragment.cut else parts[0]

    def relieve(self) -> None:
        if len(self.code) > REMEMBERED or self.characters > REMEMBERED_CHARACTERS:
            self.forget()


#: A block: its documents' sums, its id pairs with the number of its documents that link them,
#: and for each document (``held`` pairs of it) which pairs it links and how often.
BLOCKS = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "sha array<string>, held array<int>, at array<int>, times array<long>, pairs array<long>, docs array<long>"
)
FRAGMENTS = (
    "doc long, part long, doc_id long, prefix string, cut boolean, suffix string, n_a long, n_b long, n_groups long, "
    "n_links long, ok boolean, groups binary, pairs array<long>, times array<long>"
)
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class _Block:
    """Documents gathered for one row of ``BLOCKS``."""

    def __init__(self, number: int) -> None:
        self.number = number
        self.docs: list[tuple[int | None, list[int], str]] = []
        self.held: list[int] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, doc_id: int | None, sums: list[int], sha: str) -> None:
        self.docs.append((doc_id, sums, sha))

    def link(self, held: list[int], pairs: np.ndarray, times: np.ndarray) -> None:
        self.held += held
        self.pairs.append(pairs)
        self.times.append(times)

    def batch(self) -> pa.RecordBatch:
        pairs, at = np.unique(np.concatenate([*self.pairs, np.zeros(0, np.uint64)]), return_inverse=True)
        docs = np.bincount(at, minlength=len(pairs))
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        sums = list(zip(*(s for _, s, _ in self.docs))) or [()] * 4
        columns = {
            "block": pa.array([self.number], pa.int64()),
            "doc_id": one([d for d, _, _ in self.docs], pa.int64()),
            **{name: one(list(values), pa.int64()) for name, values in zip(("n_a", "n_b", "n_groups", "n_links"), sums)},
            "sha": one([s for _, _, s in self.docs], pa.string()),
            "held": one(self.held, pa.int32()),
            "at": one(at.astype(np.int32), pa.int32()),
            "times": one(np.concatenate([*self.times, np.zeros(0, np.int64)]), pa.int64()),
            "pairs": one(pairs.view(np.int64), pa.int64()),
            "docs": one(docs, pa.int64()),
        }
        return pa.RecordBatch.from_pydict(columns)


def _numbers(offset: int) -> Iterator[int]:
    """Numbers that no other task gives; ``offset`` 0 or 1 parts the jobs that number rows of one table."""
    first = (TaskContext.get().partitionId() * 2 + offset) << 40
    return iter(range(first, first + (1 << 40)))


def _sha(groups: bytes) -> str:
    return hashlib.sha256(groups).hexdigest()


def _add_part(out: _Block, aligner: Aligner, ids: list[int | None], words: list[list[str]]) -> None:
    """Some documents more in a block, by their words."""
    lengths = np.array([len(w) for w in words], np.int64)
    codes = aligner.codes([x for w in words for x in w])
    sums = np.zeros((len(words), 5), np.int64)
    owner = np.repeat(np.arange(len(words)), lengths)
    np.add.at(sums, owner, aligner.sums[codes])
    good = sums[:, 4] == lengths
    flat, at = codes.tolist(), 0
    for k, doc_id in enumerate(ids):
        own = flat[at : at + lengths[k]]
        at += int(lengths[k])
        if good[k] and own:
            out.add(doc_id, sums[k, :4].tolist(), _sha(";".join([aligner.groups[c] for c in own]).encode()))
        else:
            out.add(doc_id, [0, 0, 0, 0], "")
    use = good[owner]
    who, pairs, times = aligner.links(owner[use], codes[use]) if use.any() else (np.zeros(0, np.int64), *NONE)
    out.link(np.bincount(who, minlength=len(ids)).tolist(), pairs, times)


def _short_texts(pair: Pair):
    """Blocks of the documents that are one fragment each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, numbers = Aligner(pair), _numbers(0)
        out, ids, words = _Block(next(numbers)), [], []
        n = of_block = 0  # words of the part and of the block
        for batch in batches:
            for begin in range(0, batch.num_rows, BATCH):
                some = batch.slice(begin, BATCH)
                for doc_id, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist()):
                    ids.append(doc_id)
                    words.append(aligner.cut.split(" " + text) if text else [])
                    n += 1 + len(words[-1])
                    full = of_block + n >= BLOCK
                    if full or n >= PART:
                        _add_part(out, aligner, ids, words)
                        ids, words, n, of_block = [], [], 0, of_block + n
                        aligner.relieve()
                    if full:
                        yield out.batch()
                        out, of_block = _Block(next(numbers)), 0
        if ids:
            _add_part(out, aligner, ids, words)
        if out.docs:
            yield out.batch()
        del aligner, out, ids, words
        release()

    return run


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The byte ranges of long texts, moved to the next begin of a character."""
    numbers = _numbers(0)
    for batch in batches:
        for k in range(batch.num_rows):
            raw = b" " + batch.column("text")[k].as_py().encode()
            doc, part, begin = next(numbers), 0, 0
            while begin < len(raw):
                end = min(begin + CHUNK, len(raw))
                while end < len(raw) and raw[end] & 0xC0 == 0x80:
                    end += 1
                row = {"doc": [doc], "part": [part], "doc_id": [batch.column("doc_id")[k].as_py()], "text": [raw[begin:end].decode()]}
                yield pa.RecordBatch.from_pydict(row, pa.schema([("doc", pa.int64()), ("part", pa.int64()), ("doc_id", pa.int64()), ("text", pa.string())]))
                part, begin = part + 1, end


def _row(doc: int, part: int, doc_id: int | None, f: Fragment) -> dict:
    c = f.closed
    return {
        "doc": doc, "part": part, "doc_id": doc_id, "prefix": f.prefix, "cut": f.cut, "suffix": f.suffix, "n_a": c.n_a, "n_b": c.n_b,
        "n_groups": c.n_groups, "n_links": c.n_links, "ok": c.ok, "groups": c.groups, "pairs": c.pairs.view(np.int64), "times": c.times,
    }


def _kind(name: str) -> pa.DataType:
    lists = {"pairs": pa.list_(pa.int64()), "times": pa.list_(pa.int64())}
    return lists.get(name) or {"string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}.get(
        dict(c.split() for c in FRAGMENTS.split(", "))[name], pa.int64()
    )


FRAGMENT_SCHEMA = pa.schema([(c.split()[0], _kind(c.split()[0])) for c in FRAGMENTS.split(", ")])


def _fragment_of(row: dict) -> Fragment:
    closed = Closed(
        row["n_a"], row["n_b"], row["n_groups"], row["n_links"], row["ok"], row["groups"],
        np.array(row["pairs"], np.int64).view(np.uint64), np.array(row["times"], np.int64),
    )
    return Fragment(row["prefix"], row["cut"], closed, row["suffix"])


def _fragments(pair: Pair):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(pair)
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in ("doc", "part", "doc_id", "text")}
                found = _row(row["doc"], row["part"], row["doc_id"], aligner.fragment(row["text"]))
                yield pa.RecordBatch.from_pylist([found], FRAGMENT_SCHEMA)
                aligner.relieve()
        del aligner
        release()

    return run


def _join_fragments(pair: Pair):
    made: list[Aligner] = []  # one for all groups of a task

    def run(table: pa.Table) -> pa.Table:
        if not made:
            made.append(Aligner(pair))
        aligner = made[0]
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        whole = _fragment_of(rows[0])
        for row in rows[1:]:
            whole = aligner.joined(whole, _fragment_of(row))
        aligner.relieve()
        return pa.Table.from_pylist([_row(rows[0]["doc"], rows[0]["part"] // FAN, rows[0]["doc_id"], whole)], FRAGMENT_SCHEMA)

    return run


def _long_texts(pair: Pair):
    """Blocks of the documents joined from several fragments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, numbers = Aligner(pair), _numbers(1)
        out, n = _Block(next(numbers)), 0
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                whole = aligner.whole(_fragment_of(row))
                aligner.relieve()
                if whole.ok:
                    out.add(row["doc_id"], [whole.n_a, whole.n_b, whole.n_groups, whole.n_links], _sha(whole.groups))
                    out.link([len(whole.pairs)], whole.pairs, whole.times)
                else:
                    out.add(row["doc_id"], [0, 0, 0, 0], "")
                    out.link([0], *NONE)
                n += 1 + len(whole.pairs)
                if n >= BLOCK:
                    yield out.batch()
                    out, n = _Block(next(numbers)), 0
        if out.docs:
            yield out.batch()
        del aligner, out
        release()

    return run


def _documents(blocks: pa.Table, found: pa.Table) -> pa.Table:
    """The documents of a block, with what all documents say about their links."""
    counts = np.zeros(len(blocks.column("pairs")[0]), np.int64)
    best = np.zeros(len(counts), bool)
    at = found.column("at").to_numpy()
    counts[at], best[at] = found.column("count").to_numpy(), found.column("best").to_numpy()
    value = lambda name: blocks.column(name)[0].values.to_numpy(zero_copy_only=False)
    held, at, times = value("held"), value("at"), value("times")
    owner = np.repeat(np.arange(len(held)), held)
    n_best, total = np.zeros(len(held), np.int64), np.zeros(len(held), np.int64)
    np.add.at(n_best, owner, np.where(best[at], times, 0))
    np.add.at(total, owner, times * counts[at])
    plain = {name: blocks.column(name)[0].values for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table({**plain, "n_best": n_best, "count_sum": total, "groups_sha256": blocks.column("sha")[0].values})


def _blocks(rows: DataFrame, pair: Pair) -> DataFrame:
    """The written blocks of all texts."""
    size = F.octet_length("text")
    short = save(rows.where(size.isNull() | (size < CHUNK)).mapInArrow(_short_texts(pair), BLOCKS), "blocks", GROUP)
    longest = rows.agg(F.max(size)).first()[0] or 0
    if longest < CHUNK:
        return short
    ranges = save(rows.where(size >= CHUNK).mapInArrow(_ranges, "doc long, part long, doc_id long, text string"), "ranges", GROUP)
    ranges = ranges.repartition("doc", "part")
    parts = save(ranges.mapInArrow(_fragments(pair), FRAGMENTS), "fragments", GROUP)
    left = -(-(longest + 1) // CHUNK)
    while left > 1:
        parts = save(parts.groupBy("doc", F.expr(f"part div {FAN}").alias("_group")).applyInArrow(_join_fragments(pair), FRAGMENTS), "fragments", GROUP)
        left = -(-left // FAN)
    return short.unionByName(save(parts.mapInArrow(_long_texts(pair), BLOCKS), "blocks", GROUP))


def align(docs: DataFrame, pair: Pair) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text``), with the alignment of its tokens summed up.

    The tokens of a text are those of both tokenizers for the text after one
    space. Bytes where a token of either ends cut them into groups, and a link is
    a pair of tokens, one of each kind, in one group. ``n_links`` counts links,
    ``count_sum`` adds up for each link how many documents link its two ids, and
    ``n_best`` counts links whose number is the highest that their first id has
    in all documents, ties included. ``groups_sha256`` is the digest of
    ``a1,a2|b1;a3|b2,b3``, the ids of all groups in order.

    Null and empty texts, and texts that the tokens do not spell (U+2581 becomes
    a space in one of them), have zeros and an empty digest; they count for no
    pair. Rows that repeat a doc_id or a text count each; a null doc_id is kept.
    Other columns are not read. An empty table gives no row.

    Texts of up to ``CHUNK`` bytes are read where they are. The byte ranges of
    longer ones are dealt to all tasks and their fragments joined ``FAN`` at a
    time; a run without white space is one word and read by one task, as no place
    in it is known to end tokens. Links of a block of documents are counted
    together, so a link that every document has is one row for each block.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with small_batches(docs.sparkSession, BATCH, BATCH_BYTES):
        blocks = _blocks(rows, pair)
    held = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("at", "x")).select("block", "at", "x.pairs", "x.docs")
    counts = save(held.groupBy("pairs").agg(F.sum("docs").alias("count")), "counts")
    highest = counts.groupBy(F.shiftright("pairs", 32).alias("a")).agg(F.max("count").alias("highest"))
    known = counts.join(highest, F.shiftright("pairs", 32) == F.col("a")).select("pairs", "count", (F.col("count") == F.col("highest")).alias("best"))
    known = save(known, "known")
    found = held.select(F.col("block").alias("within"), "at", "pairs").join(known, "pairs").select("within", "at", "count", "best")
    return blocks.groupBy("block").cogroup(found.groupBy("within")).applyInArrow(_documents, RESULT)

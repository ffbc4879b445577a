"""Encoding texts into SentencePiece ids, and back, by automaton and Viterbi."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from tidemark.llm.words import release

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Results for words that a task remembers; it starts anew when it has so many.
REMEMBERED = 400_000
RANK_OFFSET = 100
#: Characters of a text whose chunks are read one by one.
LONG = 1 << 18
#: Rows handled at once.
ROWS = 512


@dataclass(frozen=True)
class Vocabulary:
    """What a model file says: pieces that may match with their scores, and the ids of bytes."""

    pieces: tuple[tuple[str, int, float], ...]
    bytes_: tuple[int, ...]
    parts: tuple[bytes, ...] = field(repr=False)

    @staticmethod
    def load(path: str = MODEL) -> Vocabulary:
        """Read a model file on the driver; executors need no file.

        A unigram model gives log-probabilities. A model of merges gives ranks,
        which sums would drive into tiny pieces; they become log-probabilities
        by rank, -log(rank + ``RANK_OFFSET``), as frequencies fall by rank.
        """
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, bytes_, parts = [], [-1] * 256, []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                bytes_[int(piece[3:5], 16)] = i
                parts.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                parts.append(b"")
            else:
                pieces.append((piece, i, model.get_score(i)))
                parts.append(piece.replace(SPACE, " ").encode())
        if min(bytes_) < 0:
            raise ValueError("the model has no pieces for single bytes")
        if all(score <= 0 and score == int(score) for _, _, score in pieces):
            pieces = [(piece, i, -math.log(RANK_OFFSET - score)) for piece, i, score in pieces]
        return Vocabulary(tuple(pieces), tuple(bytes_), tuple(parts))


class Encoder(dict):
    """Packed ids by chunk: a run of spaces with the letters after it, or a line end."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.bytes_ = vocabulary.bytes_
        self.automaton = ahocorasick.Automaton()
        for piece, i, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        # A character without a piece costs more than any piece.
        self.rare = min((score for _, _, score in vocabulary.pieces), default=0.0) - 10
        whole = any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece, _, _ in vocabulary.pieces)
        lines = any("\n" in piece for piece, _, _ in vocabulary.pieces)
        # No piece goes over the ends of chunks, so the best path of a text is that of its chunks.
        self.cut = re.compile(r"(?s).+" if whole else f"{SPACE}*[^{SPACE}]+|{SPACE}+" if lines else f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")

    def best_path(self, chunk: str) -> list[int]:
        """The ids with the highest sum of scores; of equal sums, that with the longer last piece.

        The automaton reads the chunk once. At each position it names every piece
        that ends there, longest first along its output links, and each relaxes
        the best sum of this position from that of the piece's begin.
        """
        best, back = [0.0], [(0, -1)]
        matches = self.automaton.iter(chunk) if len(self.automaton) else iter(())
        end, match = next(matches, (-1, None))
        for at in range(len(chunk)):
            high, how = float("-inf"), (1, -1)
            while end == at:
                length, score, i = match
                if best[at + 1 - length] + score > high:
                    high, how = best[at + 1 - length] + score, (length, i)
                end, match = next(matches, (-1, None))
            if best[at] + self.rare > high:
                high, how = best[at] + self.rare, (1, -1)
            best.append(high)
            back.append(how)
        ids, at = [], len(chunk)
        while at:
            length, i = back[at]
            ids += [i] if i >= 0 else [self.bytes_[b] for b in reversed(chunk[at - 1].encode())]
            at -= length
        return ids[::-1]

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        packed = self[chunk] = np.array(self.best_path(chunk), np.int32).tobytes()
        return packed

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if SPACE in text:  # the sign itself is written as bytes, so that decoding gives it back
            sign = np.array([self.bytes_[b] for b in SPACE.encode()], np.int32).tobytes()
            parts = text.split(SPACE)
            return sign.join(self._plain(p if k else " " + p) for k, p in enumerate(parts))
        return self._plain(" " + text)

    def _plain(self, text: str) -> bytes:
        text = text.replace(" ", SPACE)
        # The chunks of a very long text are not all in memory at once.
        chunks = self.cut.findall(text) if len(text) < LONG else (m.group() for m in self.cut.finditer(text))
        return b"".join(map(self.__getitem__, chunks))


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _ids_of(texts: list[str | None], encoder: Encoder) -> pa.Array:
    packed = [encoder.encode(t or "") for t in texts]
    ends = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype(np.int32)
    return pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), np.int32), pa.int32()),
        mask=pa.array([t is None for t in texts], pa.bool_()),
    )


def _texts_of(column: pa.Array, parts: np.ndarray) -> list[str | None]:
    """The text of each list of ids; the last of ``parts`` is that of ids out of range."""
    flat = column.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
    pieces = parts[np.where((flat >= 0) & (flat < len(parts) - 1), flat, len(parts) - 1)]
    at, texts = 0, []
    for n in column.value_lengths().to_pylist():
        if n is None:
            texts.append(None)
            continue
        text = b"".join(pieces[at : at + n]).decode("utf-8", "replace")
        texts.append(text[1:] if text.startswith(" ") else text)
        at += n
    return texts


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text in column ``into``.

    As the model's own library does, one space is put before a text and spaces
    are written as U+2581; nothing else is changed. The pieces chosen are those
    with the highest sum of the model's scores. Characters without a piece become
    their UTF-8 bytes. Null gives null, an empty text no ids. A column named
    ``into`` is replaced, all others stay.
    """
    docs = docs.drop(into)
    names = docs.columns
    schema = StructType([*docs.schema]).add(into, ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)  # goes with the task, so that an idle worker holds no words
        for batch in _sliced(batches):
            ids = _ids_of(batch.column(text).cast(pa.large_string()).to_pylist(), encoder)
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*names, into])
        encoder.clear()
        release()

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``rows`` with the text of each list of ids in column ``into``; the inverse of ``encode``.

    Ids without a text of their own (control, unknown, out of range) give none;
    bytes that make no character become U+FFFD. Null gives null.
    """
    rows = rows.drop(into)
    names = rows.columns
    schema = StructType([*rows.schema]).add(into, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = np.array([*vocabulary.parts, b""], object)
        for batch in _sliced(batches):
            texts = _texts_of(batch.column(ids), parts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, into])

    return rows.mapInArrow(run, schema)


def encode_and_check(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", into: str = "ids", restored: str = "restored"
) -> DataFrame:
    """``encode``, and in column ``restored`` whether ``decode`` gives the text back (null for null counts as such).

    Both are done in one pass, so a task has one Python worker and ids are sent
    only once. Columns named ``into`` or ``restored`` are replaced.
    """
    docs = docs.drop(into, restored)
    names = docs.columns
    schema = StructType([*docs.schema]).add(into, ArrayType(IntegerType())).add(restored, "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, parts = Encoder(vocabulary), np.array([*vocabulary.parts, b""], object)
        for batch in _sliced(batches):
            texts = batch.column(text).cast(pa.large_string()).to_pylist()
            ids = _ids_of(texts, encoder)
            same = pa.array([a == b for a, b in zip(_texts_of(ids, parts), texts)], pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns, ids, same], [*names, into, restored])
        encoder.clear()
        release()

    return docs.mapInArrow(run, schema)


def round_trip(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id, ids, n_pieces, restored``: the ids of each text, and whether they decode to it."""
    both = encode_and_check(docs.select("doc_id", F.col("text").cast("string")), vocabulary)
    return both.select(
        "doc_id", "ids", F.coalesce(F.when(F.col("ids").isNotNull(), F.size("ids")), F.lit(0)).cast("long").alias("n_pieces"),
        "restored",
    )

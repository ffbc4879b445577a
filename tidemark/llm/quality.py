"""Graded quality of documents by ordinal regression on hashed text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.samples import held_out, some_of_each
from tidemark.llm.words import ROWS, words_and_tails

BITS = 18
#: Features: hashed words, then the last two bytes of words.
FEATURES = (1 << BITS) + (1 << 16)
#: The model learns from so many documents of each grade at most.
DOCUMENTS, ROUNDS, STEPS = 6000, 25, 1500
#: A feature gets a weight if so many of these documents have it.
SEEN = 10
PRESENT = 0.2
SELECTED = 0.5


@dataclass(frozen=True)
class Ordinal:
    """P(grade > k) = sigmoid(weights . x - thresholds[k]): one direction, ordered thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, lean: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - lean[:, None], -60, 60)))


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indexes and values of each text: ``PRESENT`` for each word it has, however long it is, and roots of shares of word ends."""
    for at in range(0, len(column), ROWS):
        yield from _features(column.slice(at, ROWS))


def _features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    hashes, begins, tails = words_and_tails(column)
    words = (hashes >> np.uint64(64 - BITS)).astype(np.int32)
    ends = tails + (1 << BITS)
    for begin, end in zip(begins[:-1].tolist(), begins[1:].tolist()):
        own = np.unique(words[begin:end])
        last, count = np.unique(ends[begin:end], return_counts=True)
        share = np.sqrt(count / max(1, end - begin))
        yield np.concatenate([own, last]), np.concatenate([np.full(len(own), PRESENT), share]).astype(np.float32)


def train(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int, seed: int = 1) -> Ordinal:
    """Weights and thresholds by stochastic gradient with steps of their own for each weight."""
    weights, squares = np.zeros(FEATURES, np.float32), np.full(FEATURES, 1e-6, np.float32)
    shares = np.clip(np.cumsum(np.bincount(grades, minlength=n_grades))[:-1] / max(1, len(grades)), 0.01, 0.99)
    thresholds = np.maximum.accumulate(np.log(shares / (1 - shares)) + 1e-3 * np.arange(n_grades - 1))
    index, value = np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows])
    # What few rated texts have would only teach these texts by heart.
    common = np.bincount(index, minlength=FEATURES)[index] >= SEEN
    lengths = np.bincount(np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])[common], minlength=len(rows))
    index, value = index[common], value[common]
    begins = np.concatenate([[0], np.cumsum(lengths)])
    rng = np.random.default_rng(seed)
    for turn in range(max(ROUNDS, STEPS * 64 // max(1, len(rows)))):
        order = rng.permutation(len(rows))
        for begin in range(0, len(order), 64):
            use = order[begin : begin + 64]
            n = lengths[use]
            where = np.repeat(begins[use] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            own, i, v = np.repeat(np.arange(len(use)), n), index[where], value[where]
            lean = np.bincount(own, weights[i] * v, len(use))
            y = grades[use]
            edge = np.concatenate([[-60.0], thresholds, [60.0]])
            low = 1 / (1 + np.exp(-np.clip(edge[y] - lean, -60, 60)))
            high = 1 / (1 + np.exp(-np.clip(edge[y + 1] - lean, -60, 60)))
            chance = np.maximum(high - low, 1e-9)
            f_low, f_high = low * (1 - low) / chance, high * (1 - high) / chance
            spots, at = np.unique(i, return_inverse=True)
            g = np.bincount(at, (f_high - f_low)[own] * v).astype(np.float32) + 1e-2 * weights[spots]
            squares[spots] += g * g
            weights[spots] -= 0.3 * g / np.sqrt(squares[spots])
            move = np.zeros(n_grades + 1)
            np.add.at(move, y + 1, -f_high)
            np.add.at(move, y, f_low)
            thresholds = np.maximum.accumulate(thresholds - 0.02 / (1 + turn) * move[1:-1]) + 1e-6 * np.arange(n_grades - 1)
    return Ordinal(weights, thresholds)


def learn(docs: DataFrame, ratings: DataFrame, n_grades: int) -> Ordinal | None:
    """A model from ``ratings`` (``doc_id, grade`` from 0) of documents that are not held out.

    It learns from ``DOCUMENTS`` rated documents of each grade, chosen by a hash
    of the id. Ratings without a document, without a grade or out of range teach
    nothing; an id with several ratings counts once for each.
    """
    rated = ratings.where(f"grade between 0 and {n_grades - 1} and doc_id is not null").where(~held_out())
    rated = some_of_each(rated.select("doc_id", "grade"), "grade", DOCUMENTS)
    rows = docs.select("doc_id", "text").join(F.broadcast(rated), "doc_id")  # so many ids for each grade

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(features(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()), batch.column("grade").cast(pa.int32()),
                    pa.array([i.tobytes() for i, _ in found], pa.binary()), pa.array([v.tobytes() for _, v in found], pa.binary()),
                ],
                ["doc_id", "grade", "index", "value"],
            )

    got = rows.mapInArrow(run, "doc_id long, grade int, index binary, value binary").collect()
    got.sort(key=lambda r: (r.doc_id, r.grade))
    if not got:
        return None
    vectors = [(np.frombuffer(r["index"], np.int32), np.frombuffer(r.value, np.float32)) for r in got]
    return train(vectors, np.array([r.grade for r in got]), n_grades)


def grade(docs: DataFrame, model: Ordinal | None) -> DataFrame:
    """``docs`` with ``expected_grade``, ``p_top`` (chance of the highest grade) and ``selected``.

    The whole text counts. Texts without words, and all texts if there was
    nothing to learn from, have grade 0 and are not selected. Own columns of
    these names are replaced.
    """
    docs = docs.drop("expected_grade", "p_top", "selected")
    if model is None:
        return docs.withColumns({"expected_grade": F.lit(0.0), "p_top": F.lit(0.0), "selected": F.lit(False)})
    names = docs.columns
    schema = StructType([*docs.schema]).add("expected_grade", "double").add("p_top", "double").add("selected", "boolean")
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            lean, some = np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
            for k, (index, value) in enumerate(features(batch.column("text"))):
                lean[k], some[k] = own.weights[index] @ value, len(index) > 0
            above = own.above(lean) * some[:, None]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(above.sum(axis=1)), pa.array(above[:, -1]), pa.array(above[:, -1] >= SELECTED)],
                [*names, "expected_grade", "p_top", "selected"],
            )

    return docs.mapInArrow(run, schema)

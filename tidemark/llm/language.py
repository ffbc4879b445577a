"""The language of documents, told by a convolutional network over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.samples import held_out, some_of_each
from tidemark.llm.words import release, text_bytes

UNKNOWN = "und"
#: Bytes of a window; filters of each width; numbers a byte is embedded in.
WINDOW, WIDTHS, FILTERS, EMBEDDED = 128, (2, 3, 4), 16, 8
#: The network learns from so many documents of a language at most, and so many windows of each.
DOCUMENTS, WINDOWS, ROUNDS = 500, 4, 12
#: Windows that are in memory at once.
AT_ONCE = 512
LETTER = np.zeros(256, np.float32)
LETTER[ord("a") : ord("z") + 1] = 1
LETTER[0x80:] = 1


@dataclass(frozen=True)
class Network:
    """``scores`` = softmax(relu(max over places of the filters) @ dense + bias) for each language."""

    languages: tuple[str, ...]
    tables: tuple[np.ndarray, ...]  # per width: the share of each byte at each place of a filter
    shift: np.ndarray
    dense: np.ndarray
    bias: np.ndarray

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The highest answer of each filter, and where it is."""
        high, where = [], []
        for table in self.tables:
            width = len(table)
            places = windows.shape[1] - width + 1
            answer = table[0][windows[:, :places]]
            for k in range(1, width):
                answer += table[k][windows[:, k : k + places]]
            at = answer.argmax(axis=1)
            where.append(at)
            high.append(np.take_along_axis(answer, at[:, None, :], axis=1)[:, 0])
        return np.concatenate(high, axis=1) + self.shift, np.concatenate(where, axis=1)

    def scores(self, windows: np.ndarray) -> np.ndarray:
        out = []
        for begin in range(0, len(windows), AT_ONCE):
            part = windows[begin : begin + AT_ONCE]
            high = []
            for pairs, rest in self._steps():
                # Two bytes are looked up at once: a filter of four needs two looks.
                both = part[:, :-1].astype(np.int32) * 256 + part[:, 1:]
                width = 2 * len(pairs) + len(rest)
                places = part.shape[1] - width + 1
                answer = pairs[0][both[:, :places]]
                for k in range(1, len(pairs)):
                    answer += pairs[k][both[:, 2 * k : 2 * k + places]]
                for k, table in enumerate(rest):
                    answer += table[part[:, 2 * len(pairs) + k :][:, :places]]
                high.append(answer.max(axis=1))
            logits = np.maximum(np.concatenate(high, axis=1) + self.shift, 0) @ self.dense + self.bias
            logits = np.exp(logits - logits.max(axis=1, keepdims=True))
            out.append(logits / logits.sum(axis=1, keepdims=True))
        return np.concatenate(out) if out else np.zeros((0, len(self.languages)), np.float32)

    def _steps(self) -> list[tuple[list[np.ndarray], list[np.ndarray]]]:
        if "steps" not in self.__dict__:
            steps = []
            for table in self.tables:
                pairs = [
                    (table[k][:, None, :] + table[k + 1][None, :, :]).reshape(65536, -1) for k in range(0, len(table) - 1, 2)
                ]
                steps.append((pairs, [table[-1]] if len(table) % 2 else []))
            self.__dict__["steps"] = steps
        return self.__dict__["steps"]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "steps"}


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each text in windows of equal length, the last filled up with zeros; and how many each has."""
    counts = -(-np.diff(offsets) // WINDOW)
    windows = np.zeros((int(counts.sum()), WINDOW), np.uint8)
    begins = np.concatenate([[0], np.cumsum(counts)[:-1]]) * WINDOW
    places = np.arange(len(data)) + np.repeat(begins - offsets[:-1], np.diff(offsets))
    windows.reshape(-1)[places] = data
    return windows, counts


def train(texts: list[str], labels: list[str], seed: int = 1) -> Network:
    """A network fitted to pieces of text and their languages."""
    languages = tuple(sorted(set(labels)))
    rng = np.random.default_rng(seed)
    pieces = [np.frombuffer(t.encode()[:WINDOW], np.uint8) for t in texts]
    x = np.zeros((len(pieces), WINDOW), np.uint8)
    for row, piece in zip(x, pieces):
        row[: len(piece)] = piece
    y = np.array([languages.index(label) for label in labels])
    weights = {
        "embed": rng.normal(0, 0.5, (256, EMBEDDED)),
        "shift": np.zeros(FILTERS * len(WIDTHS)),
        "dense": rng.normal(0, 0.3, (FILTERS * len(WIDTHS), len(languages))),
        "bias": np.zeros(len(languages)),
    } | {f"w{w}": rng.normal(0, (w * EMBEDDED) ** -0.5, (w, EMBEDDED, FILTERS)) for w in WIDTHS}
    weights = {k: v.astype(np.float32) for k, v in weights.items()}
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}

    def network() -> Network:
        tables = tuple(np.stack([weights["embed"] @ weights[f"w{w}"][k] for k in range(w)]) for w in WIDTHS)
        return Network(languages, tables, weights["shift"], weights["dense"], weights["bias"])

    step = 0
    for _ in range(ROUNDS):
        order = rng.permutation(len(x))
        for begin in range(0, len(order), 128):
            use = order[begin : begin + 128]
            rows, truth = x[use], y[use]
            now = network()
            high, where = now.pooled(rows)
            hidden = np.maximum(high, 0)
            logits = hidden @ weights["dense"] + weights["bias"]
            chance = np.exp(logits - logits.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            chance[np.arange(len(use)), truth] -= 1
            chance /= len(use)
            back = (chance @ weights["dense"].T) * (high > 0)
            slope = {"dense": hidden.T @ chance, "bias": chance.sum(axis=0), "shift": back.sum(axis=0), "embed": np.zeros_like(weights["embed"])}
            for n, w in enumerate(WIDTHS):
                g = back[:, n * FILTERS : (n + 1) * FILTERS]
                at = where[:, n * FILTERS : (n + 1) * FILTERS]
                own = []
                for k in range(w):
                    byte = np.take_along_axis(rows, at + k, axis=1)
                    own.append(np.einsum("bf,bfe->ef", g, weights["embed"][byte]))
                    np.add.at(slope["embed"], byte, g[:, :, None] * weights[f"w{w}"][k].T[None])
                slope[f"w{w}"] = np.stack(own)
            step += 1
            for k, g in slope.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                weights[k] -= 0.005 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                weights[k] = weights[k].astype(np.float32)
    return network()


def learn(docs: DataFrame) -> Network | None:
    """A network from ``text`` and ``lang`` of the rows that are not held out; None if there are none.

    It learns from ``DOCUMENTS`` documents of each language, chosen by a hash of
    the id, and ``WINDOWS`` pieces spread over each of them.
    """
    rows = docs.where(~held_out()).where("lang is not null and text is not null and length(text) > 0")
    chosen = some_of_each(rows.select("doc_id", "lang"), "lang", DOCUMENTS).select("doc_id").distinct()
    chosen = F.broadcast(chosen)  # so many ids for each language
    at = [F.greatest(F.lit(1), F.expr(f"cast((length(text) - {WINDOW}) * {k}L div {max(1, WINDOWS - 1)} as int) + 1")) for k in range(WINDOWS)]
    pieces = rows.join(chosen, "doc_id", "left_semi").select(
        F.col("doc_id"), "lang", F.explode(F.array_distinct(F.array(*(F.lower(F.substring("text", p, WINDOW)) for p in at)))).alias("piece")
    )
    pieces = pieces.where(F.col("piece").rlike(r"\p{L}")).collect()
    pieces.sort(key=lambda r: (r.doc_id, r.piece))
    return train([r.piece for r in pieces], [r.lang for r in pieces]) if pieces else None


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the mean chance of this language over the text.

    The whole text counts, in windows weighted by their letters; case does not.
    Null, empty and letterless texts are ``und`` with score 0, and so is all if
    there was nothing to learn from. Own columns of these names are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    if network is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    names = docs.columns
    # A second copy of the texts would double what a batch holds, so they are lower-cased piece by piece.
    rows = docs.withColumn("_lettered", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    schema = StructType([*docs.schema]).add("lang_pred", "string").add("score", "double")
    held = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            texts = batch.column(names.index("text")).cast(pa.large_binary())
            lettered = batch.column(len(names)).to_pylist()
            ends_at = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
            best, score = np.full(len(texts), -1), np.zeros(len(texts))
            begin = 0
            while begin < len(best):  # about a megabyte of texts at once
                done = int(ends_at[begin - 1]) if begin else 0
                end = max(begin + 1, int(np.searchsorted(ends_at, done + (1 << 20), "right")))
                part = zip(texts.slice(begin, end - begin).to_pylist(), lettered[begin:end])
                low = pa.array([t.decode("utf-8", "replace").lower() if ok else None for t, ok in part], pa.large_string())
                windows, counts = windows_of(*text_bytes(low))
                weight = LETTER[windows].sum(axis=1)
                sums = np.concatenate([np.zeros((1, len(model.languages))), np.cumsum(model.scores(windows) * weight[:, None], axis=0, dtype=np.float64)])
                total = np.concatenate([[0.0], np.cumsum(weight, dtype=np.float64)])
                ends = np.cumsum(counts)
                mass = total[ends] - total[ends - counts]
                mean = (sums[ends] - sums[ends - counts]) / np.maximum(mass, 1)[:, None]
                found = mass > 0
                best[begin:end] = np.where(found, mean.argmax(axis=1), -1)
                score[begin:end] = np.where(found, mean.max(axis=1), 0)
                begin = end
            names_of = [*model.languages, UNKNOWN]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array([names_of[k] for k in best.tolist()], pa.string()), pa.array(np.clip(score, 0, 1), pa.float64())],
                [*names, "lang_pred", "score"],
            )
        release()

    return rows.mapInArrow(run, schema)

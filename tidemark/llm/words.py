"""Words of Arrow text columns as numpy arrays of 64-bit hashes.

Texts are read from the Arrow buffers in pieces of about ``PIECE`` bytes that
end at white space or at the end of a text, so memory stays flat however long
a text is. Two equal words have equal hashes; different words share one with a
chance of about 2**-64.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
#: Texts whose words are in memory at once.
ROWS = 512
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def release() -> None:
    """Give memory that a task has freed back to the system, as its Python worker stays for the next one."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other systems have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the 64-bit input."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    """A value for each byte; A-Z have those of a-z."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


VALUES = _byte_values()
_powers: dict[int, np.ndarray] = {}


def _powers_of(factor: int, n: int) -> np.ndarray:
    have = _powers.get(factor)
    if have is None or len(have) < n:
        have = np.full(max(n, PIECE + 4096), factor, np.uint64)
        have[0] = 1
        with np.errstate(over="ignore"):
            np.cumprod(have, out=have)
        if n <= 8 * PIECE:
            _powers[factor] = have
    return have[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and where each text begins; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about PIECE bytes that cut no word."""
    begin = 0
    while begin < len(data):
        end = begin + PIECE
        if end >= len(data):
            end = len(data)
        else:
            bound = offsets[np.searchsorted(offsets, end)]  # the end of the text that holds this byte
            step = end
            while step < bound and not (found := np.flatnonzero(SPACE[data[step : min(step + 4096, bound)]])).size:
                step += 4096
            end = min(step + int(found[0]), bound) if step < bound else int(bound)
        yield begin, end
        begin = end


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, lower-cased in A-Z, and where each text's words begin."""
    hashes, begins, _ = words_and_tails(column)
    return hashes, begins


def words_and_tails(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``word_hashes``, and the last two bytes of every word as a number (those of one byte: that byte)."""
    data, offsets = text_bytes(column)
    hashes, places, tails = [], [], []
    for begin, end in _pieces(data, offsets):
        part = data[begin:end]
        inside = ~SPACE[part]
        breaks = offsets[(offsets > begin) & (offsets < end)] - begin
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        first[breaks] = inside[breaks]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        last[breaks - 1] = inside[breaks - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        with np.errstate(over="ignore"):
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(VALUES[part] * _powers_of(BASE, len(part)), out=sums[1:])
            value = (sums[ends] - sums[starts]) * _powers_of(INVERSE, len(part))[starts]
        hashes.append(mix(value ^ (ends - starts).astype(np.uint64)))
        places.append(starts + begin)
        tails.append(part[ends - 1].astype(np.int32) + 256 * np.where(ends - starts > 1, part[ends - 2], 0).astype(np.int32))
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int32)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), offsets), np.concatenate(tails)


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its distinct runs of ``width`` words.

    A text with fewer words has the whole sequence as its one run; a text
    without words has none.
    """
    for at in range(0, len(column), ROWS):
        yield from _shingle_sets(column.slice(at, ROWS), width)


def _shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    hashes, begins = word_hashes(column)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    with np.errstate(over="ignore"):
        n = max(0, len(hashes) - width + 1)
        runs = np.full(n, width, np.uint64)
        for k in range(width):
            runs += hashes[k : k + n] * factors[k]
        runs = mix(runs)
        for begin, end in zip(begins[:-1].tolist(), begins[1:].tolist()):
            if end - begin >= width:
                yield np.unique(runs[begin : end - width + 1])
            elif end > begin:
                words = hashes[begin:end]
                yield mix(np.array([end - begin], np.uint64) + (words * factors[: end - begin]).sum(dtype=np.uint64))
            else:
                yield np.zeros(0, np.uint64)

"""Whole texts as flat byte arrays.

A batch of texts is one byte array with offsets. Words, lines and windows are
index ranges into it, and their 64-bit hashes come from one running sum, so no
Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes of text worked on at once; a longer text is worked on alone.
BLOCK_BYTES = 1 << 20
BASE = U64(0x9E3779B97F4A7C15)
BASE_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[:0x30] = NOT_ALNUM[0x3A:0x61] = NOT_ALNUM[0x7B:0x80] = True

_powers = np.ones(1, U64), np.ones(1, U64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = x.astype(U64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> U64(30)
        x *= U64(0xBF58476D1CE4E5B9)
        x ^= x >> U64(27)
        x *= U64(0x94D049BB133111EB)
        x ^= x >> U64(31)
    return x


BYTE_VALUE = mix(np.arange(1, 257, dtype=U64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2 ** 64 for i up to n."""
    global _powers
    if len(_powers[0]) <= n:
        size = max(n + 1, min(BLOCK_BYTES + 1, 4 * (n + 1)))

        def table(base):
            steps = np.full(size, base, U64)
            steps[0] = 1
            return np.cumprod(steps, dtype=U64)

        made = table(BASE), table(BASE_INVERSE)
        if size > 4 * BLOCK_BYTES:
            return made
        _powers = made
    return _powers


class Texts:
    """Texts of one block: ``data`` bytes, text i at ``offsets[i]:offsets[i + 1]``. A null text is empty."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, self.n = data, offsets, len(offsets) - 1
        self._sums = None

    def lower(self) -> Texts:
        return Texts(LOWER[self.data], self.offsets)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def spans(self, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of bytes that ``outside`` does not hold: starts, ends, text numbers. No run crosses two texts."""
        inside = ~outside[self.data]
        edge = np.zeros(len(inside) + 1, bool)
        edge[self.offsets] = True
        before = np.concatenate(([False], inside[:-1])) if len(inside) else inside
        after = np.concatenate((inside[1:], [False])) if len(inside) else inside
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        return starts, ends, np.searchsorted(self.offsets, starts, side="right") - 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte ranges, equal wherever the bytes are equal."""
        with np.errstate(over="ignore"):
            up, down = powers(len(self.data))
            if self._sums is None:
                sums = np.zeros(len(self.data) + 1, U64)
                np.cumsum(BYTE_VALUE[self.data] * up[:len(self.data)], out=sums[1:])
                self._sums = sums
            value = (self._sums[ends] - self._sums[starts]) * down[starts]
            return mix(value + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))

    def code_points(self) -> np.ndarray:
        """Code points per text."""
        return self.per_text((self.data & 0xC0) != 0x80)

    def per_text(self, marks: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(marks, out=sums[1:])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]


def windows(words: np.ndarray, docs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words inside one text, and the first word's index of each."""
    if len(words) < width:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    last = len(words) - width + 1
    with np.errstate(over="ignore"):
        total = np.zeros(last, U64)
        for j in range(width):
            total = (total + words[j:last + j]) * BASE
    first = np.flatnonzero(docs[:last] == docs[width - 1:])
    return mix(total[first]), first


def blocks(column: pa.Array, limit: int = 0) -> Iterator[tuple[int, int, Texts]]:
    """Cut a string column into blocks of about ``limit`` bytes: first row, end row, texts."""
    limit = limit or BLOCK_BYTES
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    raw = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        end = min(end, len(column))
        yield first, end, Texts(raw[at[first]:at[end]], at[first:end + 1] - at[first])
        first = end


def ragged(values: pa.Array | np.ndarray, counts: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """A list column from flat values and the length of each list."""
    at = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=at[1:])
    values = values if isinstance(values, pa.Array) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), values)

"""Words and lines of a whole Arrow batch as byte spans, found and gathered with numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Bytes that separate words: ASCII white space, as in WORD_PATTERN.
WHITE_SPACE = bytes([0x20, *range(0x09, 0x0E)])

ODD = np.uint64(0x9E3779B97F4A7C15)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the borders of its rows; a null row is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, borders, data = column.buffers()
    borders = np.frombuffer(borders, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), borders - borders[0]
    return np.frombuffer(data, np.uint8)[borders[0] : borders[-1]], borders - borders[0]


def text_array(data: np.ndarray, borders: np.ndarray) -> pa.Array:
    """A text column from its bytes and the borders of its rows."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(borders, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_string(), len(borders) - 1, buffers)


def byte_set(members: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(members)] = True
    return found


def word_spans(data: np.ndarray, borders: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every run without separators; a row border ends a run."""
    inside = ~separators[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    first = borders[:-1][borders[:-1] < len(data)]
    begins[first] = inside[first]
    last = borders[1:][borders[1:] > 0] - 1
    ends[last] = inside[last]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def rows_of(places: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Row that each byte place lies in."""
    return np.searchsorted(borders, places, side="right") - 1


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of the ranges, one range after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def mix(values: np.ndarray) -> np.ndarray:
    """An invertible scramble of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(32))) * ODD
    values = (values ^ (values >> np.uint64(29))) * ODD
    return values ^ (values >> np.uint64(32))


class Powers:
    """Powers of an odd number modulo 2**64 and their inverses, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            steps = np.full(1 << (n - 1).bit_length(), self.base)
            steps[0] = 1
            self.up = np.cumprod(steps)
            steps = np.full(len(steps), self.inverse)
            steps[0] = 1
            self.down = np.cumprod(steps)
        return self.up, self.down


def range_hashes(values: np.ndarray, begins: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """A polynomial hash of every range of ``values`` that does not depend on where the range lies."""
    up, down = powers.upto(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(np.uint64) * ODD)

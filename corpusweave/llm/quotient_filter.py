"""Counting quotient filters over packed word numbers, without loss.

A key packs the word numbers of an n-gram, ``bits`` bits each, into two halves. A Feistel network permutes
it, so that quotients are even whatever the numbers are, and can be turned back. The first bits of the
permuted key choose the shard, the next ones are the quotient, and all others are stored as remainder:
nothing is cut off, and a filter gives its keys and counts back exactly. A filter holds its entries in
order, as runs of a quotient each: a bit vector with a one for every entry and a zero after each run, the
remainders in whole bytes, and counters for entries that occur more than once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from corpusweave.llm.spans import mix

ROUNDS = 4
U64 = np.uint64


@dataclass(frozen=True)
class Keys:
    """Permuted keys of n-grams of ``words`` (two or more) numbers below ``2 ** bits``."""

    words: int
    bits: int

    @property
    def half(self) -> int:
        return -(-self.words * self.bits // 2)

    @property
    def narrow(self) -> bool:
        """Both halves fit into one number."""
        return 2 * self.half <= 64

    @property
    def mask(self) -> np.uint64:
        return U64((1 << self.half) - 1)

    def _round(self, values: np.ndarray, k: int) -> np.ndarray:
        return mix(values + U64((k + 1) * 0xBF58476D1CE4E5B9 % (1 << 64))) & self.mask

    def permute(self, grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Halves of the permuted keys of columns of word numbers."""
        left, right = np.zeros_like(grams[0]), np.zeros_like(grams[0])
        for column in grams:
            left = (left << U64(self.bits)) | (right >> U64(self.half - self.bits))
            right = ((right << U64(self.bits)) | column) & self.mask
        for k in range(ROUNDS):
            left, right = right, left ^ self._round(right, k)
        return left, right

    def restore(self, left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
        for k in reversed(range(ROUNDS)):
            left, right = right ^ self._round(left, k), left
        low, columns = U64((1 << self.bits) - 1), []
        for _ in range(self.words):
            columns.append(right & low)
            right = (right >> U64(self.bits)) | ((left & low) << U64(self.half - self.bits))
            left = left >> U64(self.bits)
        return columns[::-1]

    def order(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Stable order; sorted runs that follow each other are merged rather than sorted."""
        if self.narrow:
            return np.argsort((left << U64(self.half)) | right, kind="stable")
        return np.lexsort((right, left))

    def counted(self, left, right, counts=None):
        """Distinct keys in order with the sums of their counts."""
        if self.narrow and counts is None:
            keys, counts = np.unique((left << U64(self.half)) | right, return_counts=True)
            return keys >> U64(self.half), keys & self.mask, counts
        order = self.order(left, right)
        left, right = left[order], right[order]
        counts = np.ones(len(left), np.int64) if counts is None else counts[order]
        new = np.ones(len(left), bool)
        new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        heads = np.flatnonzero(new)
        return left[heads], right[heads], np.add.reduceat(counts, heads) if len(heads) else counts[:0]


def _as_bytes(values: np.ndarray, bits: int) -> bytes:
    width = -(-bits // 8)
    return np.ascontiguousarray(values).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _from_bytes(data: bytes, bits: int, n: int) -> np.ndarray:
    width = -(-bits // 8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(n, width)
    return out.view("<u8").ravel()


@dataclass(frozen=True)
class Filter:
    """Entries of one shard. ``shard_bits`` and ``quotient_bits`` are the first bits of the left half."""

    entries: int
    shard_bits: int
    quotient_bits: int
    runs: bytes
    remainders: bytes
    repeated: bytes
    counters: bytes

    @staticmethod
    def build(keys: Keys, shard_bits: int, left, right, counts) -> Filter:
        """From distinct keys of one shard in order."""
        n = len(left)
        quotient_bits = min(max(n - 1, 0).bit_length(), keys.half - shard_bits)
        rest = keys.half - shard_bits - quotient_bits
        quotient = (left >> U64(rest)) & U64((1 << quotient_bits) - 1)
        # The entry with rank i and quotient q is bit i + q; a zero ends every run.
        bits = np.zeros(n + (1 << quotient_bits), np.uint8)
        bits[np.arange(n) + quotient.astype(np.int64)] = 1
        more = counts > 1
        return Filter(
            n,
            shard_bits,
            quotient_bits,
            np.packbits(bits).tobytes(),
            _as_bytes(left & U64((1 << rest) - 1), rest) + _as_bytes(right, keys.half),
            np.packbits(more).tobytes(),
            counts[more].astype("<u8").tobytes(),
        )

    def read(self, keys: Keys, shard: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, rest = self.entries, keys.half - self.shard_bits - self.quotient_bits
        bits = np.unpackbits(np.frombuffer(self.runs, np.uint8))
        quotient = (np.flatnonzero(bits)[:n] - np.arange(n)).astype(np.uint64)
        cut = n * -(-rest // 8)
        low = _from_bytes(self.remainders[:cut], rest, n) if rest else np.zeros(n, np.uint64)
        high = (U64(shard) << U64(self.quotient_bits)) | quotient
        left = (high << U64(rest)) | low if rest < 64 else low
        counts = np.ones(n, np.int64)
        more = np.unpackbits(np.frombuffer(self.repeated, np.uint8))[:n].astype(bool)
        counts[more] = np.frombuffer(self.counters, "<u8").astype(np.int64)
        return left, _from_bytes(self.remainders[cut:], keys.half, n), counts


def shards(keys: Keys, shard_bits: int, left, right, counts):
    """(shard, filter) of distinct keys in order."""
    shard = (left >> U64(keys.half - shard_bits)).astype(np.int64)
    numbers, heads = np.unique(shard, return_index=True)
    for number, lo, hi in zip(numbers.tolist(), heads, np.append(heads[1:], len(left)), strict=True):
        yield number, Filter.build(keys, shard_bits, left[lo:hi], right[lo:hi], counts[lo:hi])


def merged(keys: Keys, shard: int, filters: list[Filter]):
    """Keys and summed counts of sorted filters of one shard."""
    parts = [f.read(keys, shard) for f in filters]
    return keys.counted(*[np.concatenate(column) for column in zip(*parts, strict=True)])

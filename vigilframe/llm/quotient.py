"""Counting quotient filters over packed word-id n-grams, without loss.

Three ids of `width` bits (0 stands for a missing first word) are packed and put through an invertible permutation, four
Feistel rounds over two halves, so keys spread evenly whatever the ids are.  The highest bits of a permuted key name the
shard, the next are the quotient, all others the remainder.  A filter of n keys holds its runs in order: a bit string
with a one per key and a zero at the end of each quotient's run, the full remainders byte plane by byte plane, and one byte
per counter, with counters above 254 written out behind; planes that hold little are squeezed by a general compressor.  As remainders are kept in full and the permutation can be undone,
a filter gives back exactly the n-grams and counts put in.  Filters are sorted, so merging two is one ordered pass.
"""

from __future__ import annotations

import struct
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from vigilframe.llm import tokens as T

U = np.uint64
ROUNDS = np.arange(1, 5, dtype=U) * T.STEP  # a number for each round
HEADER = struct.Struct("<BBBBqqq")
WIDEST = 32  # bits of a word id


def mask(bits: int) -> np.uint64:
    return U((1 << bits) - 1)


def half(width: int) -> int:
    return (3 * width + 1) // 2


class Grams(NamedTuple):
    """Permuted keys in ascending order, as two halves, with their counts."""

    left: np.ndarray
    right: np.ndarray
    count: np.ndarray


def permuted(ids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of the permuted keys; `ids` has three columns."""
    a, b, c = ids[:, 0].astype(U), ids[:, 1].astype(U), ids[:, 2].astype(U)
    h = half(width)
    low = b << U(width) | c
    left, right = low >> U(h) | a << U(2 * width - h), low & mask(h)
    for step in ROUNDS:
        left, right = right, left ^ T.mix(right + step) & mask(h)
    return left, right


def restored(left: np.ndarray, right: np.ndarray, width: int) -> np.ndarray:
    """The ids of permuted keys."""
    h = half(width)
    for step in ROUNDS[::-1]:
        left, right = right ^ T.mix(left + step) & mask(h), left
    low = (left << U(h) | right) & mask(2 * width)
    return np.stack([left >> U(2 * width - h), low >> U(width), low & mask(width)], axis=1).astype(np.int64)


def summed(left: np.ndarray, right: np.ndarray, count: np.ndarray, width: int) -> Grams:
    """Keys in order, equal ones added up."""
    h = half(width)
    order = np.argsort(left << U(h) | right, kind="stable") if 2 * h <= 64 else np.lexsort((right, left))
    left, right, count = left[order], right[order], count[order]
    new = np.ones(len(left), bool)
    new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    first = np.flatnonzero(new)
    return Grams(left[first], right[first], np.add.reduceat(count, first) if len(first) else count)


def merged(filters: list[Grams], width: int) -> Grams:
    """One filter of all keys; the stable sort finds the runs that are in order already and merges them."""
    return summed(*(np.concatenate(x) for x in zip(*filters)), width)


def low_bytes(values: np.ndarray, bits: int) -> bytes:
    n = (bits + 7) // 8
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].T).tobytes()


def from_low_bytes(data: bytes, bits: int, n: int) -> np.ndarray:
    size = (bits + 7) // 8
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8, n * size).reshape(size, n).T
    return out.view("<u8").reshape(n).astype(U)


def write(grams: Grams, width: int, shard_bits: int) -> bytes:
    """A filter of keys of one shard, as bytes."""
    h, n = half(width), len(grams.left)
    q = max(0, min(h - shard_bits, n.bit_length() - 1))
    rest = h - shard_bits - q
    inside = grams.left & mask(h - shard_bits)
    quotient = (inside >> U(rest)).astype(np.int64)
    runs = np.zeros(n + (1 << q), np.uint8)
    runs[np.arange(n) + quotient] = 1
    large = grams.count[grams.count > 254]
    body = b"".join([
        np.packbits(runs).tobytes(), low_bytes(inside & mask(rest), rest), low_bytes(grams.right, h),
        np.minimum(grams.count, 255).astype(np.uint8).tobytes(), large.astype("<i8").tobytes()])
    return HEADER.pack(width, shard_bits, q, 0, n, len(large), len(body)) + pa.compress(body, "zstd", asbytes=True)


def read(data: bytes, shard: int) -> Grams:
    width, shard_bits, q, _, n, n_large, size = HEADER.unpack_from(data)
    data, h, at = pa.decompress(data[HEADER.size:], size, "zstd", asbytes=True), half(width), 0
    rest = h - shard_bits - q

    def part(size: int) -> bytes:
        nonlocal at
        at += size
        return data[at - size:at]

    runs = np.unpackbits(np.frombuffer(part((n + (1 << q) + 7) // 8), np.uint8), count=n + (1 << q))
    quotient = (np.flatnonzero(runs) - np.arange(n)).astype(U)
    left = from_low_bytes(part(n * ((rest + 7) // 8)), rest, n)
    left |= quotient << U(rest) | U(shard) << U(h - shard_bits)
    right = from_low_bytes(part(n * ((h + 7) // 8)), h, n)
    count = np.frombuffer(part(n), np.uint8).astype(np.int64)
    count[count == 255] = np.frombuffer(part(8 * n_large), "<i8")
    return Grams(left, right, count)


def shards(grams: Grams, width: int, shard_bits: int):
    """(shard, filter) of the shards that have a key; they are neighbouring stretches of the sorted keys."""
    of = (grams.left >> U(half(width) - shard_bits)).astype(np.int64)
    starts = np.flatnonzero(np.diff(of, prepend=-1))
    for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(of)]):
        yield int(of[start]), write(Grams(*(x[start:stop] for x in grams)), width, shard_bits)


class Merging:
    """Merges the filters of a shard as they come; filters of like size are merged first, so each key moves seldom."""

    def __init__(self, width: int):
        self.width, self.stack = width, []

    def add(self, grams: Grams) -> None:
        self.stack.append(grams)
        while len(self.stack) > 1 and len(self.stack[-2].left) < 2 * len(self.stack[-1].left):
            last = self.stack.pop()
            self.stack[-1] = merged([self.stack[-1], last], self.width)

    def result(self) -> Grams | None:
        return merged(self.stack, self.width) if self.stack else None

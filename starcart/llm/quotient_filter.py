"""Counting quotient filters that lose nothing: sorted, compact counters of packed word-id n-grams.

A key has two halves of ``half`` bits. A Feistel network permutes all keys among themselves, so that they spread
evenly and can be had back. The first bits of a permuted key name its shard, the next ones are its quotient and
all others its remainder, which is kept in full: keys with equal quotients are never taken for one another.

A packed filter holds, in the order of the permuted keys: a bit per quotient that says if it occurs, a bit per key that
says if it ends its quotient's run, the remainders, and the counters in a byte each, larger ones apart.
Filters of one shard are merged as sorted lists, adding counters.
"""

from __future__ import annotations

import struct

import numpy as np

from starcart.llm.words import mix, spans

_ROUNDS = tuple(np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
_HEAD = struct.Struct("<QBQ")
_BIG = 255


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def permuted(left: np.ndarray, right: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """The place of each key among all keys of two halves of ``half`` bits, at most 64 each."""
    for key in _ROUNDS:
        left, right = right, left ^ (mix(right + key) & _mask(half))
    return left, right


def restored(left: np.ndarray, right: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys that ``permuted`` has put in these places."""
    for key in reversed(_ROUNDS):
        left, right = right ^ (mix(left + key) & _mask(half)), left
    return left, right


def added(
    left: np.ndarray, right: np.ndarray, counts: np.ndarray, half: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys in order, with the sums of their counts. Sorted stretches are merged, not sorted anew."""
    if not len(left):
        return left, right, counts
    if 2 * half <= 64:
        order = np.argsort(left << np.uint64(half) | right, kind="stable")
    else:
        order = np.lexsort((right, left))
    left, right = left[order], right[order]
    first = np.flatnonzero((np.diff(left, prepend=~left[:1]) != 0) | (np.diff(right, prepend=~right[:1]) != 0))
    return left[first], right[first], np.add.reduceat(counts[order], first)


def _bytes(numbers: np.ndarray, bits: int) -> bytes:
    """The low ``bits`` bits of each number in as few whole bytes."""
    width = -(-bits // 8)
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _numbers(data: memoryview, at: int, n: int, bits: int) -> tuple[np.ndarray, int]:
    width = -(-bits // 8)
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
    return wide.view("<u8").reshape(-1).astype(np.uint64), at + n * width


def _bits(data: memoryview, at: int, n: int) -> tuple[np.ndarray, int]:
    size = -(-n // 8)
    return np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n).astype(bool), at + size


def packed(left: np.ndarray, right: np.ndarray, counts: np.ndarray, half: int, shard_bits: int) -> dict[int, bytes]:
    """One filter per shard from permuted, sorted, different keys."""
    if not 0 <= shard_bits <= half <= 64:
        raise ValueError(f"{shard_bits} bits of shard in halves of {half}")
    below = half - shard_bits
    shard = left >> np.uint64(below) if below < 64 else np.zeros(len(left), np.uint64)
    first = np.flatnonzero(np.diff(shard.astype(np.int64), prepend=-1))
    out = {}
    for a, b in spans(first, len(left)):
        n = b - a
        quotient_bits = min(below, n.bit_length())
        rest_bits = below - quotient_bits
        inner = left[a:b] & _mask(below)
        quotient = (inner >> np.uint64(rest_bits) if rest_bits < 64 else np.zeros(n, np.uint64)).astype(np.int64)
        occurs = np.zeros(1 << quotient_bits, bool)
        occurs[quotient] = True
        ends = np.append(quotient[1:] != quotient[:-1], True)
        large = counts[a:b] >= _BIG
        out[int(shard[a])] = b"".join(
            [
                _HEAD.pack(n, quotient_bits, int(large.sum())),
                np.packbits(occurs).tobytes(),
                np.packbits(ends).tobytes(),
                _bytes(inner & _mask(rest_bits), rest_bits),
                _bytes(right[a:b], half),
                np.where(large, _BIG, counts[a:b]).astype(np.uint8).tobytes(),
                counts[a:b][large].astype("<i8").tobytes(),
            ]
        )
    return out


def unpacked(shard: int, data: bytes, half: int, shard_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The permuted keys of a filter, sorted, and their counts."""
    below = half - shard_bits
    n, quotient_bits, n_large = _HEAD.unpack_from(data)
    rest_bits = below - quotient_bits
    view = memoryview(data)
    occurs, at = _bits(view, _HEAD.size, 1 << quotient_bits)
    ends, at = _bits(view, at, n)
    rest, at = _numbers(view, at, n, rest_bits)
    right, at = _numbers(view, at, n, half)
    counts = np.frombuffer(view, np.uint8, n, at).astype(np.int64)
    counts[counts == _BIG] = np.frombuffer(view, "<i8", n_large, at + n)
    run = np.cumsum(ends) - ends
    quotient = np.flatnonzero(occurs).astype(np.uint64)[run]
    left = quotient << np.uint64(rest_bits) | rest if rest_bits < 64 else rest
    if below < 64:
        left = np.uint64(shard) << np.uint64(below) | left
    return left, right, counts


def merged(shard: int, filters: list[bytes], half: int, shard_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sum of the filters of one shard: permuted keys in order, and their counts."""
    parts = [unpacked(shard, data, half, shard_bits) for data in filters]
    return added(*(np.concatenate(x) for x in zip(*parts, strict=True)), half)

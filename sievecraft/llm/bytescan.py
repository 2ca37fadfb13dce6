"""Vectorised scans of UTF-8 bytes: fingerprints of all windows, sliding minima, words.

Fingerprints are polynomial in a fixed odd base modulo 2**64 over a fixed table of
byte values, taken from prefix sums, so every window of a length costs a few
operations on arrays; they are mixed before use.  All functions work on one text
(or piece) at a time and hold a few arrays of its length.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(20_24).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_32 = np.uint64(32)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _32)) * _MIX
    x = (x ^ (x >> _32)) * _MIX
    return x ^ (x >> _32)


@lru_cache(maxsize=4)
def _powers(base: int, bits: int) -> np.ndarray:
    out = np.full(1 << bits, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def powers(n: int, inverse: bool = False) -> np.ndarray:
    base = pow(BASE, -1, 1 << 64) if inverse else BASE
    return _powers(base, max(17, int(n).bit_length()))


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTES[data]


def value_sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of symbols of any values."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[: len(values)], out=out[1:])
    return out


def prefix_sums(data: np.ndarray) -> np.ndarray:
    return value_sums(_BYTES[data])


def fingerprints(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Of the strings from ``start`` to before ``end``."""
    return mixed((sums[end] - sums[start]) * powers(len(sums), True)[start])


def all_fingerprints(sums: np.ndarray, length: int) -> np.ndarray:
    """Of the windows of ``length`` at every position."""
    n = len(sums) - length
    return mixed((sums[length:] - sums[:n]) * powers(len(sums), True)[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by minima from both ends of blocks."""
    n = len(x)
    blocks = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    blocks[:n] = x
    blocks = blocks.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows (nulls are empty)."""
    if column.null_count:
        column = column.fill_null("")
    big = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if big else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    return (np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(1, np.uint8)), offsets


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.ones(256, bool)
for _a, _b in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
    _IN_WORD[_a : _b + 1] = False


def in_word(data: np.ndarray) -> np.ndarray:
    """Whether each byte is one of a word, once it is lower-cased."""
    return _IN_WORD[_LOWER[data]]


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and fingerprints of the words of lower-cased ``data``."""
    low = _LOWER[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], _IN_WORD[low], [False])).astype(np.int8)))
    start, end = edges[::2], edges[1::2]
    return start, end, fingerprints(prefix_sums(low), start, end) + (end - start).astype(np.uint64)

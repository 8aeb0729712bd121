"""Hashes of many byte strings at once, in numpy.

The hash of a string is a polynomial in an odd number modulo 2^64 over random
64-bit values of its bytes. From prefix sums over a buffer the hash of any
substring costs a subtraction and a multiplication, wherever it starts.
"""

from __future__ import annotations

import functools

import numpy as np

_WORD = 2 ** 64


@functools.lru_cache(maxsize=8)
def _parameters(seed: int) -> tuple[np.ndarray, int, int]:
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    base = int(rng.integers(2 ** 40, 2 ** 60)) * 8 + 5
    return values, base, pow(base, -1, _WORD)


_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        steps = np.full(size, np.uint64(base), np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        _powers[base] = known
    return known[:n]


def forget() -> None:
    """Drop the tables of powers (they are as long as the longest buffer so far)."""
    _powers.clear()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Substrings:
    """Hashes of substrings of one buffer."""

    def __init__(self, data, seed: int = 1):
        buf = data if isinstance(data, np.ndarray) else np.frombuffer(data, np.uint8)
        values, base, inverse = _parameters(seed)
        n = len(buf)
        self._prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(values[buf] * _power_table(base, n), out=self._prefix[1:])
        self._inverse = _power_table(inverse, n + 1)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of ``buffer[start:end]``; equal strings get equal hashes."""
        raw = (self._prefix[end] - self._prefix[start]) * self._inverse[start]
        length = (np.asarray(end) - np.asarray(start)).astype(np.uint64)
        return mix(raw + length * np.uint64(0x9E3779B97F4A7C15))


def whole_hash(buf: np.ndarray, seed: int, piece: int = 1 << 20) -> np.uint64:
    """``Substrings(buf, seed).hash`` of all of ``buf``, in memory for a piece of it."""
    values, base, _ = _parameters(seed)
    raw, shift, step = 0, 1, pow(base, piece, _WORD)
    for a in range(0, len(buf), piece):
        part = values[buf[a:a + piece]] * _power_table(base, min(piece, len(buf) - a))
        raw += int(part.sum(dtype=np.uint64)) * shift
        shift = shift * step % _WORD
    return mix(np.array([(raw + len(buf) * 0x9E3779B97F4A7C15) % _WORD], np.uint64))[0]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """``min(x[i:i+width])`` for every i, from block prefixes and suffixes."""
    n = len(x)
    if n < width:
        return x[:0]
    padded = np.concatenate([x, np.full((-n) % width, np.iinfo(x.dtype).max, x.dtype)])
    blocks = padded.reshape(-1, width)
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    since = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    return np.minimum(since[:m], upto[width - 1:width - 1 + m])

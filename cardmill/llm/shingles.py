"""Words and five-word shingles of texts as 64-bit hashes, vectorised over the bytes of a text."""

from __future__ import annotations

import hashlib

import numpy as np

LOWER_BYTES = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_rng = np.random.default_rng(20240917)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_ORDER = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_BASE = int(_rng.integers(1, 2**62)) * 8 + 5
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64, at least ``n`` of them."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, 1 << 16, 2 * len(known) if known is not None else 0)
        steps = np.full(size, base & (2**64 - 1), dtype=np.uint64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def value_sums(values: np.ndarray) -> np.ndarray:
    """Sums of 64-bit values times powers before each place; differences of them give the hash of any stretch."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(_BASE, len(values)), out=sums[1:])
    return sums


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """``value_sums`` of byte codes."""
    return value_sums(_BYTE[data])


def substring_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each substring ``starts:ends``, equal for equal bytes wherever they stand."""
    return mix((sums[ends] - sums[starts]) * powers(_INVERSE, len(sums))[starts])


def window_hashes(sums: np.ndarray, width: int) -> np.ndarray:
    """The hashes of all stretches of ``width`` values, in order."""
    n = max(len(sums) - width, 0)
    return mix((sums[len(sums) - n :] - sums[:n]) * powers(_INVERSE, len(sums))[:n])


def word_edges(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word."""
    space = _SPACE[data]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(space) and not space[0]:
        edges = np.concatenate(([0], edges))
    if len(edges) % 2:
        edges = np.append(edges, len(data))
    return edges[0::2], edges[1::2]


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of a text, A-Z lower-cased, in order."""
    data = np.frombuffer(text.translate(LOWER_BYTES), dtype=np.uint8)
    return substring_hashes(prefix_sums(data), *word_edges(data))


def shingle_set(text: bytes, width: int = 5) -> np.ndarray:
    """The sorted distinct shingles; a text of fewer words is one shingle, a text without words has none."""
    words = word_hashes(text)
    if not len(words):
        return words
    n = max(len(words) - width + 1, 1)
    used = min(width, len(words))
    total = np.full(n, used, dtype=np.uint64)
    for k in range(used):
        total += words[k : k + n] * _ORDER[k]
    return np.unique(mix(total))


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()

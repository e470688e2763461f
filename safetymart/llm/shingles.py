"""Word shingles of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import hashlib

import numpy as np

from safetymart.llm.common import LOWER, SPACES

_RNG = np.random.default_rng(20_240_414)
_U64 = np.uint64
# A random odd base and a random number per byte, the same for both cases of a letter.
_BASE = int(_RNG.integers(1 << 62, 1 << 63)) * 2 + 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_OF_BYTE = _RNG.integers(0, 1 << 64, 256, dtype=np.uint64)[np.frombuffer(LOWER, np.uint8)]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES.encode())] = True
_MIX = (_U64(0xFF51AFD7ED558CCD), _U64(0xC4CEB9FE1A85EC53))
_STEP = _U64(0x9E3779B97F4A7C15)

# Bytes above which a word has a digest of its own.
LONG_WORD = 64

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64; the longest asked for is kept."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        factors = np.full(n, base % (1 << 64), np.uint64)
        factors[:1] = 1
        known = _powers[base] = np.multiply.accumulate(factors)
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U64(33))) * _MIX[0]
    h = (h ^ (h >> _U64(29))) * _MIX[1]
    return h ^ (h >> _U64(32))


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of adjoining texts, and each text's first word.

    A word's hash is a difference of two prefix sums of byte values times powers
    of the base, brought back to its start; so no word is looked at on its own.
    """
    starts = starts - starts[0]
    inside = ~_IS_SPACE[data]
    edges = starts[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    before = np.concatenate([[False], inside[:-1]])
    before[edges] = False
    begin = np.flatnonzero(inside & ~before)
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    after[edges - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_OF_BYTE[data] * powers(_BASE, len(data)), out=sums[1:])
    h = mix((sums[end] - sums[begin]) * powers(_INVERSE, len(data) + 1)[begin])
    # Some long words have equal sums with every base modulo 2**64.
    for i in np.flatnonzero(end - begin > LONG_WORD).tolist():
        word = data[begin[i] : end[i]].tobytes().translate(LOWER)
        h[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return h, np.searchsorted(begin, starts)


def shingle_sets(data: np.ndarray, starts: np.ndarray, width: int) -> list[np.ndarray]:
    """Each text's distinct shingles of ``width`` words, sorted.

    A text of fewer words has one shingle, its whole sequence; without words none.
    """
    words, first = word_hashes(data, starts)
    full = words[: max(0, len(words) - width + 1)].copy()
    for i in range(1, width):
        full = mix(full * _STEP) + words[i : i + len(full)]
    full = mix(full)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            sets.append(np.unique(full[a : b - width + 1]))
        elif b > a:
            whole = words[a : a + 1].copy()
            for i in range(a + 1, b):
                whole = mix(whole * _STEP) + words[i]
            # The number of words keeps a short sequence apart from any longer one.
            sets.append(mix(whole ^ _U64(b - a)))
        else:
            sets.append(words[:0])
    return sets

"""Hashed words and shingles of one text, in numpy; they run inside Arrow tasks."""

from __future__ import annotations

import hashlib

import numpy as np

from reportlens.llm.common import travels_by_value

travels_by_value(__name__)
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        steps = np.full(size, _BASE, np.uint64)
        steps[0] = 1
        _POWERS[0] = np.multiply.accumulate(steps)
    return _POWERS[0]


def runs_of(raw: bytes, inside: np.ndarray):
    """The runs of bytes that ``inside`` admits, A-Z lower-cased: per byte its
    term of the run's polynomial hash and its place, per run start and length.
    The sum of a run's terms is its hash, the sum of the first n that of its
    first n bytes."""
    a = np.frombuffer(raw.translate(_LOWER), np.uint8)
    at = np.flatnonzero(inside[a])
    starts = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    lengths = np.diff(starts, append=len(at))
    place = np.arange(len(at)) - np.repeat(starts, lengths)
    chars = (a[at].astype(np.uint64) + np.uint64(1)) * _powers(int(lengths.max(initial=1)))[place]
    return chars, place, starts, lengths


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hash of each word [^\\x20\\x09-\\x0D]+ of the UTF-8 text, A-Z lower-cased."""
    chars, _, starts, _ = runs_of(raw, _WORD)
    return mix(np.add.reduceat(chars, starts)) if len(starts) else np.empty(0, np.uint64)


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words, in text order; with fewer words, of all of them as one."""
    if not len(words):
        return words
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = mix(out + words[k:len(words) - n + 1 + k] + np.uint64(k + 1))
    return out


def shingle_set(raw: bytes | None, n: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; empty for null or no word."""
    return np.unique(windows(word_hashes(raw), n)) if raw else np.empty(0, np.uint64)


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def multipliers(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit factors, the same everywhere."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed)) | np.uint64(1)


def min_hashes(shingles: np.ndarray, factors: np.ndarray, block: int = 1024) -> np.ndarray:
    """For each factor the least permuted shingle."""
    out = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), block):
        np.minimum(out, (factors[:, None] * shingles[None, i:i + block]).min(axis=1), out=out)
    return out

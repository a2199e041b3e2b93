"""Vectorised word and shingle hashing over the UTF-8 bytes of one text (numpy, used inside tasks).

A word's hash is a polynomial over random 64-bit byte values, taken from prefix sums, so one pass over the bytes hashes
every word. Texts are walked in windows of at most ``WINDOW`` bytes that end at white space, so memory is bounded by
the window; a single word of ``WINDOW`` bytes or more is hashed with blake2b instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np

WINDOW = 1 << 20
U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
BYTE_VALUE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=U64)
FACTORS = np.random.default_rng(31).integers(1, 1 << 63, 64, dtype=U64) * U64(2) + U64(1)  # one odd factor per place
_BLANK = b" \t\n\x0b\x0c\r"


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser; every input bit reaches every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    up = np.full(WINDOW, BASE, U64)
    down = np.full(WINDOW, pow(BASE, -1, 1 << 64), U64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def windows(raw: bytes) -> Iterator[tuple[bytes, bool]]:
    """``(piece, is one oversized word)`` pieces of ``raw``, cut at white space."""
    at, n = 0, len(raw)
    while at < n:
        if n - at < WINDOW:
            yield raw[at:], False
            return
        piece = raw[at:at + WINDOW]
        cut = max(piece.rfind(c) for c in (b" ", b"\n", b"\t", b"\x0b", b"\x0c", b"\r"))
        if cut >= 0:
            yield piece[:cut + 1], False
            at += cut + 1
            continue
        end = at + WINDOW
        while end < n and raw[end] not in _BLANK:
            end += 1
        yield raw[at:end], True
        at = end


def _hash_words(piece: bytes) -> np.ndarray:
    b = np.frombuffer(piece, np.uint8)
    if not len(b):
        return np.empty(0, U64)
    blank = SPACE[b]
    padded = np.ones(len(b) + 2, bool)
    padded[1:-1] = blank
    edge = np.flatnonzero(padded[1:] != padded[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, U64)
    up, down = _powers()
    run = np.zeros(len(b) + 1, U64)
    np.cumsum(BYTE_VALUE[b] * up[:len(b)], out=run[1:])
    return mix((run[end] - run[start]) * down[start] + (end - start).astype(U64))


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hash of each word ``[^\\x20\\x09-\\x0D]+`` of ``raw``, in order."""
    out = [np.frombuffer(hashlib.blake2b(p, digest_size=8).digest(), U64) if big else _hash_words(p)
           for p, big in windows(raw)]
    return out[0] if len(out) == 1 else np.concatenate([np.empty(0, U64), *out])


def shingle_set(text: str | None, k: int = 5) -> np.ndarray:
    """Sorted distinct ``k``-word shingle hashes; fewer words give the whole sequence as one; no words give none."""
    w = word_hashes((text or "").encode("utf-8", "surrogatepass").translate(LOWER))
    if not len(w):
        return w
    size = min(k, len(w))
    n = len(w) - size + 1
    h = w[:n] * FACTORS[0] + U64(size)
    for j in range(1, size):
        h += w[j:n + j] * FACTORS[j % len(FACTORS)]
    h = mix(h)
    h.sort()
    keep = np.ones(len(h), bool)
    np.not_equal(h[1:], h[:-1], out=keep[1:])
    return h[keep]

"""MinHash signatures of shingle sets."""

from __future__ import annotations

import numpy as np

from swelter.llm.common import BLANK_WORDS, Words, mixed, slices

SHINGLE = 2
CHUNKS, CHUNK, ERRORS = 10, 6, 1
PERMUTATIONS = CHUNKS * CHUNK

_RNG = np.random.default_rng(7)
_A = (_RNG.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _RNG.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint64).astype(np.uint32)
_STEP = 1 << 15


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE):
    """The sorted distinct shingle hashes of each text, in order."""
    for i, j in slices(offsets):
        w = Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], BLANK_WORDS)
        grams = w.grams(size)
        for r in range(j - i):
            a, b = w.first[r], w.first[r + 1]
            if b - a >= size:
                yield np.unique(grams[a : b - size + 1])
            elif b > a:  # fewer words: the whole sequence is the one shingle
                yield np.array([_whole(w.hashes[a:b])], np.uint64)
            else:
                yield grams[:0]


def _whole(hashes: np.ndarray) -> np.uint64:
    h = np.array([len(hashes)], np.uint64)
    for x in hashes:
        h = mixed(h * np.uint64(31) + x)
    return h[0]


def signature(shingles: np.ndarray) -> np.ndarray:
    """``PERMUTATIONS`` 16-bit symbols; two sets agree in a symbol with the probability of their similarity."""
    low = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    v = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    for k in range(0, len(v), _STEP):
        np.minimum(low, (v[k : k + _STEP, None] * _A + _B).min(0), out=low)
    return (mixed(low.astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)


_MASKS = [tuple(k for k in range(CHUNK) if k != left) for left in range(CHUNK)]


def block_keys(signatures: np.ndarray) -> np.ndarray:
    """For each signature, a key for every chunk and every choice of ``ERRORS`` positions that may differ in it.

    By the pigeonhole principle, signatures that differ in fewer than CHUNKS * (ERRORS + 1) positions have a chunk with at most
    ``ERRORS`` differences, and so a key in common.
    """
    s = signatures.reshape(len(signatures), CHUNKS, CHUNK).astype(np.uint64)
    out = np.empty((len(s), CHUNKS, len(_MASKS)), np.uint64)
    for m, kept in enumerate(_MASKS):
        h = np.broadcast_to(np.uint64(m + 1) + np.uint64(16) * np.arange(CHUNKS, dtype=np.uint64), s.shape[:2])
        for k in kept:
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + s[:, :, k])
        out[:, :, m] = h
    return out.reshape(len(s), -1)

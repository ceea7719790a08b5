"""Words of a whole Arrow batch as numpy arrays of positions and 64-bit hashes.

Works on the UTF-8 bytes of all texts of a batch at once; no Python object per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SEED = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x5851F42D4C957F2D
MASK = (1 << 64) - 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
SPAN = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (an invertible mix)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_CACHE: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2**64."""
    if len(_CACHE.get("up", ())) < n:
        size = max(n, SPAN + 2)
        up, down = _powers(BASE, size), _powers(BASE_INVERSE, size)
        if size > 4 * SPAN:
            return up, down
        _CACHE["up"], _CACHE["down"] = up, down
    return _CACHE["up"], _CACHE["down"]


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and the offsets of each text; null is empty."""
    texts = texts.cast(pa.binary()) if not pa.types.is_binary(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def words(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE):
    """Start and end of every word, and the index of each text's first word.

    A word is a longest run of bytes outside ``gap``; it never crosses texts.
    """
    inside = ~gap[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of each range of bytes, computed over spans of bounded size."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SPAN, "right")))
        low, high = int(starts[i]), int(ends[j - 1])
        up, down = powers(high - low + 1)
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=total[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64) * SEED
        i = j
    return mix(out)


FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                    0xA0761D6478BD642F], dtype=np.uint64)


# Marks the number of words of a sequence too short for a full shingle.
FEW = np.arange(64, dtype=np.uint64) * SEED


def shingles(word_hashes: np.ndarray, first: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``size`` words.

    A text of fewer words gives its whole sequence as one shingle, a text without words none.
    """
    n = len(word_hashes)
    factor = np.resize(FACTORS, size) * (np.arange(size, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    run = np.zeros(max(0, n - size + 1), np.uint64)
    for j in range(size):
        run += word_hashes[j : n - size + 1 + j] * factor[j] if n >= size else run
    run = mix(run)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            out.append(np.unique(run[a : b - size + 1]))
        elif b > a:
            few = (word_hashes[a:b] * factor[: b - a]).sum(dtype=np.uint64, keepdims=True) + FEW[b - a]
            out.append(mix(few))
        else:
            out.append(np.zeros(0, np.uint64))
    return out

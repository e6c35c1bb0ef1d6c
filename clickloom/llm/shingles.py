"""Word-shingle sets as 64-bit hashes, and their fast similarity sketches."""

from __future__ import annotations

import numpy as np
import xxhash

#: Odd multipliers of a 64-bit finaliser. Fixed values.
_MIX_1, _MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(33)
_VALUE_BITS = np.uint64(48)
_VALUE_MASK = np.uint64((1 << 48) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the input; a permutation of 64-bit numbers."""
    x = (x ^ (x >> _SHIFT)) * _MIX_1
    x = (x ^ (x >> _SHIFT)) * _MIX_2
    return x ^ (x >> _SHIFT)


def shingle_set(text: str, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; A-Z in lower case.

    A text of fewer words is one shingle, one without words none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(n, size)
    out = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        out = mix(out * _STEP + hashes[i : n - width + 1 + i])
    return np.unique(out)


def similarity_sketch(elements: np.ndarray, size: int) -> np.ndarray:
    """``size`` coordinates of a non-empty set; two sets agree in about their Jaccard similarity's share of them.

    In round i every element is hashed to a bin and a value; a bin keeps the least of (round, value). After
    ``size`` rounds, round ``size + j`` places all elements into bin j, so that every bin gets a value at
    the latest then. Rounds stop once all bins are filled: later ones could not change them.
    """
    bins = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    n = len(elements)
    done = 0
    while done < 2 * size:
        rounds = np.arange(done, min(2 * size, done + max(1, 4096 // n)), dtype=np.uint64)
        hashed = mix(elements + (rounds[:, None] + np.uint64(1)) * _STEP)
        free = ((hashed >> np.uint64(48)) * np.uint64(size)) >> np.uint64(16)
        fixed = np.broadcast_to(rounds[:, None] - np.uint64(size), hashed.shape)
        place = np.where(rounds[:, None] < size, free, fixed)
        value = rounds[:, None] << _VALUE_BITS | (hashed & _VALUE_MASK)
        np.minimum.at(bins, place.ravel().astype(np.intp), value.ravel())
        done += len(rounds)
        if bins.max() < np.iinfo(np.uint64).max:
            break
    return bins


def band_keys(sketch: np.ndarray, rows: int) -> np.ndarray:
    """A key for each run of ``rows`` coordinates; equal keys mean equal coordinates of the same run."""
    bands = sketch.reshape(-1, rows)
    keys = np.arange(len(bands), dtype=np.uint64)
    for column in bands.T:
        keys = mix(keys * _STEP + column)
    return keys

"""64-bit hashes of words and word shingles, for many texts at once.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return, with A-Z lower-cased; in UTF-8 those bytes are never part of another character.
"""

from __future__ import annotations

import string

import numpy as np

# The 64-bit golden ratio and the multipliers of splitmix64, a public finaliser.
GOLDEN, MIX_1, MIX_2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
BASE = 0x5851F42D4C957F2D
STEP_SEED = 20240229
NO_MARKS = bytes(32 if chr(b) in string.punctuation else b for b in range(256))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = x + np.uint64((seed * GOLDEN + GOLDEN) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_2)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str | None], marks: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of all texts in order, and each text's first place (and the end).

    A word's hash is a polynomial in its bytes, taken from running sums over all bytes. Without
    `marks`, ASCII punctuation separates words like white space.
    """
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    if not marks:
        raw = [t.translate(NO_MARKS) for t in raw]
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    ends = np.cumsum(lengths + 1)  # a space after each text keeps words apart
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).view(np.int8)))
    first, stop = edge[0::2], edge[1::2]
    lower = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    with np.errstate(over="ignore"):
        powers = np.full(len(data), BASE, np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * powers, out=sums[1:])
        back = np.full(len(data), pow(BASE, -1, 1 << 64), np.uint64)
        back[0] = 1
        np.cumprod(back, out=back)
        hashes = mix((sums[stop] - sums[first]) * back[first] + (stop - first).astype(np.uint64))
    return hashes, np.concatenate([[0], np.searchsorted(first, ends)])


def ngram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of the `size` words from each place on, over the ends of texts as well."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(n, np.uint64)
        for j in range(size):
            total += mix(hashes[j : j + n], 101 + j) * np.uint64(2 * j + 1)
        return mix(total, STEP_SEED)


def shingle_sets(texts: list[str | None], size: int = 5) -> list[np.ndarray]:
    """Each text's sorted distinct shingles of `size` words.

    With fewer words, the whole sequence is the one shingle; without words the set is empty.
    """
    hashes, starts = word_hashes(texts)
    grams = ngram_hashes(hashes, size)
    out = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        else:
            out.append(ngram_hashes(hashes[a:b], b - a) if b > a else np.empty(0, np.uint64))
    return out

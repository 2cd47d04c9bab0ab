"""Hashes of words and word shingles of many texts at once, in numpy.

All texts of a batch lie in one byte array.  Running sums of byte values times powers of an odd base
give the hash of any stretch by one subtraction, so no Python code runs per word.
"""

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_RNG = np.random.default_rng(20240817)
_BYTES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_FACTORS = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 20), base, np.uint64)
        have[0] = 1
        have = _POWERS[base] = np.cumprod(have)
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, each with a blank behind it, and where each starts (and the end)."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return data, starts


def running(data: np.ndarray, values: np.ndarray = _BYTES) -> np.ndarray:
    """Sums before each place, of byte values times powers of the base."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * _powers(_BASE, len(data)), out=sums[1:])
    return sums


def stretches(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each stretch ``start:end``; equal stretches have equal hashes wherever they lie."""
    return mixed((sums[end] - sums[start]) * _powers(_INVERSE, len(sums))[start] + (end - start).astype(np.uint64))


def shingle_sets(texts: list[str], k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """``(text number, hash)`` of the distinct k-word shingles of each text, sorted by both.

    Letters A-Z are lower-cased, words end at ASCII white space.  A text of fewer words, but not none,
    has its whole sequence as one shingle.
    """
    data, starts = laid_out([t.encode("utf-8", "surrogatepass") for t in texts])
    if len(data) == len(texts):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    data = _LOWER[data]
    space = _SPACE[data]
    edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)  # every text has a blank behind it
    word = stretches(running(data), begin, end)
    doc = np.searchsorted(starts, begin, side="right") - 1
    n = np.bincount(doc, minlength=len(texts))
    owners, hashes = [], []
    if len(word) >= k:
        run = np.zeros(len(word) - k + 1, np.uint64)
        for j in range(k):
            run += word[j:len(word) - k + 1 + j] * _FACTORS[j]
        whole = doc[k - 1:] == doc[:len(doc) - k + 1]
        owners.append(doc[:len(doc) - k + 1][whole])
        hashes.append(mixed(run[whole]))
    first = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(n, out=first[1:])
    for d in np.flatnonzero((n > 0) & (n < k)):
        owners.append(np.array([d]))
        got = (word[first[d]:first[d + 1]] * _FACTORS[:n[d]]).sum(dtype=np.uint64) + np.uint64(n[d])
        hashes.append(mixed(np.array([got], np.uint64) ^ np.uint64(0x5DEECE66D)))
    owner, h = np.concatenate(owners), np.concatenate(hashes)
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
    return owner[new], h[new]


def ranks(owner: np.ndarray) -> np.ndarray:
    """Place of each entry within its owner's run."""
    if not len(owner):
        return np.empty(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    return np.arange(len(owner)) - np.repeat(first, np.diff(np.concatenate([first, [len(owner)]])))

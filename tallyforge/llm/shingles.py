"""Hashes of five-word shingles of whole texts, in numpy, many texts at a time.

A word is a run of bytes other than 0x20 and 0x09 to 0x0D. A text of one to four words has one
shingle, of all its words; a text with no word has none."""

from __future__ import annotations

import numpy as np

WORDS = 5
_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_TURN = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_TURN), -1, 2**64))
_PLACE = _rng.integers(1, 2**63, WORDS, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit permutation."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every shingle, in order; bytes ``data``, offsets ``at`` (texts + 1)."""
    base, n = int(at[0]), len(at) - 1
    b = data[base : int(at[-1])]
    at = at - base
    if not len(b):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = ~_SPACE[b]
    first = np.zeros(len(b), bool)
    first[at[:-1][at[:-1] < len(b)]] = True  # a text's first byte begins a word of its own
    begins = word & (first | ~np.concatenate(([False], word[:-1])))
    ends = word & np.concatenate((first[1:] | ~word[1:], [True]))
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    with np.errstate(over="ignore"):
        turn = np.cumprod(np.full(len(b), _TURN, np.uint64))
        back = np.cumprod(np.full(len(b), _BACK, np.uint64))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[b] * turn)))
        words = mix((total[e] - total[s]) * back[s] + (e - s).astype(np.uint64))
        doc = np.searchsorted(at, s, "right") - 1
        end = np.searchsorted(doc, np.arange(n), "right")  # first word after each text
        i = np.arange(len(words))
        keep = (i + WORDS <= end[doc]) | ((i == 0) | (doc != np.concatenate(([-1], doc[:-1]))))
        i = i[keep]
        h = np.zeros(len(i), np.uint64)
        for k in range(WORDS):
            there = i + k < end[doc[i]]
            h += np.where(there, words[np.minimum(i + k, len(words) - 1)] * _PLACE[k], np.uint64(0))
        return mix(h), doc[i]


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of one text's shingles."""
    return np.unique(shingle_hashes(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0])


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Likeness of two sets of hashes; 1 for two empty ones."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def shared(left: list[np.ndarray], right: list[np.ndarray], columns: int) -> np.ndarray:
    """How many hashes each set of left has in common with each of right: products of 0-1 matrices over the
    hashes that more than one set has, ``columns`` at a time."""
    flat = np.concatenate([*left, *right, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    _, of, times = np.unique(flat, return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1
    some = times[of] > 1
    owner, at = owner[some], column[of[some]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, int(at[-1]) + 1 if len(at) else 0, columns):
        part = slice(*np.searchsorted(at, (first, first + columns)))
        ones = np.zeros((len(left) + len(right), columns), np.float32)
        ones[owner[part], at[part] - first] = 1
        out += ones[: len(left)] @ ones[len(left) :].T
    return out


def chunks(at: np.ndarray, size: int = 1 << 20):
    """Ranges of texts of about ``size`` bytes."""
    first, n = 0, len(at) - 1
    while first < n:
        last = min(n, max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1))
        yield first, last
        first = last

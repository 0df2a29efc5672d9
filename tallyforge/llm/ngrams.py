"""Hashed character n-grams of whole texts, counted in numpy, and logistic regression over them."""

from __future__ import annotations

import numpy as np

BITS = 12
DIM = 2 << BITS  # bigrams, then trigrams

#: Bytes that count as they are: lower-case letters and all of multi-byte characters. Others are a space.
_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)
#: All bytes as they are, but digits, which count as one.
ALL = np.arange(256).astype(np.uint8)
ALL[48:58] = 48


def _hashed(x: np.ndarray) -> np.ndarray:
    return ((x * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)


def counts(data: np.ndarray, at: np.ndarray, table: np.ndarray = _LETTER):
    """For each text (bytes and offsets) the counts of its n-grams, an array of DIM; table: what a byte counts as."""
    chunk = 1 << 20
    n, first = len(at) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + chunk, "right")) - 1)
        base = at[first]
        b = table[data[base : at[last]]].astype(np.uint32)
        two = (b[:-1] << np.uint32(8)) | b[1:]
        bi, tri = _hashed(two), _hashed((two[:-1] << np.uint32(8)) | b[2:]) + (1 << BITS)
        for k in range(first, last):
            s, e = at[k] - base, at[k + 1] - base
            out = np.bincount(bi[s : max(s, e - 1)], minlength=DIM)
            if e - s > 2:
                out = out + np.bincount(tri[s : e - 2], minlength=DIM)
            yield out
        first = last


def features(data: np.ndarray, at: np.ndarray, table: np.ndarray = _LETTER) -> np.ndarray:
    """Unit vectors of the square roots of the counts, a row a text."""
    out = np.zeros((len(at) - 1, DIM), np.float32)
    for k, c in enumerate(counts(data, at, table)):
        x = np.sqrt(c)
        norm = np.sqrt((x * x).sum())
        out[k] = x / norm if norm else 0
    return out


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 300, l2: float = 1e-4, rate: float = 8.0, use: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases of one logistic regression for each column of y (0, 1), by accelerated descent.

    ``use``: which rows count; the others stay where they are, so that x isn't copied."""
    d = x.shape[1]
    share = (np.ones(len(x)) if use is None else use.astype(float)).astype(np.float32)[:, None]
    share /= max(1.0, float(share.sum()))
    y = y.astype(np.float32)
    w, b = np.zeros((d, y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    vw, vb = w.copy(), b.copy()
    for k in range(rounds):
        g = (1 / (1 + np.exp(-np.clip(x @ vw + vb, -30, 30))) - y) * share
        gw, gb = x.T @ g + l2 * vw, g.sum(0)
        w2, b2 = vw - rate * gw, vb - rate * gb
        m = k / (k + 3)
        vw, vb, w, b = w2 + m * (w2 - w), b2 + m * (b2 - b), w2, b2
    return w, b

"""Words and word shingles of many texts at once, as 64-bit hashes, in numpy."""

from __future__ import annotations

import re

import numpy as np

BASE = 0x5851F42D4C957F2D
WORD = re.compile(r"[^\W_]+")

_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, size: int) -> np.ndarray:
    """1, base, base**2 and so on, modulo 2**64."""
    known = _POWERS.get(base)
    if known is None or len(known) < size:
        factors = np.full(max(size, 1 << 20), base, np.uint64)
        factors[0] = 1
        known = np.cumprod(factors)
        if size <= 1 << 21:  # those for a single huge text are not kept
            _POWERS[base] = known
    return known[:size]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of each span of bytes, wherever in the buffer it stands."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=sums[1:])
    return (sums[ends] - sums[starts]) * powers(pow(BASE, -1, 1 << 64), len(data) + 1)[starts]


def mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x + np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    return x * np.uint64(0x94D049BB133111EB)


def _plain(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with capitals in lower case, so that all bytes from 128 on are letters."""
    odd = (data >= 0x80) & ((data > 0xC3) | (data == 0xC2))
    if len(data) > 1:
        sign = (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
        odd[1:] |= sign
    if odd.any():
        rows = set((np.searchsorted(offsets, np.flatnonzero(odd), side="right") - 1).tolist())
        raw = data.tobytes()
        texts = []
        for k, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
            text = raw[a:b]
            if k in rows:
                text = " ".join(WORD.findall(text.decode("utf-8", "replace").lower())).encode()
            texts.append(text)
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    out = data.copy()
    out[(data >= 0x41) & (data <= 0x5A)] += 0x20
    if len(out) > 1:
        second = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
        out[1:][second] += 0x20
    return out, offsets


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds of each text) of the words: runs of letters and digits, lower case."""
    data, offsets = _plain(data, offsets)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ((data >= 0x61) & (data <= 0x7A)) | ((data >= 0x30) & (data <= 0x39)) | (data >= 0x80)
    edge = np.zeros(len(data) + 1, bool)
    edge[0], edge[-1] = inside[0], inside[-1]
    edge[1:-1] = inside[1:] != inside[:-1]
    between = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    both = between[inside[between] & inside[between - 1]]  # two texts that touch
    at = np.sort(np.concatenate([np.flatnonzero(edge), np.repeat(np.unique(both), 2)]))
    starts, ends = at[::2], at[1::2]
    return mix(span_hashes(data, starts, ends), 1), np.searchsorted(starts, offsets)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds of each text) of the distinct runs of ``size`` words, sorted within a
    text. A text of fewer words has one shingle, all of them; one without words has none."""
    words, bounds = word_hashes(data, offsets)
    counts = np.diff(bounds)
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    of = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(n) - n
    at = bounds[:-1][of] + np.arange(len(of)) - first[of]
    long = counts[of] >= size
    padded = np.append(words, np.zeros(size, np.uint64))
    value = np.zeros(len(of), np.uint64)
    for k in range(size):
        part = padded[at + k]
        part = np.where(long | (k < counts[of]), part, np.uint64(0))
        value = value * np.uint64(0x9E3779B97F4A7C15) + part
    value = mix(value, 2)
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    value, of = value[new], of[new]
    return value, np.searchsorted(of, np.arange(len(n) + 1))

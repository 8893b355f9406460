"""Sets of word shingles as 64-bit hashes, many texts at a time with numpy."""

from __future__ import annotations

import numpy as np

ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_rng = np.random.default_rng(20240229)
#: A random 64-bit value for every byte; upper-case A-Z share those of a-z.
BYTES = _rng.integers(1, 2**63, 256, dtype=np.uint64)
BYTES[65:91] = BYTES[97:123]
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


_powers = np.array([1], np.uint64)


def _power(n: int) -> np.ndarray:
    """ODD ** 0 .. ODD ** (n - 1), modulo 2 ** 64."""
    global _powers
    if len(_powers) < n:
        size = 1 << int(n).bit_length()
        out = np.full(size, ODD, np.uint64)
        out[0] = 1
        _powers = np.multiply.accumulate(out)
    return _powers[:n]


#: Bytes hashed at once; the arrays of one step take some 40 times as much.
STEP = 1 << 20


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word (run of non-blank bytes, A-Z lower-cased)."""
    hashes, starts, at = [np.array([], np.uint64)], [np.array([], np.int64)], 0
    while at < len(data):
        end = at + STEP
        if end < len(data):  # cut at the next blank
            size = STEP
            while end < len(data) and not BLANK[data[end]]:
                blank = np.flatnonzero(BLANK[data[end : end + size]])
                end = end + int(blank[0]) if len(blank) else min(end + size, len(data))
        h, s = _hashes_of(data[at:end])
        hashes.append(h)
        starts.append(s + at)
        at = end
    return np.concatenate(hashes), np.concatenate(starts)


def _hashes_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    solid = ~BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], solid, [False])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.array([], np.uint64), starts
    # Horner's rule would be sequential: take byte * ODD ** (place within the word) and sum by word.
    place = np.arange(len(data)) - np.repeat(np.concatenate(([0], starts)), np.diff(np.concatenate(([0], starts, [len(data)]))))
    longest = int((ends - starts).max())
    value = BYTES[data] * _power(longest + 1)[np.minimum(place, longest)]
    value[~solid] = 0
    return mixed(np.add.reduceat(value, starts) + (ends - starts).astype(np.uint64)), starts


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles; fewer words than `size` make one shingle, none none."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    joined = np.frombuffer(b"\n".join(raw), np.uint8)
    words, starts = word_hashes(joined)
    bounds = np.cumsum([0] + [len(r) + 1 for r in raw])
    first = np.searchsorted(starts, bounds)
    out = []
    if len(words) >= size:
        grams = words[: len(words) - size + 1].copy()
        for k in range(1, size):
            grams = mixed(grams * ODD + words[k : len(words) - size + 1 + k])
    for i in range(len(raw)):
        a, b = first[i], first[i + 1]
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            h = words[a : a + 1]
            for k in range(a + 1, b):
                h = mixed(h * ODD + words[k : k + 1])
            out.append(h + np.uint64(b - a))
        else:
            out.append(np.array([], np.uint64))
    return out

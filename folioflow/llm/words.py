"""64-bit hashes of the white-space separated words of texts, computed on whole byte arrays."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
BLOCK = 1 << 18  # bytes; every worker keeps two tables of as many numbers

_draw = np.random.default_rng(20)
_BYTE = _draw.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int) -> np.ndarray:
    out = np.full(BLOCK + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS, _BACK = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers stirred (a bijection)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _block(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    space = _SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _POWERS[: len(raw)], out=sums[1:])
    return (sums[ends] - sums[starts]) * _BACK[starts], starts, ends


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of lower-cased bytes, in blocks cut between words.

    A word longer than a block counts by the hashes of its parts.
    """
    data = np.frombuffer(raw, np.uint8)
    hashes, starts, at = [], [], 0
    carry = None
    while at < len(data):
        stop = min(at + BLOCK, len(data))
        if stop < len(data):
            tail = np.flatnonzero(_SPACE[data[at:stop]])
            if len(tail):
                stop = at + int(tail[-1]) + 1
        h, s, e = _block(data[at:stop])
        h = mixed(h + (e - s).astype(np.uint64))
        if carry is not None and len(s) and s[0] == 0:
            h[:1] = mixed(h[:1] + carry * np.uint64(3))
            hashes[-1], starts_here = hashes[-1][:-1], s + at
            starts_here[0] = starts[-1][-1]
            starts[-1] = starts[-1][:-1]
            starts.append(starts_here)
        else:
            starts.append(s + at)
        hashes.append(h)
        carry = h[-1:] if len(e) and at + int(e[-1]) == stop and stop < len(data) else None
        at = stop
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def batch_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row (A-Z as a-z), and the number of words before each text (one more entry)."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])
    hashes, starts = word_hashes(b"\n".join(raw).lower())
    return hashes, np.concatenate([[0], np.searchsorted(starts, ends, "left")])


_PLACES = _draw.integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)


def shingles(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words of one text; a shorter text that has words is one run."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64)
    width = min(n, size)
    total = np.full(n - width + 1, np.uint64(width))
    for j in range(width):
        total += hashes[j : n - width + 1 + j] * _PLACES[j]
    return np.unique(mixed(total))

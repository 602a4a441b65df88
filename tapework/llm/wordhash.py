"""Hashes of words and of runs of words, for whole batches of texts at once, in numpy.

Words are what stands between ASCII white space. A word's hash is a polynomial over its bytes modulo 2**64 with a
random value for each byte, mixed at the end; a run's hash is a polynomial over its words. Equal runs have
equal hashes in every batch and process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_R = np.random.Generator(np.random.PCG64(20_240_229))
BYTE = _R.integers(0, 2**64, 256, dtype=np.uint64)
LOWERED = BYTE.copy()
LOWERED[65:91] = BYTE[97:123]
#: Another table, for word hashes that have nothing to do with the first ones.
OTHER = _R.integers(0, 2**64, 256, dtype=np.uint64)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Odd multipliers: of bytes, and of words in two independent ways.
BASE, FIRST, SECOND = 0x9E3779B97F4A7C15 & ~2 | 1 | 4, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
#: Bytes of text that are hashed together at most; one longer text is hashed alone.
BATCH_BYTES = 1_000_000


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _spans(values: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[start:end] for each pair, independent of where it stands."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    return (sums[end] - sums[start]) * powers(inverse(base), len(values) + 1)[start]


class Words:
    """The words of several texts: hash (one each), doc (index of the text), n (words of each text), first (place of each text's first word)."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        gap = SPACE[data]
        self.start = np.flatnonzero(~gap & np.r_[True, gap[:-1]])
        self.end = np.flatnonzero(gap & np.r_[False, ~gap[:-1]])
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.data = data
        self.hash = self._hashed(LOWERED if lower else BYTE, BASE)
        self.doc = np.searchsorted(ends, self.start, "right")
        self.n = np.bincount(self.doc, minlength=len(texts))
        self.first = np.r_[0, np.cumsum(self.n)[:-1]] if len(texts) else np.zeros(0, np.int64)

    def _hashed(self, table: np.ndarray, base: int) -> np.ndarray:
        return mix(_spans(table[self.data], base, self.start, self.end) + (self.end - self.start).astype(np.uint64))

    def runs(self, k: int, base: int = FIRST, other: bool = False) -> np.ndarray:
        """Hash of the k words from each place on; places with fewer words behind them in the batch are left out. With other, of independent word hashes."""
        n = max(len(self.hash) - k + 1, 0)
        start = np.arange(n)
        return mix(_spans(self._hashed(OTHER, SECOND) if other else self.hash, base, start, start + k)) if n else np.zeros(0, np.uint64)

    def whole(self, k: int) -> np.ndarray:
        """Whether the k words from each place on, as in runs, are of one text."""
        n = max(len(self.hash) - k + 1, 0)
        return self.doc[:n] == self.doc[k - 1 :]


def batches(texts: list[str | None], most: int = BATCH_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, encoded texts) of groups of neighbouring texts; null is empty."""
    group, size, first = [], 0, 0
    for i, t in enumerate(texts):
        b = (t or "").encode("utf-8", "surrogatepass")
        if group and size + len(b) > most:
            yield first, group
            group, size, first = [], 0, i
        group.append(b)
        size += len(b)
    if group:
        yield first, group

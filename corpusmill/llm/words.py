"""Word hashes and word n-gram hashes of many texts at once, in numpy.

A word is a run of bytes other than BLANKS. Hashes are sums of random numbers, one for each byte value, times powers of an odd number, modulo
2**64, then mixed; differences of running sums give the hash of any stretch. They are the same in every process."""

from __future__ import annotations

import numpy as np

from .common import BLANKS

_BYTES = np.random.default_rng(20250301).integers(0, 2**64, 256, dtype=np.uint64)
_BYTE_STEP, _WORD_STEP = 0xD6E8FEB86659FD95, 0xA0761D6478BD642D
_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS)] = True
_powers: dict[int, np.ndarray] = {}


def _power(step: int, n: int) -> np.ndarray:
    """step ** 0, 1, ... modulo 2**64, at least n of them."""
    if step not in _powers or len(_powers[step]) < n:
        all_ = np.full(max(n, 1 << 16), step, np.uint64)
        all_[0] = 1
        _powers[step] = np.cumprod(all_)
    return _powers[step]


def _inverse(step: int) -> int:
    return pow(step, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class Words:
    """The words of some texts in order: ``hashes``, ``doc`` (number of the text), and where each lies in ``buffer``."""

    def __init__(self, texts: list[bytes], lut: np.ndarray | None = None):
        """``lut``: maps bytes before hashing, 32 for those that separate words beside the blanks."""
        self.buffer = b"\n".join(texts)
        data = np.frombuffer(self.buffer, np.uint8)
        if lut is not None:
            data = lut[data]
        n = len(data)
        inside = np.zeros(n + 2, bool)
        np.logical_not(_BLANK[data], out=inside[1 : n + 1])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[data] * _power(_BYTE_STEP, n)[:n], out=sums[1:])
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * _power(_inverse(_BYTE_STEP), n + 1)[self.starts] + (self.ends - self.starts).astype(np.uint64))
        lengths = np.array([len(t) + 1 for t in texts], np.int64)
        begins = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(lengths, out=begins[1:])
        self.first = np.searchsorted(self.starts, begins)  # of each text, and one more
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        m = len(self.hashes)
        self.sums = np.zeros(m + 1, np.uint64)
        np.cumsum(self.hashes * _power(_WORD_STEP, m)[:m], out=self.sums[1:])

    def __len__(self) -> int:
        return len(self.hashes)

    def stretch(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the words from start to before end."""
        return mix((self.sums[end] - self.sums[start]) * _power(_inverse(_WORD_STEP), len(self) + 1)[start] + (end - start).astype(np.uint64))

    def grams(self, n: int) -> np.ndarray:
        """Hashes of n words from each position on, also where they cross from one text to the next."""
        count = max(0, len(self) - n + 1)
        inverse = _power(_inverse(_WORD_STEP), len(self) + 1)[:count]
        return mix((self.sums[n:] - self.sums[: len(self.sums) - n])[:count] * inverse + np.uint64(n)) if count else np.empty(0, np.uint64)

    def words(self, start: int, end: int) -> list[bytes]:
        return self.buffer[self.starts[start] : self.ends[end - 1]].split() if end > start else []


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    reach = 1
    while reach * 2 <= width:
        a = np.minimum(a[:-reach], a[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(a[:-rest], a[rest:]) if rest else a

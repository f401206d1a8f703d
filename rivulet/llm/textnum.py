"""Words of whole Arrow text columns as NumPy arrays: where they lie, their hashes, hashes of runs of them.

Hashes are polynomials over random values of the bytes (or of the words), taken from running sums modulo 2**64, so a
column costs a few array passes however its words are cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Texts are taken together up to about this many bytes; a longer one stands alone.
SLICE = 1 << 18
#: Powers are kept for runs of so many items; longer ones are made anew each time.
KEPT = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit words (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Poly:
    """One family member: ``base`` odd, values random by byte."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(0, 2**64, 256, dtype=np.uint64)
        self.base = np.uint64(int(rng.integers(0, 2**63)) * 8 + 3 & 0xFFFFFFFFFFFFFFFF)
        self.inverse = np.uint64(pow(int(self.base), -1, 2**64))
        self.up = self.down = np.ones(1, np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) >= n:
            return self.up, self.down
        m = max(n, 1 << 16)
        both = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(m - 1, x, np.uint64))]) for x in (self.base, self.inverse)]
        if m <= KEPT:
            self.up, self.down = both
        return both[0], both[1]

    def spans(self, items: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of ``items[starts:ends]`` (uint64 items)."""
        up, down = self.powers(len(items) + 1)
        s = np.zeros(len(items) + 1, np.uint64)
        np.cumsum(items * up[: len(items)], out=s[1:])
        return mix((s[ends] - s[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Words:
    """Words of a run of texts: ``starts``, ``ends`` in ``buf``; ``first[i]`` is the first word of text i."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        self.buf, self.offsets = buf, offsets
        n = len(buf)
        solid = ~_SPACE[buf]
        begin = solid.copy()
        begin[1:] &= ~solid[:-1]
        finish = solid.copy()
        finish[:-1] &= ~solid[1:]
        cut = offsets[(offsets > 0) & (offsets < n)]
        begin[cut] = solid[cut]
        finish[cut - 1] = solid[cut - 1]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(finish) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, poly: Poly) -> np.ndarray:
        return poly.spans(poly.values[self.buf], self.starts, self.ends)

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all runs of ``size`` words inside one text, and the text of each."""
        count = np.maximum(np.diff(self.first) - size + 1, 0)
        text = np.repeat(np.arange(len(count)), count)
        at = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count) + self.first[:-1][text]
        return at, text


def slices(column: pa.Array, limit: int = SLICE):
    """(first row, Words) for runs of a text column's rows; null counts as empty."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    null = column.is_null().to_numpy(zero_copy_only=False)
    if null.any():
        column = column.fill_null("")
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        buf = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, Words(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j

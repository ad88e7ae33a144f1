"""Words of many texts at once: splitting, hashing and rolling windows on byte arrays.

A word is a run of bytes other than blank and \\t..\\r of the UTF-8 text. Words are
hashed with a polynomial over random byte values, so every run of bytes or words
is a difference of two prefix sums; temporary arrays stay small however long a
text is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 2 << 20
_STEP = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_VALUES = np.random.default_rng(20_240_611).integers(0, 2**64, 256, np.uint64)
_ODD = 0x9E3779B97F4A7C15
_ODD_INVERSE = pow(_ODD, -1, 2**64)


@lru_cache(maxsize=1)
def _grown() -> dict[str, np.ndarray]:
    return {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse modulo 2**64."""
    held = _grown()
    if len(held["up"]) < n:
        size = 1 << int(n - 1).bit_length()
        for name, base in (("up", _ODD), ("down", _ODD_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            held[name] = np.multiply.accumulate(steps)
    return held["up"][:n], held["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that any of their bits can choose a bucket."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def mixed(seed: int) -> int:
    return int(mix(np.array([seed], np.uint64))[0])


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... counts[0] of them, then the same for the next."""
    total = int(counts.sum())
    shift = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return shift + np.arange(total)


class Words:
    """The words of a run of texts: byte places, and the first word of each text."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts, "")
        kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        _, places, values = texts.buffers()
        offsets = np.frombuffer(places, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        self.data = np.frombuffer(values, np.uint8)[offsets[0] : offsets[-1]] if values else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        gap = SPACE[self.data]
        edge = np.zeros(len(gap) + 1, bool)
        edge[self.offsets] = True
        before, after = edge[:-1].copy(), edge[1:].copy()
        before[1:] |= gap[:-1]
        after[:-1] |= gap[1:]
        self.begin = np.flatnonzero(before & ~gap)
        self.end = np.flatnonzero(after & ~gap) + 1
        self.bounds = np.searchsorted(self.begin, self.offsets)

    def __len__(self) -> int:
        return len(self.begin)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self, lower: bool = False) -> np.ndarray:
        values = _VALUES[_LOWER] if lower else _VALUES
        out, at = np.empty(len(self), np.uint64), 0
        while at < len(out):
            to = max(at + 1, int(np.searchsorted(self.begin, self.begin[at] + _STEP)))
            low, high = self.begin[at], self.end[to - 1]
            up, down = _powers(high - low + 1)
            total = np.zeros(high - low + 1, np.uint64)
            np.cumsum(values[self.data[low:high]] * up[:-1], out=total[1:])
            first = self.begin[at:to] - low
            out[at:to] = (total[self.end[at:to] - low] - total[first]) * down[first]
            at = to
        return mix(out)

    def text(self, word: int) -> bytes:
        return self.data[self.begin[word] : self.end[word]].tobytes()

    def joined(self, chosen: np.ndarray) -> bytes:
        """The chosen words joined by one blank."""
        if not len(chosen):
            return b""
        sizes = self.end[chosen] - self.begin[chosen] + 1
        out = np.full(int(sizes.sum()), 0x20, np.uint8)
        to = np.cumsum(sizes) - sizes
        out[ragged(to, sizes - 1)] = self.data[ragged(self.begin[chosen], sizes - 1)]
        return out[:-1].tobytes()


def windows(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of all runs of k words that lie inside one text."""
    counts = np.maximum(np.diff(bounds) - k + 1, 0)
    first = ragged(bounds[:-1], counts)
    if not len(first):
        return first, np.zeros(0, np.uint64)
    up, down = _powers(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:-1], out=total[1:])
    return first, mix((total[first + k] - total[first]) * down[first])


def slices(batch: pa.RecordBatch | pa.Table, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have about `most` bytes together."""
    for part in batch.to_batches() if isinstance(batch, pa.Table) else [batch]:
        sizes = pc.fill_null(pc.binary_length(part[column]), 0).to_numpy(zero_copy_only=False)
        place, at = np.cumsum(sizes), 0
        while at < len(part):
            to = max(at + 1, int(np.searchsorted(place, (place[at - 1] if at else 0) + most, "right")))
            yield part.slice(at, to - at)
            at = to

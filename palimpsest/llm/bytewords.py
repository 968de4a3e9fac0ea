"""Words of many texts at once, as arrays over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

#: Letters A to Z become a to z, all else stays.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
#: Bytes of words: digits, a to z, and all beyond ASCII; or whatever is not white space.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
SOLID = np.ones(256, bool)
SOLID[[0x20, *range(0x09, 0x0E)]] = False

FIRST, SECOND = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


@dataclass
class Words:
    """``data`` is ``raw`` in lower case.  Word ``k`` is ``data[starts[k]:ends[k]]``; text ``i`` has the words ``bounds[i]`` to ``bounds[i + 1]``."""

    raw: np.ndarray
    data: np.ndarray
    edges: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def keys(self, base: int = FIRST) -> np.ndarray:
        """A 64-bit polynomial hash of every word."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        lengths = self.ends - self.starts
        inside = np.repeat(self.starts - np.r_[0, np.cumsum(lengths)[:-1]], lengths)
        inside += np.arange(len(inside))
        value = _VALUES[self.data[inside]]
        first = np.cumsum(lengths) - lengths
        place = np.arange(len(inside)) - np.repeat(first, lengths)
        powers = np.full(int(lengths.max()), base, np.uint64)
        powers[0] = 1
        value *= np.multiply.accumulate(powers)[place]
        return mixed(np.add.reduceat(value, first) + lengths.astype(np.uint64))


_VALUES = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ (
    np.arange(1, 257, dtype=np.uint64) << np.uint64(33)
)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    return x * np.uint64(0xC4CEB9FE1A85EC53)


def shingles(keys: np.ndarray, size: int, base: int = SECOND) -> np.ndarray:
    """A hash of every ``size`` consecutive keys; ``len(keys) - size + 1`` of them, or none."""
    n = len(keys) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * np.uint64(base) + keys[k : k + n]
    return mixed(total)


def words_of(texts: pa.Array, inside: np.ndarray) -> Words:
    """The words of a string array (null: none), lower-cased from A to Z."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    whole = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.zeros(0, np.uint8)
    data = FOLD[whole]
    edges = offsets - offsets[0]
    n = len(data)
    solid = inside[data]
    start = solid.copy()
    start[1:] &= ~solid[:-1]
    end = solid.copy()
    end[:-1] &= ~solid[1:]
    cut = edges[(edges > 0) & (edges < n)]
    start[cut] = solid[cut]
    end[cut - 1] = solid[cut - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return Words(whole, data, edges, starts, ends, np.searchsorted(starts, edges))


def slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``size`` bytes in ``column`` each, one row at least."""
    texts = batch.column(batch.schema.get_field_index(column))
    lengths = np.nan_to_num(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
    group = (np.cumsum(lengths) - lengths) // size
    cuts = np.r_[0, np.flatnonzero(np.diff(group)) + 1, batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)

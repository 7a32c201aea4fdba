"""Words, lines and n-grams of a batch of texts as numpy arrays.

Spark hands a task its rows in Arrow batches. The functions here work on the bytes of many texts at
once, in slices of a few megabytes, so a task needs memory for one slice and not for its whole input;
a single text longer than a slice is one slice, whose hashes are made in blocks. A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
#: Bytes that are hashed at once.
BLOCK_BYTES = 1 << 20
U64 = np.uint64
#: Two odd bases of the rolling hashes, and the multiplier that chains words to n-grams.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
CHAIN = U64(0xD6E8FEB86659FD93)

#: ASCII white space that separates words: \x20 and \x09-\x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


@lru_cache(maxsize=4)
def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    def run(factor: int) -> np.ndarray:
        out = np.full(size, factor, U64)
        out[0] = 1
        return np.cumprod(out)

    return run(base), run(pow(base, -1, 1 << 64))


class TextSlice:
    """Bytes of consecutive texts with the places of their words and lines."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, low: int):
        self.data, self.offsets, self.low = data, offsets, low
        self.n = len(offsets) - 1
        solid = ~SPACE[data]
        before = np.empty(len(data), bool)
        before[:1] = False
        before[1:] = solid[:-1]
        inner = offsets[:-1][offsets[:-1] < len(data)]
        before[inner] = False
        after = np.empty(len(data), bool)
        after[-1:] = False
        after[:-1] = solid[1:]
        last = offsets[1:][offsets[1:] > 0] - 1
        after[last] = False
        self.solid = solid
        self.starts = np.flatnonzero(solid & ~before)
        self.ends = np.flatnonzero(solid & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.doc = np.repeat(np.arange(self.n), np.diff(self.first))

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def total(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of each text the mask marks."""
        out, filled = np.zeros(self.n, np.int64), np.diff(self.offsets) > 0
        if filled.any():
            out[filled] = np.add.reduceat(mask, self.offsets[:-1][filled], dtype=np.int64)
        return out

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray, base: int = 0) -> np.ndarray:
        """64-bit hashes of byte spans in order that do not overlap, equal for equal bytes wherever they stand.

        A span's hash is the sum of its bytes times powers of the base by their place in it. The bytes are
        summed a block at a time, so a long text needs memory for the powers and sums of one block only; of the
        spans of a block only the first can have begun before it.
        """
        size = BLOCK_BYTES
        up, down = powers(BASES[base], size + 1)
        out = np.zeros(len(starts), U64)
        for low in range(0, len(self.data), size):
            data = self.data[low : low + size]
            sums = np.zeros(len(data) + 1, U64)
            np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=sums[1:])
            i, k = np.searchsorted(ends, low, side="right"), np.searchsorted(starts, low + len(data))
            if i >= k:
                continue
            begin, end = np.maximum(starts[i:k] - low, 0), np.minimum(ends[i:k] - low, len(data))
            found = (sums[end] - sums[begin]) * down[begin]
            if starts[i] < low:
                found[:1] *= U64(pow(BASES[base], low - int(starts[i]), 1 << 64))
            out[i:k] += found
        return mix(out + (ends - starts).astype(U64))

    def word_hashes(self, base: int = 0) -> np.ndarray:
        return self.span_hashes(self.starts, self.ends, base)

    def fits(self, n: int) -> np.ndarray:
        """For each place of an n-gram: whether it ends inside its text."""
        places = max(0, len(self.starts) - n + 1)
        return np.arange(n, places + n) <= self.first[1:][self.doc[:places]]

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and texts of the lines that \\n splits each text into."""
        breaks = np.flatnonzero(self.data == 10)
        doc_of = np.searchsorted(self.offsets, breaks, side="right") - 1
        starts = np.concatenate([self.offsets[:-1], breaks + 1])
        docs = np.concatenate([np.arange(self.n), doc_of])
        order = np.lexsort((starts, docs))
        starts, docs = starts[order], docs[order]
        ends = np.append(starts[1:] - 1, 0)
        is_last = np.append(docs[1:] != docs[:-1], True)
        ends[is_last] = self.offsets[1:][docs[is_last]]
        return starts, ends, docs


def chain(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive entries, at each place where n of them begin."""
    places = max(0, len(hashes) - n + 1)
    out = np.zeros(places, U64)
    for k in range(n):
        out = out * CHAIN + hashes[k : k + places]
    return mix(out + U64(n))


def slices(texts: pa.Array, limit: int | None = None) -> Iterator[TextSlice]:
    """The texts in slices of at most the given bytes, or one text each."""
    limit = limit or SLICE_BYTES
    texts = (texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts).cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1)
        begin, end = int(offsets[low]), int(offsets[high])
        yield TextSlice(data[begin:end], offsets[low : high + 1] - begin, low)
        low = high


def repeats_in_text(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per entry: whether its key occurs twice or more in its text, and whether it did so before."""
    order = np.lexsort((np.arange(len(keys)), keys, docs))
    k, d = keys[order], docs[order]
    same = (k[1:] == k[:-1]) & (d[1:] == d[:-1])
    often, again = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    often[order[1:]] |= same
    again[order[1:]] = same
    often[order[:-1]] |= same
    return often, again


def covered(starts: np.ndarray, length: int, size: int) -> np.ndarray:
    """Marks the entries of 0..size-1 that a window of the length from one of the starts covers."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + length, size), -1)
    return np.cumsum(steps[:-1]) > 0

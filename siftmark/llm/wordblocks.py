"""Words of a batch of texts as numpy arrays, with the memory of one block whatever the length of a text.

Short texts are read together in blocks of at most BLOCK_BYTES. A longer text is cut between two words
into pieces of at most that size, and a single word of BLOCK_BYTES or more is replaced by its digest, so
that neither a long text nor a long word needs more memory. A null text is an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from siftmark.llm.textbatch import BASES, U64, mix, powers

BLOCK_BYTES = 1 << 20


def byte_table(outside: str) -> np.ndarray:
    """Which bytes belong to words, given the ASCII characters that do not."""
    table = np.ones(256, bool)
    table[[ord(c) for c in outside]] = False
    return table


#: Words as `[^\\x20\\x09-\\x0D]+`.
SPACED = byte_table(" \t\n\v\f\r")
#: Words as runs of ASCII letters and digits and of everything beyond ASCII.
ALNUM = byte_table("".join(chr(c) for c in range(128) if not chr(c).isalnum()))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


class WordBlock:
    """Lower-cased (A-Z) bytes with the places of the words; `doc` is the row of each word in the batch, `low` the first row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, low: int, table: np.ndarray):
        self.data, self.low = LOWER[data], low
        solid = table[data]
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:] = solid[:-1]
        after[:-1] = solid[1:]
        before[offsets[:-1][offsets[:-1] < len(data)]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
        self.starts = np.flatnonzero(solid & ~before)
        self.ends = np.flatnonzero(solid & ~after) + 1
        first = np.searchsorted(self.starts, offsets)
        self.doc = np.repeat(np.arange(low, low + len(offsets) - 1), np.diff(first))

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the words."""
        up, down = powers(BASES[0], max(BLOCK_BYTES, 64) + 1)
        sums = np.zeros(len(self.data) + 1, U64)
        np.cumsum((self.data.astype(U64) + U64(1)) * up[: len(self.data)], out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(U64))

    def words(self, which: np.ndarray) -> pa.Array:
        """The words at the given places."""
        bounds = np.zeros(2 * len(self.starts) + 1, np.int64)
        bounds[1::2], bounds[2::2] = self.starts, self.ends
        spans = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(self.data)])
        return spans.take(pa.array(2 * which + 1)).cast(pa.large_string())

    def endings(self) -> np.ndarray:
        """The last two bytes of each word as a number; a word of one byte has a zero before it."""
        last = self.data[self.ends - 1].astype(np.int64)
        before = np.where(self.ends - self.starts > 1, self.data[np.maximum(self.ends - 2, 0)], 0)
        return before.astype(np.int64) * 256 + last


def _pieces(data: np.ndarray, table: np.ndarray) -> Iterator[np.ndarray]:
    at = 0
    while at < len(data):
        window = data[at : at + BLOCK_BYTES]
        if len(window) < BLOCK_BYTES:
            yield window
            return
        gaps = np.flatnonzero(~table[window])
        if len(gaps):
            yield window[: gaps[-1] + 1]
            at += int(gaps[-1]) + 1
            continue
        digest, end = hashlib.sha256(), at
        while end < len(data):
            part = data[end : end + BLOCK_BYTES]
            gaps = np.flatnonzero(~table[part])
            part = part[: gaps[0]] if len(gaps) else part
            digest.update(LOWER[part].tobytes())
            end += len(part)
            if len(gaps):
                break
        yield np.frombuffer(digest.hexdigest().encode(), np.uint8)
        at = end


def word_blocks(texts: pa.Array, table: np.ndarray) -> Iterator[WordBlock]:
    """Blocks in the order of the texts; pieces of one text follow one another."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + BLOCK_BYTES, side="left")) - 1)
        begin, end = int(offsets[low]), int(offsets[high])
        if end - begin < BLOCK_BYTES:
            yield WordBlock(data[begin:end], offsets[low : high + 1] - begin, low, table)
        else:
            for piece in _pieces(data[begin:end], table):
                yield WordBlock(piece, np.array([0, len(piece)]), low, table)
        low = high

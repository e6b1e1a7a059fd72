"""Whole Arrow columns of text as numpy byte arrays, with hashes of all their windows.

A block holds the bytes of several texts end to end; nothing here loops over bytes in Python.
Blocks are cut by size, so memory is bounded by the block size or by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1


@dataclass
class Block:
    """Rows ``first`` to ``last`` (exclusive) of a batch: their bytes and where each starts."""

    first: int
    last: int
    data: np.ndarray
    starts: np.ndarray  # one more than rows


def blocks(batch: pa.RecordBatch, column: str, most: int = BLOCK_BYTES) -> Iterator[Block]:
    texts = batch.column(column)
    if texts.null_count:
        raise ValueError("texts must not be null here")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield Block(first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class WindowHashes:
    """Polynomial hashes of any windows of a byte array; equal bytes have equal hashes."""

    def __init__(self, data: np.ndarray):
        size = max(BLOCK_BYTES, 1 << int(len(data)).bit_length())
        self._up, down = _powers(size)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        # values are spread by a mix, as plain bytes differ in few low bits
        spread = mix(np.arange(1, 257, dtype=np.uint64))
        np.cumsum(spread[data] * down[: len(data)], out=self._sums[1:])

    def at(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        raw = (self._sums[starts + lengths] - self._sums[starts]) * self._up[starts]
        return mix(raw ^ (lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))

    def every(self, length: int) -> np.ndarray:
        """Of all windows of one length, by start."""
        n = len(self._sums) - length
        return mix((self._sums[length:] - self._sums[:n]) * self._up[:n]) if n > 0 else np.zeros(0, np.uint64)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of a block, A-Z lowered: a hash of each, the row of each, and the lowered bytes' starts."""
    if not len(block.data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    gap = _SPACE[block.data]
    before = np.empty(len(gap), bool)
    before[0] = True
    before[1:] = gap[:-1]
    edges = block.starts[:-1][block.starts[:-1] < len(gap)]
    before[edges] = True
    starts = np.flatnonzero(before & ~gap)
    after = np.empty(len(gap), bool)
    after[-1] = True
    after[:-1] = before[1:]
    after[:-1] |= gap[1:]
    ends = np.flatnonzero(after & ~gap) + 1
    hashes = WindowHashes(_LOWER[block.data]).at(starts, ends - starts)
    rows = np.searchsorted(block.starts, starts, "right") - 1
    return hashes, rows, starts

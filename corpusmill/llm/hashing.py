"""Words, shingles and their 64-bit hashes for whole Arrow batches of texts, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
SHINGLE = 5

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# each byte's value in a hash: A-Z as a-z, white space 0, everything else from 1
_EXACT = np.arange(1, 257, dtype=np.uint64)
_EXACT[_SPACE] = 0
_VALUE = _EXACT.copy()
_VALUE[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> _U(31))) * _U(0x7FB5D329728EA185)
    h = (h ^ (h >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return h ^ (h >> _U(33))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as many as were needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = _U(pow(int(_BASE), -1, 1 << 64))
            self.up = np.multiply.accumulate(np.concatenate([[_U(1)], np.full(n, _BASE, _U)]))
            self.down = np.multiply.accumulate(np.concatenate([[_U(1)], np.full(n, inverse, _U)]))
        return self.up, self.down


POWERS = _Powers()


class Chunk(NamedTuple):
    """Texts `first` .. `last`-1 of an array: their bytes, and where each begins."""

    first: int
    last: int
    data: np.ndarray
    starts: np.ndarray


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The bytes of all texts, null as empty, in pieces of about `limit` bytes, one text at least."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts):
        return
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        own = offsets[first : last + 1]
        yield Chunk(first, last, data[own[0] : own[-1]], own - own[0])
        first = last


class Words(NamedTuple):
    """Words of a chunk: byte ranges, hashes, and the first word of each text (and the end)."""

    begin: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    first: np.ndarray


def words(chunk: Chunk, fold: bool = True) -> Words:
    """The words `[^\\x20\\x09-\\x0D]+` of each text, hashed with A-Z as a-z if `fold`."""
    data, starts = chunk.data, chunk.starts
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, _U), np.zeros(len(starts), np.int64))
    solid = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[starts] = True
    begin = solid.copy()
    begin[1:] &= ~solid[:-1] | edge[1:n]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | edge[1:n]
    begin, end = np.flatnonzero(begin), np.flatnonzero(end) + 1
    first = np.searchsorted(begin, starts)
    if not len(begin):
        return Words(begin, end, np.zeros(0, _U), first)
    up, down = POWERS.upto(n)
    sums = np.add.reduceat((_VALUE if fold else _EXACT)[data] * up[:n], begin)
    return Words(begin, end, mix(sums * down[begin]), first)


def shingles(hashes: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Hashes of runs of `width` words, one for each place where a run can begin."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    total = np.zeros(n, _U)
    for k in range(width):
        total += hashes[k : k + n] * _U(pow(int(_BASE), k + 1, 1 << 64))
    return mix(total + _U(width))


def shingle_set(hashes: np.ndarray) -> np.ndarray:
    """Distinct shingle hashes of a text in order; fewer words than a shingle make up one."""
    if not len(hashes):
        return hashes
    return np.unique(shingles(hashes, min(SHINGLE, len(hashes))))

"""Words of UTF-8 text as NumPy arrays, for code that runs on Arrow batches.

All helpers work on the bytes of many texts at once. Word classes are sets of
ASCII bytes, so cutting at byte level equals cutting at code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 18  # bytes hashed at a time
ODD = {0: 0x9E3779B97F4A7C15 | 3, 1: 0xD6E8FEB86659FD93 | 3, 2: 0xA0761D6478BD642F | 3}


def _class(outside: str) -> np.ndarray:
    keep = np.ones(256, bool)
    keep[list(outside.encode())] = False
    return keep


# [^\x20\x09-\x0D]+
NOT_SPACE = _class("\t\n\v\f\r ")
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
LETTERS = _class("".join(map(chr, [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words(NamedTuple):
    """Words of several texts: byte range of each, and per text the index of its first word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def pieces(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` bytes of text each, one row at least."""
    if batch.num_rows == 0:
        return
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = int(size[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(size, done + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offset of each row; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(data: np.ndarray, offsets: np.ndarray, word: np.ndarray = NOT_SPACE) -> Words:
    """Maximal runs of the bytes of a class; a word ends with its text."""
    n = len(data)
    inside = word[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    begins[inner] = inside[inner]
    ends[inner - 1] = inside[inner - 1]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(8)
def _powers(seed: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    base = ODD[seed]
    there = np.full(size + 1, base, np.uint64)
    back = np.full(size + 1, pow(base, -1, 1 << 64), np.uint64)
    there[0] = back[0] = 1
    return np.cumprod(there), np.cumprod(back)


def _capacity(n: int) -> int:
    return max(BLOCK, 1 << int(n).bit_length())


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Polynomial hash, modulo 2**64, of each range of the values; equal ranges, equal hash."""
    there, back = _powers(seed, _capacity(len(values)))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * there[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * back[starts])


def hashes(words: Words, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word; two seeds give independent hashes."""
    byte = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(ODD[(seed + 1) % 3]))
    out = np.empty(len(words.starts), np.uint64)
    at = 0
    while at < len(out):  # whole words, about BLOCK bytes
        to = max(at + 1, int(np.searchsorted(words.ends, words.starts[at] + BLOCK, "right")))
        low, high = int(words.starts[at]), int(words.ends[to - 1])
        out[at:to] = _ranges(byte[words.data[low:high]], words.starts[at:to] - low, words.ends[at:to] - low, seed)
        at = to
    return out


def windows(values: np.ndarray, first: np.ndarray, width: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Rolling hash of every window of ``width`` consecutive words of one text: (first word, hash)."""
    room = np.diff(first) - width + 1
    keep = np.zeros(len(values) + 1, np.int32)
    rows = room > 0
    np.add.at(keep, first[:-1][rows], 1)
    np.add.at(keep, (first[:-1] + room)[rows], -1)
    at = np.flatnonzero(np.cumsum(keep[:-1]))
    out = np.empty(len(at), np.uint64)
    for i in range(0, len(at), BLOCK):
        part = at[i : i + BLOCK]
        low, high = int(part[0]), int(part[-1]) + width
        out[i : i + BLOCK] = _ranges(values[low:high], part - low, part - low + width, seed)
    return at, out


def spans(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of true: starts and ends."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def covered(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """Which of ``n`` places lie in one of the ranges."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1]) > 0


def per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each row's words."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]

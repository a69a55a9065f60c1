"""FM-index over a sequence of word numbers, in NumPy.

Number 0 is a break: every break is a sentinel of its own, ordered by place, so
no match crosses one and a suffix is settled at its first break.
"""

from __future__ import annotations

import numpy as np

FIELD = 21  # bits of a place or rank; three of them make a sort key
LONGEST = (1 << FIELD) - 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places in suffix order by prefix doubling; only groups not yet settled are sorted again."""
    n = len(text)
    order = np.sort((text.astype(np.int64) << FIELD) | np.arange(n))
    place = order & ((1 << FIELD) - 1)
    symbol = order >> FIELD
    new = np.ones(n, bool)
    new[1:] = (symbol[1:] != symbol[:-1]) | (symbol[1:] == 0)
    rank = np.empty(n, np.int64)
    rank[place] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    tied = ~new
    tied[:-1] |= ~new[1:]
    active = place[tied]
    step = 1
    while len(active):
        key = np.sort((rank[active] << (2 * FIELD)) | (rank[active + step] << FIELD) | active)
        pair, group, at = key >> FIELD, key >> (2 * FIELD), key & ((1 << FIELD) - 1)
        index = np.arange(len(key))
        fresh = np.ones(len(key), bool)
        fresh[1:] = pair[1:] != pair[:-1]
        lead = np.ones(len(key), bool)
        lead[1:] = group[1:] != group[:-1]
        rank[at] = group + np.maximum.accumulate(np.where(fresh, index, 0)) - np.maximum.accumulate(np.where(lead, index, 0))
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        active = at[tied]
        step *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


class _Bits:
    """Bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view(np.uint64)
        count = np.bitwise_count(self.words)
        self.before = np.concatenate([[0], np.cumsum(count, dtype=np.int64)])
        self.ones = int(self.before[-1])

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before place i."""
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & low)


class WaveletTree:
    """Rank of any symbol over a sequence; one bit vector per level, zeros before ones."""

    def __init__(self, values: np.ndarray, symbols: int) -> None:
        self.depth = max(1, int(symbols - 1).bit_length())
        self.levels, self.zeros = [], []
        for k in range(self.depth - 1, -1, -1):
            bit = (values >> k) & 1 != 0
            self.levels.append(_Bits(bit))
            self.zeros.append(int(len(values) - bit.sum()))
            values = np.concatenate([values[~bit], values[bit]])
        self.base = self._walk(np.arange(symbols), np.zeros(symbols, np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, (level, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            one = level.rank(at)
            at = np.where((symbol >> (self.depth - 1 - k)) & 1 != 0, zeros + one, at - one)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        return self._walk(symbol, at) - self.base[symbol]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol at each place and its rank there."""
        symbol = np.zeros(len(at), np.int64)
        for level, zeros in zip(self.levels, self.zeros, strict=True):
            bit, one = level[at], level.rank(at)
            symbol = (symbol << 1) | bit
            at = np.where(bit, zeros + one, at - one)
        return symbol, at - self.base[symbol]


class FMIndex:
    """Backward search and sampled location; the text itself isn't kept."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = 8) -> None:
        if not len(text) or text[-1] != 0 or len(text) > LONGEST:
            raise ValueError(f"the text must end with a break and have at most {LONGEST} words")
        order = suffix_array(text)
        last = text[order - 1]
        last[order == 0] = 0
        self.tree = WaveletTree(last, symbols)
        self.start = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        # A walk backwards ends at a sampled place, or at one that follows a break.
        marked = (order % sample == 0) | (last == 0)
        self.marked = _Bits(marked)
        self.places = order[marked]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix interval of each phrase; phrases are right-aligned rows of equal width."""
        last = phrases[:, -1]
        low, high = self.start[last].copy(), self.start[last + 1].copy()
        alive = np.flatnonzero((low < high) & (lengths > 1))
        for back in range(2, phrases.shape[1] + 1):
            symbol = phrases[alive, -back]
            low[alive] = self.start[symbol] + self.tree.rank(symbol, low[alive])
            high[alive] = self.start[symbol] + self.tree.rank(symbol, high[alive])
            alive = alive[(low[alive] < high[alive]) & (lengths[alive] > back)]
            if not len(alive):
                break
        return low, high

    def locate(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, place) of every occurrence in the intervals."""
        count = np.maximum(high - low, 0)
        phrase = np.repeat(np.arange(len(low)), count)
        row = np.arange(len(phrase)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        place = np.zeros(len(row), np.int64)
        open_, walked = np.arange(len(row)), 0
        while len(open_):
            at = row[open_]
            found = self.marked[at]
            done = open_[found]
            place[done] = self.places[self.marked.rank(at[found])] + walked
            open_ = open_[~found]
            symbol, rank = self.tree.access(row[open_])
            row[open_] = self.start[symbol] + rank
            walked += 1
        return phrase, place

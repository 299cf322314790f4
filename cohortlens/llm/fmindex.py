"""Compressed full-text index of one shard: suffix order, Burrows-Wheeler transform, wavelet tree, matching statistics.

Works on arrays of integer symbols from 1 up; 0 separates texts.  Everything is
done for many streams at once, as array operations.
"""

from __future__ import annotations

import numpy as np


class RankBits:
    """Packed bits with counts before every 64-bit word: how many ones are before a place."""

    def __init__(self, flags: np.ndarray):
        packed = np.packbits(flags, bitorder="little")
        self.words = np.frombuffer(packed.tobytes().ljust((len(flags) // 64 + 1) * 8, b"\0"), np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int32)]).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = self.words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)


class WaveletTree:
    """Symbols of a sequence, one packed bit row for each bit of a symbol, highest first.

    Every row holds the sequence sorted (stably) by the bits above it, all zeros
    of a bit before all ones, so a node of the tree is a stretch of its row.
    """

    def __init__(self, symbols: np.ndarray, largest: int):
        self.bits = max(1, int(largest).bit_length())
        self.rows: list[RankBits] = []
        self.zeros: list[int] = []
        for b in range(self.bits - 1, -1, -1):
            ones = (symbols >> b) & 1 == 1
            self.rows.append(RankBits(ones))
            self.zeros.append(int(len(symbols) - ones.sum()))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        every = np.arange(largest + 1)
        self.node = self._descend(every, np.zeros(largest + 1, np.int64))

    def _descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for row, zeros, b in zip(self.rows, self.zeros, range(self.bits - 1, -1, -1)):
            ones = row.rank(at)
            at = np.where((symbols >> b) & 1 == 1, zeros + ones, at - ones)
        return at

    def occurrences(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        return self._descend(symbols, at) - self.node[symbols]


def _dense(values: np.ndarray) -> np.ndarray:
    """Ranks from 1 of the distinct values."""
    order = np.argsort(values)
    sorted_ = values[order]
    ranks = np.empty(len(values), np.int64)
    ranks[order] = np.concatenate([[1], 1 + np.cumsum(sorted_[1:] != sorted_[:-1])])
    return ranks


class FmIndex:
    """Index for patterns of up to ``depth`` symbols over ``text`` (texts divided by 0)."""

    def __init__(self, text: np.ndarray, depth: int):
        self.depth, self.n = depth, len(text)
        n = self.n
        padded = np.concatenate([text, np.zeros(depth, text.dtype)]).astype(np.int64)
        # Suffixes by their first `depth` symbols: doubling, then one last step of what is missing.
        ranks, reached = _dense(text.astype(np.int64)), 1
        while reached < depth:
            ahead = min(reached, depth - reached)
            following = np.concatenate([ranks[ahead:], np.zeros(ahead, np.int64)])[:n] if ahead < n else np.zeros(n, np.int64)
            ranks = _dense(ranks * (n + 2) + following)
            reached += ahead
        self.suffixes = np.argsort(ranks, kind="stable")
        # Symbols that neighbouring suffixes have in common, up to `depth`.
        common, equal = np.zeros(n, np.int16), np.ones(n, bool)
        equal[:1] = False
        above = np.concatenate([self.suffixes[:1], self.suffixes[:-1]])
        for d in range(depth):
            equal &= padded[self.suffixes + d] == padded[above + d]
            common += equal
        self._starts = [np.array([0, n])] + [np.append(np.flatnonzero(common < d), n) for d in range(1, depth + 1)]
        largest = int(text.max()) if n else 0
        transform = padded[self.suffixes - 1] * (self.suffixes > 0)
        self.tree = WaveletTree(transform, largest)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=largest + 1))])

    def blocks(self, d: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Interval of the suffixes that share ``d`` symbols with the suffix at each place."""
        starts = self._starts[d]
        block = np.searchsorted(starts, at, side="right") - 1
        return starts[block], starts[block + 1]

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: interval of each symbol followed by what the interval stands for."""
        base = self.smaller[symbols]
        return base + self.tree.occurrences(symbols, low), base + self.tree.occurrences(symbols, high)

    def first_places(self) -> np.ndarray:
        """By suffix rank: the first place in the text of the ``depth`` symbols that the suffix begins with."""
        starts = self._starts[self.depth][:-1]
        if not self.n:
            return np.empty(0, np.int64)
        least = np.minimum.reduceat(self.suffixes, starts)
        return np.repeat(least, np.diff(self._starts[self.depth]))


def matching_statistics(index: FmIndex, streams: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """For every symbol of the streams ``streams[starts[i]:ends[i]]``: how many symbols from it on match somewhere in
    the index (up to the index's depth), and one suffix rank where they do.

    Streams are read backward, all at once.  A match that is as long as the
    index is deep, or that cannot be extended, loses symbols at its end: its
    interval grows to the one of its shorter prefix.  Symbols the index does not
    have (0 or above its largest) match nothing.
    """
    length, place = np.zeros(len(streams), np.int16), np.zeros(len(streams), np.int64)
    order = np.argsort(starts - ends, kind="stable")  # longest first
    starts, ends = starts[order], ends[order]
    sizes = ends - starts
    low, high = np.zeros(len(starts), np.int64), np.full(len(starts), index.n, np.int64)
    matched = np.zeros(len(starts), np.int64)
    known = len(index.smaller) - 1
    for t in range(int(sizes[0]) if len(sizes) else 0):
        active = int(np.searchsorted(-sizes, -t, side="left"))
        at = ends[:active] - 1 - t
        symbols = streams[at]
        lo, hi, m = low[:active], high[:active], matched[:active]
        full = np.flatnonzero(m == index.depth)
        if len(full):
            m[full] -= 1
            lo[full], hi[full] = index.blocks(index.depth - 1, lo[full])
        alien = (symbols <= 0) | (symbols >= known)
        lo[alien], hi[alien], m[alien] = 0, index.n, 0
        open_ = np.flatnonzero(~alien)
        while len(open_):
            new_low, new_high = index.extend(symbols[open_], lo[open_], hi[open_])
            found = new_high > new_low
            hit = open_[found]
            lo[hit], hi[hit] = new_low[found], new_high[found]
            m[hit] += 1
            open_ = open_[~found]
            open_ = open_[m[open_] > 0]
            m[open_] -= 1
            for d in np.unique(m[open_]):
                some = open_[m[open_] == d]
                lo[some], hi[some] = index.blocks(int(d), lo[some])
        length[at], place[at] = m, lo
    return length, place

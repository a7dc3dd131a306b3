"""Compressed full-text index of symbol sequences: suffix array, wavelet matrix over its BWT, backward search.

All operations take arrays of positions or patterns at once.
"""

from __future__ import annotations

import numpy as np

U = np.uint64


class WaveletMatrix:
    """Rank queries over a sequence of non-negative symbols, one packed bit vector per bit of a symbol."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels = max(1, int(top).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        current = symbols.astype(np.int64)
        for level in range(self.levels - 1, -1, -1):
            bit = (current >> level & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            blocks = np.zeros(len(bit) // 64 + 1, np.uint64)
            blocks.view(np.uint8)[: len(packed)] = packed
            ones = np.bitwise_count(blocks).astype(np.int64)
            self.bits.append(blocks)
            self.counts.append((np.cumsum(ones) - ones).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            current = np.concatenate([current[~bit], current[bit]])

    def descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the symbols before ``at`` end, in the order the matrix sorts equal symbols."""
        at = at.astype(np.int64)
        for i, level in enumerate(range(self.levels - 1, -1, -1)):
            block = at >> 6
            below = (U(1) << (at & 63).astype(np.uint64)) - U(1)
            ones = self.counts[i][block] + np.bitwise_count(self.bits[i][block] & below)
            at = np.where(symbols >> level & 1, self.zeros[i] + ones, at - ones)
        return at


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of at least their first ``depth`` symbols, by prefix doubling.

    The last symbol must be smaller than all others and occur once.  Backward search for patterns of fewer
    than ``depth`` symbols needs no finer order.
    """
    n = len(symbols)
    order = np.argsort(symbols)
    rank = np.empty(n, np.int64)
    sorted_symbols = symbols[order]
    rank[order] = np.concatenate([[0], np.cumsum(sorted_symbols[1:] != sorted_symbols[:-1])])
    step = 1
    while step < depth and n and rank[order[-1]] < n - 1:
        second = np.zeros(n, np.int64)
        second[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key)
        key = key[order]
        rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        step *= 2
    return order


class FMIndex:
    """Index of several sequences of symbols >= 1.  Symbol 1 separates them and must not be searched."""

    SEPARATOR = 1

    def __init__(self, sequences: np.ndarray, depth: int):
        """``sequences``: their concatenation with separators; ``depth``: longest match that is told apart."""
        text = np.concatenate([sequences.astype(np.int64), [0]])
        self.depth, self.n, top = depth, len(text), int(text.max())
        order = suffix_array(text, depth + 2)
        self.suffixes = order[: self.n].astype(np.int32)
        bwt = text[order - 1]
        self.tree = WaveletMatrix(bwt, top)
        first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])[: top + 1]
        every = np.arange(top + 1)
        self.base = first - self.tree.descend(every, np.zeros(top + 1, np.int64))
        # common prefixes of neighbouring suffixes, up to depth; a separator ends a match
        self.common = np.zeros(self.n, np.int8 if depth < 127 else np.int32)
        same = np.ones(self.n - 1, bool)
        padded = np.concatenate([text, np.zeros(depth, np.int64)])
        for d in range(depth):
            symbol = padded[order + d]
            same &= (symbol[1:] == symbol[:-1]) & (symbol[1:] > self.SEPARATOR)
            if not same.any():
                break
            self.common[1:] += same
        self._groups: dict[int, np.ndarray] = {}

    def groups(self, depth: int) -> np.ndarray:
        """First suffix ranks of the groups of suffixes that agree on ``depth`` symbols, and the end."""
        if depth not in self._groups:
            self._groups[depth] = np.append(np.flatnonzero(self.common < depth) if depth else 0, self.n)
        return self._groups[depth]

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search step: intervals of symbol + match."""
        base = self.base[symbols]
        return base + self.tree.descend(symbols, low), base + self.tree.descend(symbols, high)

    def matching_statistics(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each pattern position the longest match that starts there (up to ``depth``) and the rank of
        a suffix that has it.  ``patterns``: concatenated, ``lengths`` each; symbols above the largest
        indexed one match nothing."""
        ends = np.cumsum(lengths)
        matched, rank = np.zeros(len(patterns), np.int32), np.zeros(len(patterns), np.int64)
        by_length = np.argsort(-lengths, kind="stable")
        ends, lengths = ends[by_length], lengths[by_length]
        m = len(lengths)
        low, high, size = np.zeros(m, np.int64), np.full(m, self.n, np.int64), np.zeros(m, np.int64)
        for step in range(int(lengths.max()) if m else 0):
            alive = int(np.searchsorted(-lengths, -step, "left"))  # patterns longer than step
            at = ends[:alive] - 1 - step
            symbols = patterns[at]
            todo = np.flatnonzero((symbols < len(self.base)) & (symbols > self.SEPARATOR))
            lost = np.ones(alive, bool)
            lost[todo] = False
            while len(todo):
                lo, hi = self.extend(symbols[todo], low[todo], high[todo])
                good = hi > lo
                hit = todo[good]
                low[hit], high[hit], size[hit] = lo[good], hi[good], size[hit] + 1
                todo = todo[~good]
                out = size[todo] == 0
                lost[todo[out]] = True
                todo = todo[~out]
                self._shrink(todo, low, high, size, size[todo] - 1)
            gone = np.flatnonzero(lost)
            low[gone], high[gone], size[gone] = 0, self.n, 0
            over = np.flatnonzero(size[:alive] > self.depth)
            self._shrink(over, low, high, size, np.full(len(over), self.depth))
            matched[at], rank[at] = size[:alive], low[:alive]
        return matched, rank

    def _shrink(self, which: np.ndarray, low: np.ndarray, high: np.ndarray, size: np.ndarray, to: np.ndarray) -> None:
        """Drop symbols from the matches' right ends, which widens their intervals."""
        for depth in np.unique(to):
            chosen = which[to == depth]
            starts = self.groups(int(depth))
            group = np.searchsorted(starts, low[chosen], "right") - 1
            low[chosen], high[chosen], size[chosen] = starts[group], starts[group + 1], depth

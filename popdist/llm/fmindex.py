"""FM-index over word sequences: suffix array, wavelet matrix, backward search.

Sequences of words (64-bit numbers) are laid end to end, each ended by a
separator of its own.  The Burrows-Wheeler transform is kept in a wavelet
matrix of packed bits with block counts.
"""

from __future__ import annotations

import numpy as np


class RankBits:
    """Packed bits; ``ones(i)``: set bits before i."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, dtype=np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])[:-1].astype(np.int32)

    def ones(self, i: np.ndarray) -> np.ndarray:
        block = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & low)


class WaveletMatrix:
    """Rank over symbols 0 .. alphabet - 1."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels: list[tuple[int, RankBits, int]] = []
        for level in reversed(range(max(1, int(alphabet - 1).bit_length()))):
            bits = (symbols >> level & 1).astype(np.uint8)
            self.levels.append((level, RankBits(bits), int(len(bits) - bits.sum())))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])
        every = np.arange(alphabet)
        self.first = self._walk(every, np.zeros(alphabet, dtype=np.int64))

    def _walk(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, bits, zeros in self.levels:
            ones = bits.ones(i)
            i = np.where(symbol >> level & 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands before i."""
        return self._walk(symbol, i) - self.first[symbol]


def suffix_order(text: np.ndarray, upto: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Suffix array by prefix doubling, and the ranks by the first h symbols,
    h the largest power of two up to ``upto``."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    h, kept, kept_h = 1, rank, 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[:max(0, n - h)] = rank[h:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.zeros(n, dtype=np.int64)
        new[order[1:]] = np.cumsum(key[order[1:]] != key[order[:-1]])
        rank, h = new, 2 * h
        if h <= upto:
            kept, kept_h = rank, h
        if n == 0 or rank[order[-1]] == n - 1:
            return order, kept, kept_h


class FmIndex:
    """Over ``sequences`` laid end to end with their ``lengths``; ``owner`` is
    each sequence's smallest document.  ``window``: length of reported matches."""

    def __init__(self, words: np.ndarray, lengths: np.ndarray, owner: np.ndarray, window: int):
        self.window = window
        self.alphabet, dense = np.unique(words, return_inverse=True)
        n_seq = len(lengths)
        ends = np.cumsum(lengths + 1) - 1
        text = np.zeros(len(words) + n_seq, dtype=np.int64)
        real = np.ones(len(text), dtype=bool)
        real[ends] = False
        text[real], text[ends] = dense + n_seq, np.arange(n_seq)
        order, ranks, h = suffix_order(text, window)
        symbol = np.where(real, text - n_seq + 1, 0)  # separators read as 0
        self.bwt = WaveletMatrix(symbol[order - 1], len(self.alphabet) + 1)
        counts = np.bincount(symbol, minlength=len(self.alphabet) + 1)
        self.before = np.cumsum(counts) - counts
        # neighbours in suffix order that share ``window`` symbols form a group
        a, b = order[:-1], order[1:]
        shift = window - h
        inside = (a + shift < len(text)) & (b + shift < len(text))
        same = (ranks[a] == ranks[b]) & inside
        same &= ranks[np.where(inside, a + shift, 0)] == ranks[np.where(inside, b + shift, 0)]
        starts = np.flatnonzero(np.concatenate([[True], ~same]))
        self.group = np.cumsum(np.concatenate([[True], ~same])) - 1
        self.bounds = np.append(starts, len(text))
        owners = np.repeat(owner, lengths + 1)[order]
        self.least = np.minimum.reduceat(owners, starts)
        self.size = len(text)

    def least_owner(self, words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each window of each sequence, the smallest owner of a sequence
        that holds it: ([sequences, windows], mask).

        All sequences go backward in step.  The interval after each extension
        is widened to the matches of the first ``window`` words (matching
        statistics cut at that length).  The sequences must be in the index,
        so an extension never fails."""
        n, w = len(lengths), self.window
        first = np.cumsum(lengths) - lengths
        symbols = np.searchsorted(self.alphabet, words) + 1
        most = int(lengths.max()) if n else 0
        out = np.zeros((n, max(0, most - w + 1)), dtype=np.int64)
        mask = np.arange(out.shape[1])[None, :] < (lengths - w + 1)[:, None]
        low, high = np.zeros(n, dtype=np.int64), np.full(n, self.size, dtype=np.int64)
        for back in range(1, most + 1):
            on = np.flatnonzero(lengths >= back)
            at = lengths[on] - back
            c = symbols[first[on] + at]
            both = self.bwt.rank(np.concatenate([c, c]), np.concatenate([low[on], high[on]]))
            lo = self.before[c] + both[:len(on)]
            hi = self.before[c] + both[len(on):]
            if back >= w:
                group = self.group[lo]
                lo, hi = self.bounds[group], self.bounds[group + 1]
                out[on, at] = self.least[group]
            low[on], high[on] = lo, hi
        return out, mask

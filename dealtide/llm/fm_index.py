"""A compressed full-text index of word sequences: Burrows-Wheeler transform in a wavelet tree, searched backwards.

The index holds many short pieces, each closed by an end mark of its own, and how often each piece occurs.
Matching statistics of a sequence say for each place how long the longest run of words from there is that the
indexed pieces hold at least twice. They are found from right to left: a word is put in front of the
present match by one step in the wavelet tree; if that leaves too few occurrences, the match is cut from the right to the next
shorter one with more occurrences, its parent interval. All sequences are searched in step, as arrays.
"""

from __future__ import annotations

import numpy as np


class WaveletTree:
    """Ranks of symbols. One bit vector a level, in 64-bit words with the ones before each word."""

    def __init__(self, symbols: np.ndarray, width: int) -> None:
        self.levels: list[tuple[int, np.ndarray, np.ndarray, int]] = []
        for shift in range(width - 1, -1, -1):
            bits = (symbols >> shift) & 1
            packed = np.packbits(bits.astype(np.uint8), bitorder="little")
            words = np.zeros(len(symbols) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.zeros(len(words), np.int32)
            before[1:] = np.cumsum(np.bitwise_count(words))[:-1]
            self.levels.append((shift, words, before, len(symbols) - int(bits.sum())))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def descend(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where ``place`` comes to lie among the symbols equal to ``symbol``, in the order of the last level."""
        for shift, words, before, zeros in self.levels:
            word = place >> 6
            below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[word] + np.bitwise_count(words[word] & below)
            place = np.where((symbol >> shift) & 1, zeros + ones, place - ones)
        return place


def sorted_suffixes(text: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array by prefix doubling, and the common prefix of each suffix with the one before it.

    No two suffixes agree in more than ``longest`` symbols.
    """
    ranks, span = [np.unique(text, return_inverse=True)[1]], 1
    while True:
        rank = ranks[-1]
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-span] = rank[span:] + 1
        key = rank * np.int64(len(rank) + 1) + ahead
        order = np.argsort(key)
        found = key[order]
        fresh = np.empty(len(rank), np.int64)
        fresh[order] = np.concatenate([[0], np.cumsum(found[1:] != found[:-1])])
        span *= 2
        if span > longest:
            break
        ranks.append(fresh)
    one, other = order[:-1].copy(), order[1:].copy()
    common = np.full(len(text) + 1, -1, np.int64)
    shared = np.zeros(len(one), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        step = (ranks[level][one] == ranks[level][other]) * (1 << level)
        one, other, shared = one + step, other + step, shared + step
    common[1:-1] = shared
    return order, common


def lesser_before(values: np.ndarray) -> np.ndarray:
    """For each place the last one before it with a lesser value, by pointer jumping."""
    found = np.arange(-1, len(values) - 1)
    found[0] = 0
    open_ = np.flatnonzero(values[found] >= values)
    open_ = open_[open_ > 0]
    while len(open_):
        found[open_] = found[found[open_]]
        stuck = (values[found[open_]] >= values[open_]) & (found[open_] > 0)
        open_ = open_[stuck]
    return found


class FMIndex:
    """``words`` are symbols from 1 on, piece after piece with ``sizes``; piece i occurs ``weights[i]`` times."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> None:
        pieces, last = len(sizes), int(words.max(initial=1))
        ends = np.cumsum(sizes + 1) - 1
        self.size = len(words) + pieces
        symbols = np.zeros(self.size, np.int64)
        is_word = np.ones(self.size, bool)
        is_word[ends] = False
        symbols[is_word] = words
        # end marks sort before all words and differ from one another
        text = symbols + pieces
        text[ends] = np.arange(pieces)
        order, self.common = sorted_suffixes(text, int(sizes.max(initial=0)) + 1)
        self.tree = WaveletTree(symbols[order - 1], last.bit_length())
        first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=last + 1))[:-1]])
        every = np.arange(last + 1)
        self.shift = first - self.tree.descend(every, np.zeros(last + 1, np.int64))
        owner = np.searchsorted(ends, order)
        self.occurrences = np.concatenate([[0], np.cumsum(weights[owner])])
        self.left = lesser_before(self.common)
        self.right = self.size - lesser_before(self.common[::-1])[::-1]

    def step(self, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the matches with one word more in front."""
        both = self.shift[np.tile(word, 2)] + self.tree.descend(np.tile(word, 2), np.concatenate([low, high]))
        return both[: len(word)], both[len(word) :]

    def matching_statistics(self, words: np.ndarray, sizes: np.ndarray, least: int = 2) -> np.ndarray:
        """For each word of the sequences how many words from it on the index holds ``least`` times or more, in a row."""
        order = np.argsort(-sizes, kind="stable")
        ends = np.cumsum(sizes)[order]
        lengths = sizes[order]
        low, high = np.zeros(len(sizes), np.int64), np.full(len(sizes), self.size)
        matched, found = np.zeros(len(sizes), np.int64), np.zeros(len(words), np.int64)
        for back in range(1, int(sizes.max(initial=0)) + 1):
            live = int(np.searchsorted(-lengths, -back, side="right"))
            at = ends[:live] - back
            todo = np.arange(live)
            while len(todo):
                a, b = self.step(words[at[todo]], low[todo], high[todo])
                enough = self.occurrences[b] - self.occurrences[a] >= least
                taken = todo[enough]
                low[taken], high[taken] = a[enough], b[enough]
                matched[taken] += 1
                todo = todo[~enough]
                todo = todo[matched[todo] > 0]
                # the parent interval: the longest shorter match with more occurrences
                at_low, at_high = self.common[low[todo]], self.common[high[todo]]
                depth = np.maximum(at_low, at_high)
                low[todo] = np.where(at_low == depth, self.left[low[todo]], low[todo])
                high[todo] = np.where(at_high == depth, self.right[high[todo]], high[todo])
                matched[todo] = depth
            found[at] = matched[:live]
        return found

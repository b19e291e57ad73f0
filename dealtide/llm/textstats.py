"""Figures of one text or one line, on UTF-8 bytes; plain helpers of Arrow batches."""

from __future__ import annotations

import numpy as np

from dealtide.llm.common import WHITE

# The symbol characters of the quality contract.
SYMBOLS = b"#*$%&|<>"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = b"0123456789"
_STOPS = b".!?;:,"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def n_of(data: bytes, characters: bytes) -> int:
    return len(data) - len(data.translate(None, characters))


def code_points(data: bytes) -> int:
    return len(data.translate(None, bytes(range(0x80, 0xC0))))


def repeated_words(words: list[bytes], width: int = 8) -> int:
    """Words that lie in a window of ``width`` words which the text has twice or more."""
    if len(words) <= width:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    # names of windows of 2, 4 and 8 words from those of their halves; equal name, equal window
    span = 1
    while span < width:
        pairs = ids[:-span] * len(words) + ids[span:]
        ids = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        span *= 2
    twice = np.bincount(ids)[ids] > 1
    if not twice.any():
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + width, -1)
    return int(np.count_nonzero(np.cumsum(edges)[:-1]))


def worded_lines(data: bytes) -> list[bytes]:
    return [line for line in data.split(b"\n") if line.strip(WHITE)]


# Statistics that the quality classifier reads, in this order.
NAMES = (
    "log_words", "word_length", "longest_word", "symbols", "upper", "digits", "stops", "distinct", "adjacent",
    "top_word", "dup_lines", "line_words", "short_lines", "high_bytes", "repeated", "exclaims", "bars",
)


def statistics(data: bytes) -> list[float]:
    """The values of ``NAMES`` for a whole text; all zero for one without words."""
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    chars = max(1, len(data))
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = worded_lines(data)
    lengths = [len(line) for line in lines]
    return [
        float(np.log1p(n)),
        sum(map(len, words)) / n,
        float(max(map(len, words))),
        n_of(data, SYMBOLS) / n,
        n_of(data, _UPPER) / chars,
        n_of(data, _DIGITS) / chars,
        n_of(data, _STOPS) / n,
        len(counts) / n,
        sum(map(bytes.__eq__, words[1:], words)) / n,
        max(counts.values()) / n,
        1 - len(set(lines)) / len(lines),
        n / len(lines),
        sum(x < 40 for x in lengths) / len(lines),
        n_of(data, bytes(range(0x80, 0x100))) / chars,
        repeated_words(words) / n,
        data.count(b"!!") / n,
        data.count(b" | ") / n,
    ]

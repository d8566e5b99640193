"""Hashes of the words of many texts at once, without a Python object per word.

A polynomial over the bytes of a round is summed once; a word's hash is the difference of two partial
sums, shifted back to position zero and mixed.  Equal words have equal 64-bit hashes anywhere.
"""

from __future__ import annotations

import numpy as np

from tallyforge.llm.common import mixed

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)
BLANKS = (0x20, *range(0x09, 0x0E))
_powers: dict[int, np.ndarray] = {}


def byte_classes(separators, lower: bool = True) -> np.ndarray:
    """A value for each byte: 0 for separators, else the byte plus one, A-Z lower-cased if asked."""
    values = np.arange(1, 257, dtype=np.uint64)
    if lower:
        values[ord("A") : ord("Z") + 1] += np.uint64(32)
    values[list(separators)] = 0
    return values


#: Words as runs of anything but white space, and as runs of letters (all beyond ASCII counts as one).
VISIBLE = byte_classes(BLANKS)
LETTERS = byte_classes([b for b in range(128) if not chr(b).isalpha()])


def _power(base: int, length: int) -> np.ndarray:
    held = _powers.get(base)
    if held is None or len(held) < length:
        factors = np.full(length, base, np.uint64)
        factors[:1] = 1
        held = np.cumprod(factors, dtype=np.uint64)
        if length <= 1 << 22:
            _powers[base] = held
    return held[:length]


def word_hashes(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray = VISIBLE, beginnings=()):
    """Hashes of all words in order, and for each text the number of its first word (and the total).

    Words never cross from one text to the next.  ``beginnings`` are lengths in bytes: for each there
    are as many further hashes behind the words', of the first bytes of each word (0 if it is shorter).
    """
    values = classes[data]
    inside = values != 0
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    starts = np.flatnonzero(begins)
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | edge[1:-1]
    ends = np.flatnonzero(stops) + 1
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    values *= _power(BASE, len(data))
    np.cumsum(values, out=sums[1:])
    back = _power(INVERSE, len(data) + 1)[starts]
    hashes = [mixed((sums[ends] - sums[starts]) * back)]
    for length in beginnings:
        head = mixed((sums[np.minimum(starts + length, ends)] - sums[starts]) * back + np.uint64(length))
        hashes.append(np.where(ends - starts >= length, head, np.uint64(0)))
    return np.concatenate(hashes), np.searchsorted(starts, offsets)


def shingle_hashes(hashes: np.ndarray, firsts: np.ndarray, size: int = 5):
    """Hashes of all runs of ``size`` words, and for each text the number of its first run.

    A text with fewer words, but at least one, has its whole sequence as its only run.
    """
    counts = np.diff(firsts)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    where = np.concatenate([[0], np.cumsum(runs)])
    at = np.repeat(firsts[:-1] - where[:-1], runs) + np.arange(where[-1])
    length = np.repeat(np.minimum(counts, size), runs)
    out = length.astype(np.uint64)
    for step in range(size):
        within = step < length
        part = hashes[np.minimum(at + step, max(0, len(hashes) - 1))] if len(hashes) else out
        out = np.where(within, mixed(out * np.uint64(BASE) + part), out)
    return out, where

"""Vectorised hashing of byte strings, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
BASE = _U(0x9E3779B97F4A7C15)
INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
CODES = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
LETTERS = CODES.copy()
LETTERS[65:91] = LETTERS[97:123]
WORD = np.ones(256, bool)
WORD[[32, *range(9, 14)]] = False
SLAB = 1 << 20
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, length: int) -> np.ndarray:
    """base ** 0 .. base ** (length - 1), modulo 2 ** 64."""
    known = _powers.get(int(base))
    if known is None or len(known) < length:
        size = 1 << max(12, (length - 1).bit_length())
        known = np.full(size, base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        _powers[int(base)] = known
    return known[:length]


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Spans:
    """Hashes of any substrings of one buffer, each from two look-ups."""

    def __init__(self, buffer: np.ndarray):
        self.sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(CODES[buffer] * powers(BASE, len(buffer)), out=self.sums[1:])
        self.back = powers(INVERSE, len(buffer) + 1)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])

    def all(self, length: int) -> np.ndarray:
        """Hashes of the substrings of one length, by start."""
        return mix((self.sums[length:] - self.sums[:-length]) * self.back[: len(self.sums) - length])


def binaries(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column one after another, and where each value begins
    (one more entry than values). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    starts = np.frombuffer(buffers[1], kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    if column.null_count:
        sizes = np.where(np.asarray(column.is_valid()), np.diff(starts), 0)
        parts = [data[s : s + n] for s, n in zip(starts[:-1], sizes)]
        data = np.concatenate(parts) if parts else data[:0]
        return data, np.concatenate(([0], np.cumsum(sizes)))
    return data[starts[0] : starts[-1]], starts - starts[0]


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of bytes other than space and 9 to 13, A-Z as a-z) of
    texts that stand one after another, and where each text's words begin."""
    word = WORD[data]
    begin, end = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    inner = starts[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begin[inner] = word[inner]
    end[inner - 1] = word[inner - 1]
    first, last = np.flatnonzero(begin), np.flatnonzero(end) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(LETTERS[data] * powers(BASE, len(data)), out=sums[1:])
    found = (sums[last] - sums[first]) * powers(INVERSE, len(data) + 1)[first] + (last - first).astype(np.uint64)
    return mix(found), np.searchsorted(first, starts)


def long_text(text: np.ndarray) -> np.ndarray:
    """`word_hashes` of one text of any length, stretch by stretch."""
    out, at = [], 0
    while at < len(text):
        upto = min(len(text), at + SLAB)
        while upto < len(text):
            # a stretch ends at white space
            blank = np.flatnonzero(~WORD[text[upto : upto + SLAB]])
            if len(blank):
                upto += int(blank[0])
                break
            upto = min(len(text), upto + SLAB)
        out.append(word_hashes(text[at:upto], np.array([0, upto - at]))[0])
        at = upto
    return np.concatenate(out)


def shingled(hashes: np.ndarray, run: int) -> np.ndarray:
    """Hashes of all runs of `run` words."""
    count = len(hashes) - run + 1
    total = np.zeros(max(0, count), np.uint64)
    for i in range(run):
        total = mix(total + hashes[i : count + i] * _U(2 * i + 1)) + _U(run)
    return mix(total)


def shingle_sets(data: np.ndarray, starts: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of `words` words; a shorter
    text is one run, a text without words has none."""
    none, at = np.zeros(0, np.uint64), 0
    while at < len(starts) - 1:
        upto = max(at + 1, int(np.searchsorted(starts, starts[at] + SLAB, side="right")) - 1)
        own = starts[at : upto + 1] - starts[at]
        part = data[starts[at] : starts[upto]]
        if len(part) > SLAB:
            hashes = long_text(part)
            bounds = np.array([0, len(hashes)])
        else:
            hashes, bounds = word_hashes(part, own)
        runs = shingled(hashes, words)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= words:
                own_runs = np.sort(runs[a : b - words + 1])
                new = np.ones(len(own_runs), bool)
                np.not_equal(own_runs[1:], own_runs[:-1], out=new[1:])
                yield own_runs[new]
            else:
                yield shingled(hashes[a:b], b - a) if b > a else none
        at = upto


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)

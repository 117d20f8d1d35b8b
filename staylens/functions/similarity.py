"""Longest common subsequence, for the candidate pairs that survive all filters."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

# executors get the function itself and need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def common_letters(a: str, b: str) -> int:
    """Length of the longest common subsequence: what both begin and end with, and of the
    rest one word operation per letter, where a zero bit marks a matched position of `a`."""
    least, begin, end = min(len(a), len(b)), 0, 0
    while begin < least and a[begin] == b[begin]:
        begin += 1
    while end < least - begin and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[begin : len(a) - end], b[begin : len(b) - end]
    places: dict[str, int] = {}
    for i, letter in enumerate(a):
        places[letter] = places.get(letter, 0) | (1 << i)
    full = (1 << len(a)) - 1
    free = full
    for letter in b:
        hit = free & places.get(letter, 0)
        free = ((free + hit) | (free - hit)) & full
    return begin + end + len(a) - free.bit_count()


LETTERS = 256


def common_many(a: list[str], b: list[str]) -> np.ndarray:
    """`common_letters` of each pair, all pairs of up to `LETTERS` letters side by side."""
    la, lb = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    out, least = np.zeros(len(la), np.int32), np.minimum(la, lb)
    long = np.maximum(la, lb) > LETTERS
    few = np.flatnonzero(~long)
    if len(few):
        width, la, lb, least = int(max(la[few].max(), lb[few].max())) + 1, la[few], lb[few], least[few]
        x, y = (np.array([c[i] for i in few], f"U{width}").view(np.uint32).reshape(-1, width) for c in (a, b))
        at, every = np.arange(width), np.arange(len(few))[:, None]
        begin = ((x != y) | (at >= least[:, None])).argmax(axis=1)
        back = x[every, la[:, None] - 1 - at] != y[every, lb[:, None] - 1 - at]
        end = (back | (at >= (least - begin)[:, None])).argmax(axis=1)
        out[few] = begin + end
        ma, mb = la - begin - end, lb - begin - end
        for low, high in ((0, 8), (8, 32), (32, 63)):
            mine = np.flatnonzero((ma > low) & (ma <= high) & (mb > 0))
            if len(mine):
                out[few[mine]] += common_bits(x, y, mine, begin[mine], ma[mine], mb[mine])
        long[few] = (ma > 63) & (mb > 0)
    for i in np.flatnonzero(long):
        out[i] = common_letters(a[i], b[i])
    return out


def common_bits(x: np.ndarray, y: np.ndarray, rows: np.ndarray, begin: np.ndarray, ma: np.ndarray, mb: np.ndarray) -> np.ndarray:
    """Common letters of `ma` (63 at most) and `mb` letters from `begin` in the given rows."""
    order = np.argsort(-mb, kind="stable")
    row, begin, ma, mb = rows[order], begin[order], ma[order], mb[order]
    place = np.arange((int(ma.max()) + 7) // 8 * 8)
    letters = np.where(
        place < ma[:, None], x[row[:, None], np.minimum(begin[:, None] + place, x.shape[1] - 1)], np.uint32(0xFFFFFFFF)
    )
    full = (np.uint64(1) << ma.astype(np.uint64)) - np.uint64(1)
    free = full.copy()
    for j in range(int(mb[0])):
        n = int(np.searchsorted(-mb, -j, side="left"))  # those with more than j letters
        bits = np.zeros((n, 8), np.uint8)
        bits[:, : len(place) // 8] = np.packbits(letters[:n] == y[row[:n], begin[:n] + j][:, None], axis=1, bitorder="little")
        now = free[:n]
        hit = now & bits.view("<u8")[:, 0]
        free[:n] = ((now + hit) | (now - hit)) & full[:n]
    found = np.empty(len(rows), np.int64)
    found[order] = ma - np.bitwise_count(free)
    return found


def common_length(a: Column, b: Column) -> Column:
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(common_many(x.tolist(), y.tolist()), dtype="int32")

    # declared so for the optimizer only: it must run once per pair, after the
    # pairs are made distinct
    return F.pandas_udf(run, "int").asNondeterministic()(a, b)

"""String similarity between 0 and 1; a missing side counts as 0."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def edit_similarity(left: Column, right: Column) -> Column:
    """``1 - edits / longer length``; two empty strings are equal."""
    longer = F.greatest(F.length(left), F.length(right))
    score = F.when(longer == 0, 1.0).otherwise(1.0 - F.levenshtein(left, right) / longer)
    return F.when(left.isNotNull() & right.isNotNull(), score).otherwise(0.0)


def jaro_winkler(left: str, right: str) -> float:
    if left == right:
        return 1.0
    reach = max(max(len(left), len(right)) // 2 - 1, 0)
    free = [True] * len(right)
    hits: list[str] = []
    for i, char in enumerate(left):
        for j in range(max(i - reach, 0), min(i + reach + 1, len(right))):
            if free[j] and right[j] == char:
                free[j] = False
                hits.append(char)
                break
    if not hits:
        return 0.0
    others = [char for char, unused in zip(right, free) if not unused]
    swaps = sum(a != b for a, b in zip(hits, others)) // 2
    m = len(hits)
    jaro = (m / len(left) + m / len(right) + (m - swaps) / m) / 3
    if jaro <= 0.7:
        return jaro
    common = 0
    for a, b in zip(left[:4], right[:4]):
        if a != b:
            break
        common += 1
    return jaro + 0.1 * common * (1 - jaro)


#: Longest strings whose places fit in a mask, and pairs that are scored together.
MASK, TOGETHER = 64, 20_000


def _code_points(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(strings × places code points, lengths); places behind a string's end hold 0."""
    lengths = np.array([len(v) for v in values], np.int64)
    grid = np.zeros((len(values), max(int(lengths.max(initial=0)), 1)), np.uint32)
    flat = np.frombuffer("".join(values).encode("utf-32-le", "surrogatepass"), "<u4")
    row = np.repeat(np.arange(len(values)), lengths)
    grid[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return grid, lengths


def jaro_winkler_many(left: list[str], right: list[str]) -> np.ndarray:
    """``jaro_winkler`` of many pairs at once, of at most ``MASK`` characters a string.

    The free places of the right strings are bits of a mask a pair. For each place of the left
    strings, the places with its character are compared into a mask, cut to the window and to what
    is free, and the lowest bit is taken: the same greedy choice, for all pairs in a few steps.
    """
    x, n = _code_points(left)
    y, m = _code_points(right)
    one, every = np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF)

    def low_bits(count: np.ndarray) -> np.ndarray:
        count = np.clip(count, 0, MASK).astype(np.uint64)
        return np.where(count >= MASK, every, (one << np.minimum(count, np.uint64(MASK - 1))) - one)

    reach = np.maximum(np.maximum(n, m) // 2 - 1, 0)
    free = low_bits(m)
    hits = np.zeros(x.shape, bool)
    weights = one << np.arange(y.shape[1], dtype=np.uint64)
    for i in range(x.shape[1]):
        same = ((y == x[:, i:i + 1]) * weights).sum(axis=1, dtype=np.uint64)
        window = low_bits(i + reach + 1) & ~low_bits(i - reach)
        found = np.where(i < n, same & window & free, np.uint64(0))
        first = found & (~found + one)
        free ^= first
        hits[:, i] = first != 0
    taken = ((~free[:, None] & weights) != 0) & (np.arange(y.shape[1]) < m[:, None])
    count = hits.sum(axis=1)
    row = np.repeat(np.arange(len(left)), count)
    swaps = np.bincount(row, weights=x[hits] != y[taken], minlength=len(left)).astype(np.int64) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(count > 0, (count / n + count / m + (count - swaps) / count) / 3, 0.0)
    width = min(4, x.shape[1], y.shape[1])
    places = np.arange(width)
    alike = (x[:, :width] == y[:, :width]) & (places < np.minimum(n, m)[:, None])
    common = np.cumprod(alike, axis=1).sum(axis=1)
    score = np.where(jaro > 0.7, jaro + 0.1 * common * (1 - jaro), jaro)
    equal = np.array([a == b for a, b in zip(left, right)], bool)
    return np.where(equal, 1.0, score)


@F.pandas_udf(T.DoubleType())
def jaro_winkler_similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    """Spark has no Jaro-Winkler. Each distinct value pair of a batch is scored once."""
    scores = np.zeros(len(left))
    there = np.flatnonzero((left.notna() & right.notna()).to_numpy())
    a, a_values = pd.factorize(left.iloc[there])
    b, b_values = pd.factorize(right.iloc[there])
    codes, back = np.unique(a * max(len(b_values), 1) + b, return_inverse=True)
    pairs = [(a_values[c // len(b_values)], b_values[c % len(b_values)]) for c in codes.tolist()]
    found = np.zeros(len(pairs))
    short = np.array([max(len(x), len(y)) <= MASK for x, y in pairs], bool)
    for i in np.flatnonzero(~short).tolist():
        found[i] = jaro_winkler(*pairs[i])
    places = np.flatnonzero(short)
    for start in range(0, len(places), TOGETHER):
        part = places[start:start + TOGETHER]
        found[part] = jaro_winkler_many(*map(list, zip(*[pairs[i] for i in part.tolist()])))
    scores[there] = found[back]
    return pd.Series(scores, dtype="float64")

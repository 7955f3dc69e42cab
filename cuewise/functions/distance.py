"""Edit distances over characters and words."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def edits(a: Sequence, b: Sequence) -> int:
    """Levenshtein distance of two strings or lists of any length: a column of the table is kept as the bits of two whole
    numbers (Hyyrö's form of Myers' algorithm), so a step costs a few operations on len(a) bits."""
    if len(a) < len(b):
        a, b = b, a
    lo, n, m = 0, len(a), len(b)
    while lo < m and a[lo] == b[lo]:
        lo += 1
    while m > lo and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
    a, b = a[lo:n], b[lo:m]
    n = len(a)
    if not len(b):
        return n
    wanted, places = set(b), {}
    for i, x in enumerate(a):
        if x in wanted:
            places.setdefault(x, []).append(i)
    at = {}
    for x, own in places.items():
        bits = bytearray(n // 8 + 1)
        for i in own:
            bits[i >> 3] |= 1 << (i & 7)
        at[x] = int.from_bytes(bits, "little")
    mask, last = (1 << n) - 1, n - 1
    up, down, out = mask, 0, n
    for x in b:
        same = at.get(x, 0)
        diagonal = ((((same & up) + up) ^ up) | same | down) & mask
        right = down | (mask ^ (diagonal | up))
        left = diagonal & up
        out += (right >> last) - (left >> last)
        right = (right << 1) | 1
        up = ((left << 1) & mask) | (mask ^ ((diagonal | right) & mask))
        down = right & diagonal
    return out


def _counted(a: Column, b: Column) -> Column:
    @F.pandas_udf("bigint")
    def each(x: pd.Series, y: pd.Series) -> pd.Series:
        # strings come as they are, arrays as numpy arrays
        rows = [None if p is None or q is None else edits(p, q) if isinstance(p, str) else edits(list(p), list(q)) for p, q in zip(x, y, strict=True)]
        return pd.Series(rows, dtype="Int64")

    return each(a, b)


def char_edits(a: Column, b: Column) -> Column:
    return _counted(a, b)


def word_edits(a: Column, b: Column) -> Column:
    """a, b: arrays of words, with any number of distinct ones."""
    return _counted(a, b)


def disagreement(edits: Column, length_of_first: Column) -> Column:
    """Edits over the length of the first; null if that is empty."""
    return F.when(length_of_first > 0, edits / length_of_first)

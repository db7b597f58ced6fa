"""Fuzzy comparison of short texts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence; bits of an integer hold a row of the table."""
    where: dict[str, int] = {}
    for i, mark in enumerate(a):
        where[mark] = where.get(mark, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for mark in b:
        match = row & where.get(mark, 0)
        row = ((row + match) | (row - match)) & full
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """100 * 2 * common / (len(a) + len(b)): how alike texts are under insertions and deletions."""
    total = len(a) + len(b)
    return 100.0 * 2 * _common_subsequence(a, b) / total if total else 100.0


def partial_ratio(a: str, b: str) -> float:
    """The largest indel_ratio of the shorter text with any window of the longer one.

    Windows have the shorter text's length, and less at both ends.  Two empty texts are equal
    (100); one empty text is unlike any other (0).
    """
    short, long = sorted((a, b), key=len)
    if not short:
        return 0.0 if long else 100.0
    size, best = len(short), 0.0
    letters = set(short)
    for end in range(1, len(long) + size):
        window = long[max(0, end - size) : end]
        # a best window begins and ends with a character of the shorter text
        if window[-1] not in letters and window[0] not in letters:
            continue
        best = max(best, indel_ratio(short, window))
        if best == 100.0:
            break
    return best


def partial_ratio_column(a: Column, b: Column) -> Column:
    """partial_ratio() of two columns, in Arrow batches; null where either is null."""

    @F.pandas_udf("double")
    def compare(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in pairs:
            yield pd.Series([None if x is None or y is None else partial_ratio(x, y) for x, y in zip(left, right)], dtype="float64")

    return compare(a, b)

"""Likeness of strings."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def likeness(a: str, b: str) -> float:
    """``SequenceMatcher(None, a, b).ratio()``; difflib itself does long texts, whose frequent letters it passes over.

    Of each pair of parts the longest common run is taken, of several the first in ``a``, then the first in ``b``; then what stands before and behind it.
    """
    if len(b) >= 200:
        return SequenceMatcher(None, a, b).ratio()
    total, todo = 0, [(a, b)]
    while todo:
        x, y = todo.pop()
        i, size, at, n = 0, 0, 0, len(x)
        while i + size < n:
            if x[i : i + size + 1] in y:
                size, at = size + 1, i
            else:
                i += 1
        if size:
            total += size
            j = y.index(x[at : at + size])
            if at and j:
                todo.append((x[:at], y[:j]))
            if at + size < n and j + size < len(y):
                todo.append((x[at + size :], y[j + size :]))
    return 2.0 * total / (len(a) + len(b)) if a or b else 1.0


def ratio(a: Column, b: Column) -> Column:
    """Ratcliff-Obershelp likeness; the order of the arguments matters. No built-in function has it, so it runs in Arrow batches."""

    @F.pandas_udf("double")
    def of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            yield pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(left, right, strict=True)], dtype="float64")

    return of(a, b)


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard likeness of two arrays as sets; 0 where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def may_reach(a: Column, b: Column, least: float) -> Column:
    """Upper bound of ``ratio`` by lengths, to leave out pairs before it runs."""
    la, lb = F.length(a), F.length(b)
    return 2 * F.least(la, lb) >= least * (la + lb)

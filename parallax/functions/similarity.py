"""Fuzzy title scores from 0 to 100, by the longest common subsequence."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

MATCH, NEAR = 70.0, 95.0


def _masks(a: str) -> dict[str, int]:
    """For each character a bit at each of its places."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def _common(masks: dict[str, int], n: int, b: str) -> int:
    full = (1 << n) - 1
    state = full
    for c in b:
        hit = state & masks.get(c, 0)
        state = (state + hit | state - hit) & full
    return n - state.bit_count()


def common(a: str, b: str) -> int:
    """Length of the longest common subsequence: one bit for each character of a, a step for each of b."""
    return _common(_masks(a), len(a), b)


def ratio(a: str, b: str) -> float:
    return 200 * common(a, b) / (len(a) + len(b)) if a or b else 100.0


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter string with a part of the longer: windows of its length, and shorter ends."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    best = _best_part(a, b, 0.0)
    return _best_part(b, a, best) if len(b) == len(a) and best < 100.0 else best


def _best_part(a: str, b: str, best: float) -> float:
    """Goes through the windows of b in one sweep. A window that lies d places on has no more than d characters in
    common in addition, and a shorter end no more than a longer one: parts that can't be better are passed over."""
    n, masks = len(a), _masks(a)
    i = 0
    while i + n <= len(b):
        hits = _common(masks, n, b[i : i + n])
        best = max(best, 200 * hits / (2 * n))
        i += max(1, int(best * n / 100 - hits))
    for end in (lambda k: b[:k], lambda k: b[-k:]):
        k, hits = n - 1, n
        while k > 0:
            if best < 200 * min(k, hits) / (n + k):
                hits = _common(masks, n, end(k))
                best = max(best, 200 * hits / (n + k))
            elif k <= hits:
                break  # still shorter ones are bounded by their length
            k = min(k - 1, int(200 * hits / best - n)) if best else k - 1
    return best


@F.pandas_udf(DoubleType())
def ratio_of(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else ratio(x, y) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(DoubleType())
def partial_ratio_of(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else partial_ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def sorted_tokens(text: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(text, r"\s+"), lambda t: t != "")), " ")


def token_sort_ratio(a: Column, b: Column) -> Column:
    return ratio_of(sorted_tokens(a), sorted_tokens(b))


def title_score(a: Column, b: Column) -> Column:
    """The better of the token-sorted and the partial ratio, of lower-cased titles."""
    a, b = F.lower(a), F.lower(b)
    return F.greatest(token_sort_ratio(a, b), partial_ratio_of(a, b))

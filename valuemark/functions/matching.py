"""Similarity of word sets, 0 to 100, over Arrow batches of candidate pairs."""

from __future__ import annotations

import functools
from collections.abc import Set

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


@functools.lru_cache(1 << 14)
def _places(a: str) -> dict[str, int]:
    """A bit for each place of each letter."""
    found: dict[str, int] = {}
    for j, x in enumerate(a):
        found[x] = found.get(x, 0) | 1 << j
    return found


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of its table as the bits of a number."""
    places, full = _places(a), (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@functools.lru_cache(1 << 14)
def letter_counts(name: str) -> np.ndarray:
    """How often a name's words have each letter and digit, any other character counted as one kind; each word once."""
    letters = "".join(set(name.split()))
    return np.bincount([ord(c) - 97 if "a" <= c <= "z" else ord(c) - 22 if "0" <= c <= "9" else 36 for c in letters], minlength=37).astype("i2")


def word_set_similarity(x: Set[str], y: Set[str]) -> float:
    """100 if one word set holds the other; else the best similarity among shared words with and without each rest.

    Similarity is twice the longest common subsequence over both lengths. The shared words lead on each side, so only the rests are compared.
    """
    if not x or not y:
        return 0.0
    both = x & y
    only_a, only_b = x - both, y - both
    if both and (not only_a or not only_b):
        return 100.0
    a, b = " ".join(sorted(only_a)), " ".join(sorted(only_b))
    if not both:
        return 200.0 * common_length(a, b) / (len(a) + len(b))
    base = sum(map(len, both)) + len(both) - 1
    return max(200.0 * (base + 1 + common_length(a, b)) / (2 * base + 2 + len(a) + len(b)), 200.0 * base / (2 * base + 1 + min(len(a), len(b))))


def token_set_similarity(a: str, b: str) -> float:
    return word_set_similarity(set(a.split()), set(b.split()))


@F.pandas_udf(DoubleType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set_similarity(x or "", y or "") for x, y in zip(a, b)], dtype="float64")

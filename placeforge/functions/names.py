"""Similarity of names, 0 to 100: longest common subsequences, whole and over the best window, and of their words."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: From which ratio of lengths windows count, up to which they count fully, and what words, windows and far longer names are worth.
WINDOWS_FROM, LONG_FROM, WORDS_WORTH, WINDOW_WORTH, LONG_WORTH = 1.5, 8.0, 0.95, 0.9, 0.6


def _places(s: str) -> dict[str, int]:
    """Of each character a number whose bits are its places."""
    out: dict[str, int] = {}
    for k, c in enumerate(s):
        out[c] = out.get(c, 0) | 1 << k
    return out


def _common(places: dict[str, int], m: int, t: str) -> int:
    """Length of the longest common subsequence with a string of m characters: its row of the table as bits, a step for each character of t."""
    full = row = (1 << m) - 1
    for c in t:
        same = row & places.get(c, 0)
        row = (row + same | row - same) & full
    return m - row.bit_count()


def ratio(a: str, b: str) -> float:
    """Twice the longest common subsequence over both lengths; two empty strings are equal."""
    return 200.0 * _common(_places(a), len(a), b) / (len(a) + len(b)) if a or b else 100.0


def window_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter string to a window of its length in the longer one; windows at the ends may be shorter."""
    if not a or not b:
        return 100.0 if a == b else 0.0
    best = 0.0
    for short, long in ((a, b), (b, a)) if len(a) == len(b) else ((min(a, b, key=len), max(a, b, key=len)),):
        m, n, places = len(short), len(long), _places(short)
        for start in range(1 - m, n):
            window = long[max(start, 0) : start + m]
            best = max(best, 200.0 * _common(places, m, window) / (m + len(window)))
    return best


def _parts(a: str, b: str) -> tuple[str, str, str, str, str, bool]:
    """Sorted words of each, joined; the words of both, of a alone, of b alone; whether a word stands twice in either."""
    x, y = sorted(a.split()), sorted(b.split())
    p, q = set(x), set(y)
    return " ".join(x), " ".join(y), " ".join(sorted(p & q)), " ".join(sorted(p - q)), " ".join(sorted(q - p)), len(p) < len(x) or len(q) < len(y)


def words_ratio(a: str, b: str) -> float:
    """The better of the sorted words' ratio and of the three ratios between the common words alone and with each side's others."""
    x, y, both, left, right, _ = _parts(a, b)
    if both and not (left and right):
        return 100.0
    n, gap = len(both), 1 if both else 0
    with_left, with_right = n + gap + len(left), n + gap + len(right)
    apart = len(left) + len(right) - 2 * _common(_places(left), len(left), right)
    found = [ratio(x, y), 100.0 - 100.0 * apart / (with_left + with_right) if with_left + with_right else 100.0]
    if both:
        found += [100.0 - 100.0 * (gap + len(s)) / (n + w) for s, w in ((left, with_left), (right, with_right))]
    return max(found)


def words_window_ratio(a: str, b: str) -> float:
    x, y, both, left, right, twice = _parts(a, b)
    if both:
        return 100.0
    return max(window_ratio(x, y), window_ratio(left, right) if twice else 0.0)


def weighted_ratio(a: str, b: str) -> float:
    """Names of about the same length by their characters or their words; others also by windows, which count less the longer the one is."""
    if not a or not b:
        return 0.0
    times = max(len(a), len(b)) / min(len(a), len(b))
    whole = ratio(a, b)
    if times < WINDOWS_FROM:
        return max(whole, words_ratio(a, b) * WORDS_WORTH)
    worth = WINDOW_WORTH if times <= LONG_FROM else LONG_WORTH
    return max(whole, window_ratio(a, b) * worth, words_window_ratio(a, b) * WORDS_WORTH * worth)


@F.pandas_udf(DoubleType())
def name_score(a: pd.Series, b: pd.Series) -> pd.Series:
    """0 to 100, by characters as they are; null and empty names score 0. Equal pairs of a batch are worked out once."""
    known: dict[tuple, float] = {}
    out = []
    for pair in zip(a.where(a.notna(), None), b.where(b.notna(), None)):
        if pair not in known:
            known[pair] = weighted_ratio(pair[0] or "", pair[1] or "")
        out.append(known[pair])
    return pd.Series(out, dtype="float64")

"""Scores of names on worked-out pairs and against a plain table of common subsequences."""

import random

import pytest
from pyspark.sql import functions as F

from placeforge.functions import names as N


def table(a, b):
    row = [0] * (len(a) + 1)
    for c in b:
        new = [0]
        for i, x in enumerate(a):
            new.append(row[i] + 1 if x == c else max(row[i + 1], new[-1]))
        row = new
    return row[-1]


def test_common_subsequences_of_any_length():
    rng = random.Random(2)
    for n in (0, 1, 5, 63, 64, 65, 200):
        for _ in range(20):
            a, b = ("".join(rng.choice("abé ") for _ in range(rng.randint(0, n))) for _ in range(2))
            assert N._common(N._places(a), len(a), b) == table(a, b)
            if a and b:
                s, t = sorted((a, b), key=len)
                windows = {t[max(i, 0) : i + len(s)] for i in range(1 - len(s), len(t))}
                assert N.window_ratio(a, b) == pytest.approx(max(200 * table(s, w) / (len(s) + len(w)) for w in windows) if len(a) != len(b) else max(max(200 * table(x, w) / (len(x) + len(w)) for w in {y[max(i, 0) : i + len(x)] for i in range(1 - len(x), len(y))}) for x, y in ((a, b), (b, a))))


@pytest.mark.parametrize(
    "a, b, score",
    [
        ("BISHAN", "BISHAN", 100.0),
        ("BISHAN", "", 0.0),
        ("CITY HALL", "HALL CITY", 95.0),  # the same words
        ("BISHAN", "BISHAN MRT STATION", 90.0),  # a window of a name that is three times as long
        ("A", "A BCDEFGHIJ", 60.0),  # more than eight times as long
        ("BAY FRONT", "BAY MRT STATION", 85.5),  # a common word, 15 characters to 9
        ("this is a test", "this is a test!", 200 * 14 / 29),
        ("fuzzy fuzzy was a bear", "fuzzy was a bear", 95.0),
    ],
)
def test_weighted_ratio(a, b, score):
    assert N.weighted_ratio(a, b) == pytest.approx(score) == N.weighted_ratio(b, a)


def test_name_score_of_nulls(spark):
    df = spark.createDataFrame([("A", None), (None, None), ("AB", "AB"), ("", "")], "a string, b string")
    assert [r[0] for r in df.select(N.name_score(F.col("a"), F.col("b"))).collect()] == [0.0, 0.0, 100.0, 0.0]

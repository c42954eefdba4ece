"""Joins of texts with words and of ranges with ranges, beside plain comparison."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rolodeck.operators import classify, matching, searches


def texts(rng, n):
    parts = ["riga", "Latvia", "united kingdom", "new york", "ü", "", "a", "berlin, germany", "x" * 30]
    return [(i, None if i % 17 == 0 else " ".join(rng.choice(parts) for _ in range(rng.randint(0, 4)))) for i in range(n)]


@pytest.mark.parametrize("few", [10_000, 0])
def test_containing(spark, monkeypatch, few):
    """Words of one character and many, longer than the pieces, equal beginnings, repeated, empty and null words."""
    monkeypatch.setattr(matching, "FEW", few)
    rows = texts(random.Random(1), 60)
    words = ["riga", "latvia", "united kingdom", "united kingdoms", "new", "new york", "ü", "a", "x" * 12, "", None, "new", "kingdom new"]
    df = spark.createDataFrame(rows, "ord int, word string")
    said = spark.createDataFrame(list(enumerate(words)), "n int, w string")
    got = sorted((r.ord, r.n) for r in matching.containing(df, F.lower("word"), said, "w").collect())
    assert got == sorted((i, n) for i, t in rows for n, w in enumerate(words) if t is not None and w is not None and w in t.lower())


@pytest.mark.parametrize("few", [10_000, 0])
def test_overlapping(spark, monkeypatch, few):
    """Also empty, reversed, negative and null ranges."""
    monkeypatch.setattr(matching, "FEW", few)
    rng = random.Random(2)
    some = lambda n: [(i, *rng.choice([(a := rng.randint(-50, 50), a + rng.randint(-3, 40)), (rng.randint(-9, 9), None), (None, 3), (-(2**62), 2**62)][: rng.choice([1, 1, 4])])) for i in range(n)]
    rows, ranges = some(80), some(60)
    df, r = spark.createDataFrame(rows, "ord int, low long, high long"), spark.createDataFrame(ranges, "n int, a long, b long")
    got = sorted((x.ord, x.n) for x in matching.overlapping(df, F.col("low"), F.col("high"), r, "a", "b").collect())
    assert got == sorted((i, n) for i, x, y in rows for n, a, b in ranges if None not in (x, y, a, b) and b > x and a < y)


def test_a_hundred_thousand_words(spark):
    rng = random.Random(3)
    words = list({"".join(rng.choice("abcd") for _ in range(rng.randint(3, 14))) for _ in range(100_000)})
    assert len(words) > matching.FEW
    rows = [(i, "".join(rng.choice("abcd") for _ in range(40))) for i in range(100)]
    got = {(r.ord, r.w) for r in matching.containing(spark.createDataFrame(rows, "ord int, t string"), F.col("t"), spark.createDataFrame([(w,) for w in words], "w string"), "w").collect()}
    known = set(words)
    assert got == {(i, t[a:b]) for i, t in rows for a in range(40) for b in range(a + 3, min(40, a + 14) + 1) if t[a:b] in known}


def test_a_hundred_thousand_ranges(spark):
    rng = np.random.default_rng(4)
    low = rng.integers(0, 10**9, 100_000)
    high = low + rng.integers(1, 10**5, 100_000)
    asks = rng.integers(0, 10**9, 200)
    ranges = spark.createDataFrame(list(zip(range(100_000), low.tolist(), high.tolist(), strict=True)), "n int, a long, b long")
    df = spark.createDataFrame([(i, int(x), int(x) + 10**6) for i, x in enumerate(asks)], "ord int, low long, high long")
    got = {(r.ord, r.n) for r in matching.overlapping(df, F.col("low"), F.col("high"), ranges, "a", "b").collect()}
    assert got == {(i, int(n)) for i, x in enumerate(asks) for n in np.flatnonzero((high > x) & (low < x + 10**6))}


@pytest.mark.parametrize("few", [10_000, 0])
def test_the_operators_that_use_them(spark, monkeypatch, few):
    monkeypatch.setattr(matching, "FEW", few)
    filters = spark.createDataFrame([(1, ["Nowhere", "Riga, Latvia", "Berlin, Germany"]), (2, ["x"]), (3, [])], "search_id int, locations array<string>")
    words = spark.createDataFrame([("latvia", "LV", 1), ("germany", "DE", 2)], "word string, code string, pos int")
    assert {r.search_id: r.code for r in searches.country(filters, words, "US").collect()} == {1: "LV", 2: "US", 3: "US"}
    buckets = spark.createDataFrame([("a", 0, 10), ("b", 10, 100), ("c", 100, 1000)], "bucket string, low long, high long")
    asked = spark.createDataFrame([(1, 5, 50), (2, 10, 10), (3, 20, None), (4, None, 5), (5, 2000, 3000)], "k int, low long, high long")
    assert {r.k: r.buckets for r in classify.revenue_buckets(asked, "k", "low", "high", buckets).collect()} == {1: "a|b", 3: "b|c"}

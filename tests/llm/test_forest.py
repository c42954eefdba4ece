"""The hash-prefix forest against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rolodeck.llm import forest as N
from rolodeck.llm import queries as Q

KIND = "vec_id long, embedding array<float>, score double"


def cosine(a, b):
    a, b = np.array(a, np.float64), np.array(b, np.float64)
    return float((a * b).sum() / (math.sqrt((a * a).sum()) * math.sqrt((b * b).sum())))


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def plain(rows, asks, k=5):
    """(query_id, rank, vec_id, score) of whole tables of (id, vector)."""
    rows = {(i, tuple(np.float32(x) + np.float32(0) for x in v)) for i, v in rows if i is not None and good(v)}
    out = []
    for q in [r for r in rows if asks(r[0])]:
        near = sorted((-cosine(q[1], v), i) for i, v in rows if (i, v) != q and len(v) == len(q[1]))[:k]
        out += [(q[0], rank, i, -s) for rank, (s, i) in enumerate(near, 1)]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def close(a, b):
    assert [x[:3] for x in a] == [x[:3] for x in b]
    assert all(abs(x[3] - y[3]) < 1e-12 for x, y in zip(a, b, strict=True))


def odd(rng):
    """Copies, near copies, ties, other lengths, and vectors that take no part."""
    base = rng.standard_normal((60, 6)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(100 + i, base[0].tolist()) for i in range(40)] + [(200 + i, (base[1] + rng.standard_normal(6).astype(np.float32) * 1e-3).tolist()) for i in range(60)]
    rows += [(300, [1.0, 0.0, 0.0]), (350, [1.0, 1.0, 0.0]), (301, [0.0, 1.0, 0.0]), (302, [-0.0, 1.0, 0.0]), (303, [0.0, 2.0, 0.0]), (400, [1.0])]
    rows += [(500, None), (501, []), (502, [0.0] * 6), (550, [None, *[1.0] * 5]), (551, [math.nan, *[1.0] * 5]), (552, [math.inf, *[1.0] * 5]), (None, base[3].tolist())]
    return rows + [rows[0], rows[5], (5, base[9].tolist()), (50, base[9].tolist())]


@pytest.mark.parametrize("most, wide", [(16_384, False), (20, False), (7, True)])
def test_whole_table_at_the_root(spark, most, wide):
    """With a recall that only the root gives, it is the exact answer."""
    rows = odd(np.random.default_rng(1))
    df = spark.createDataFrame([(i, v, 0.5) for i, v in rows], KIND)
    if wide:
        df = df.withColumn("embedding", F.col("embedding").cast("array<double>"))
    got = N.nearest(df, df.filter("vec_id % 50 = 0"), trees=3, first=2, start=4, recall=1.0, most=most)
    close(found(got), plain(rows, lambda i: i % 50 == 0))


def test_fewer_candidates_than_asked_for(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], 0.0), (1, [2.0, 1.0], 0.0), (50, [1.0, 0.0, 0.0], 0.0)], KIND)
    assert [x[:3] for x in found(N.nearest(df, df.filter("vec_id % 50 = 0")))] == [(0, 1, 1)]


def test_a_vector_that_a_third_of_all_rows_have(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(3000)] + [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((600, 4)).astype(np.float32), 5000)]
    df = spark.createDataFrame([(i, v, 0.0) for i, v in rows], KIND)
    got = [x[:3] for x in found(N.nearest(df, df.filter("vec_id % 50 = 0"), most=100)) if x[0] < 3000]
    assert got == [(q, r, i) for q in range(0, 3000, 50) for r, i in enumerate([i for i in range(6) if i != q][:5], 1)]


def test_prefixes():
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((500, 8))
    strings = N.hash_strings(vectors, 0, 1)
    part = N.Part(strings, vectors, [[i] for i in range(500)], [b""] * 500)
    for string in strings[:40].tolist():
        for bits in (0, 1, 5, N.BITS):
            a, b = part.shared(string, bits)
            assert {x >> (N.BITS - bits) for x in part.strings[a:b].tolist()} == {string >> (N.BITS - bits)}
            assert b - a == sum(x >> (N.BITS - bits) == string >> (N.BITS - bits) for x in strings.tolist())
        for least in (1, 3, 50, 500):
            a, b = part.descend(string, least)
            sizes = [sum(x >> (N.BITS - bits) == string >> (N.BITS - bits) for x in strings.tolist()) for bits in range(N.BITS + 1)]
            assert b - a == min(s for s in sizes if s >= least)


def test_reach():
    """The longest prefix with the wanted chance, by drawing."""
    for score in (0.3, 0.6, 0.9, 0.99):
        x = N.reach(np.array([score]), 32, 0.9)
        p = 1 - math.acos(score) / math.pi
        assert x == 0 or 1 - (1 - p**x) ** 32 >= 0.9
        assert x == N.BITS or 2 ** (x + 1) <= 32 or 1 - (1 - p ** (x + 1)) ** 32 < 0.9
    assert N.reach(np.array([1.0]), 32, 0.9) == N.BITS
    assert N.reach(np.array([-1.0]), 32, 0.9) == 0 == N.reach(np.array([]), 32, 0.9)


def test_recall_on_clusters(spark):
    """Below the root: vectors around centres; nine of ten neighbours are found, and only part of the table is compared."""
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((40, 32))
    vectors = (centres[rng.integers(0, 40, 3000)] + 0.25 * rng.standard_normal((3000, 32))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0.0) for i, v in enumerate(vectors)], KIND)
    got = found(N.nearest(df, df.filter("vec_id % 50 = 0"), start=32, most=500))
    want = plain([(i, v.tolist()) for i, v in enumerate(vectors)], lambda i: i % 50 == 0)
    assert len(got) == len(want)
    exact = {x[:1] + x[2:3] for x in want}
    assert len({x[:1] + x[2:3] for x in got} & exact) >= 0.9 * len(want)
    scores = np.sort([x[3] for x in want])
    assert N.reach(scores[:5], 32, 0.93) > 5


def test_empty(spark):
    none = spark.createDataFrame([], KIND)
    assert N.nearest(none, none).count() == 0


@pytest.mark.parametrize("folder", ["sf0.01", "check_s"])
def test_recall_of_the_query(spark, folder):
    """At least nine of ten of the true neighbours, with their exact scores."""
    folder = f"/root/testdata/{folder}"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    ids, v = rows.vec_id.to_numpy(), np.stack(rows.embedding.to_numpy()).astype(np.float64)
    unit = v / np.sqrt((v * v).sum(axis=1))[:, None]
    got, hits, asked = found(Q.op12_neighbours(spark, folder)), 0, 0
    by = {}
    for q, rank, i, s in got:
        by.setdefault(q, []).append((rank, i, s))
    at = {int(i): n for n, i in enumerate(ids)}
    for n in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[n]
        score[n] = -2
        true = set(ids[np.argsort(-score)[:5]].tolist())
        mine = sorted(by[int(ids[n])])
        assert [r for r, _, _ in mine] == [1, 2, 3, 4, 5]
        assert all(abs(s - cosine(v[n], v[at[i]])) < 1e-12 for _, i, s in mine)
        hits, asked = hits + len(true & {i for _, i, _ in mine}), asked + 5
    assert hits >= 0.9 * asked

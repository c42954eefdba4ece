"""The mix against a plain queue."""

import hashlib
import random

import pytest

from rolodeck.llm import mixing as M


def plain_targets(sizes, weights, budget, most):
    """By raising the level until nothing is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = budget * sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in capped]
        share = {s: (total - sum(capped.values())) * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if share[s] > most * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: most * sizes[s] for s in over}


def plain_mix(rows, weights, budget, most, seed):
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    targets = plain_targets(sizes, weights, budget, most)
    queue = []
    for s in sizes:
        own = sorted((hashlib.md5(f"{seed}:{d}".encode()).hexdigest(), d, len((t or "").split())) for d, x, t in rows if x == s)
        cum = 0
        for k in range(most):
            for h, d, n in own:
                cum += n
                if n:
                    queue.append((cum / targets[s], s is None, s or "", h, d, n))
    taken, so_far = {}, 0
    for _, _, _, _, d, n in sorted(queue):
        so_far += n
        if so_far > budget * sum(sizes.values()):
            break
        taken[d] = taken.get(d, 0) + 1
    return taken, targets, sizes


@pytest.mark.parametrize("seed", range(4))
def test_against_plain_queue(spark, seed):
    rng = random.Random(seed)
    sources = ["b", "a", None, "ž", "hot", "hot", "hot"]
    rows = [(i, rng.choice(sources), rng.choice([None, "", "w " * rng.randint(1, 30)])) for i in range(250)] + [(900, "huge", "w " * 3000)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, source string, text string, _start int, bucket int")
    mix = M.plan_mix(df, [5, 2, 1], 1.5, 2, seed="s")
    got = mix.apply(df, "times", "size", "source_size", "target").collect()
    taken, targets, sizes = plain_mix(rows, [5, 2, 1], 1.5, 2, "s")
    assert {r.doc_id: r.times for r in got if r.times} == taken
    assert len(got) == len(rows) and got[0]._start == 1
    for r in got:
        assert r.target == pytest.approx(targets[r.source], rel=1e-9, abs=1e-9) and r.source_size == sizes[r.source]


def test_all_at_their_caps(spark):
    df = spark.createDataFrame([(1, "a", "x y"), (2, "b", "z")], "doc_id long, source string, text string")
    assert {r.doc_id: r.times for r in M.plan_mix(df, budget=2.0).apply(df, "times").collect()} == {1: 2, 2: 2}
    assert {r.doc_id: r.times for r in M.plan_mix(df, budget=9.0).apply(df, "times").collect()} == {1: 2, 2: 2}


def test_nothing_to_mix(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "")], "doc_id long, source string, text string")
    assert {r.times for r in M.plan_mix(df).apply(df, "times").collect()} == {0}
    assert M.plan_mix(df.limit(0)).apply(df.limit(0), "times").count() == 0


def test_repeated_rows_and_null_ids(spark):
    rows = [(None, "a", "x y z"), (None, "a", "p q"), (3, "a", "r s t"), (3, "a", "r s t"), (4, None, "u")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = M.plan_mix(df, budget=1.0).apply(df, "times").collect()
    assert len(got) == len(rows) and len({r.times for r in got if r.doc_id == 3}) == 1

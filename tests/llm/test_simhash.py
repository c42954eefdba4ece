"""SimHash groups against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rolodeck.llm import simhash as S


def brute(prints, most):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= most:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(prints))]


def plain_fingerprint(text, k):
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \t\n", "a", "a b c d", "A b C d e f", "é ü é ü é ü é", "x " * 50])
def test_fingerprint(text):
    assert S.fingerprint(text.encode(), 4) == plain_fingerprint(text, 4)
    assert S.fingerprint(None, 4) == 0


def test_gray_rank_is_a_permutation():
    codes = np.arange(256, dtype=np.uint64)[None]
    ranks = S.gray_rank(codes)[0]
    order = codes[0][np.argsort(ranks)]
    assert sorted(ranks.tolist()) == list(range(256))
    assert all(int(a ^ b).bit_count() == 1 for a, b in zip(order[:-1], order[1:], strict=True))


def test_gray_rank_of_several_words():
    """Patterns of 3 leading and 3 last bits, two words: the ranks' order changes one bit at a time."""
    codes = np.array([[a for a in range(8) for _ in range(8)], [b << 61 for _ in range(8) for b in range(8)]], np.uint64)
    ranks = S.gray_rank(codes)
    order = np.lexsort(ranks[::-1])
    apart = [sum(int(x).bit_count() for x in codes[:, i] ^ codes[:, j]) for i, j in zip(order[:-1], order[1:], strict=True)]
    assert apart == [1] * 63


@pytest.mark.parametrize("seed", range(4))
def test_wide_index_against_brute_force(seed):
    rng = np.random.default_rng(seed)
    prints = rng.integers(0, 2**63, (4, 5), dtype=np.uint64)[:, rng.integers(0, 5, 120)]
    for _ in range(30):
        prints[rng.integers(0, 4, 120), np.arange(120)] ^= np.uint64(1) << rng.integers(0, 64, 120).astype(np.uint64)
    group = np.sort(rng.integers(0, 2, 120))
    prints = prints[:, np.lexsort((*S.gray_rank(prints)[::-1], group))]
    got = S.group_roots(group, np.zeros(120, int), prints, 40, fan=3, work=500)
    whole = [sum(int(x) << 64 * k for k, x in enumerate(column)) for column in prints.T]
    for g in (0, 1):
        at = np.flatnonzero(group == g)
        assert [at[i] for i in brute([whole[i] for i in at], 40)] == got[at].tolist()


@pytest.mark.parametrize("seed", range(8))
def test_index_against_brute_force(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 250))
    prints = rng.integers(0, 2**63, 4, dtype=np.uint64)[rng.integers(0, 4, n)]
    for _ in range(int(rng.integers(0, 9))):
        prints = prints ^ np.where(rng.random(n) < 0.7, np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64), np.uint64(0))
    prints = np.unique(prints)
    group = np.unique(np.sort(rng.integers(0, 3, len(prints))), return_inverse=True)[1]
    prints = prints[np.lexsort((S.gray_rank(prints[None])[0], group))]
    got = S.group_roots(group, np.zeros(len(prints), int), prints[None], 4, fan=int(rng.integers(2, 9)), work=int(rng.integers(1, 3000)))
    for g in set(group.tolist()):
        at = np.flatnonzero(group == g)
        assert [at[i] for i in brute([int(x) for x in prints[at]], 4)] == got[at].tolist()


def test_masks_cover_every_close_pair():
    found = S.masks(4, 6)
    assert len(found) == 15
    rng = random.Random(1)
    for _ in range(300):
        apart = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(apart & m == 0 for [m] in found)


def documents(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(120)]
        texts.append(base)
        for _ in range(rng.randint(0, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(copy)
    rows = [(i, " ".join(t), "x") for i, t in enumerate(texts)] + [(900, None, "x"), (901, "", None), (902, "  ", "x"), (None, "lonely words here", "x"), (None, None, "x"), (3, " ".join(texts[3]), "x")]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string, print string"), rows


@pytest.mark.parametrize("most, blocks, told", [(20_000, 6, 100_000), (6, 6, 100_000), (3, 5, 100_000), (3, 6, 0)])
def test_groups_against_brute_force(spark, monkeypatch, most, blocks, told):
    """Null and empty texts, null ids, repeated rows, a column that clashes, and upper groups split into blocks, with their sizes told to all tasks or joined."""
    monkeypatch.setattr(S, "BROADCAST_GROUPS", told)
    docs, rows = documents(spark)
    prints = [plain_fingerprint(t or "", 4) for _, t, _ in rows]
    roots = brute(prints, 4)
    least = {}
    for (i, _, _), r in zip(rows, roots, strict=True):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    want = sorted(((i, p, least[r]) for (i, _, _), p, r in zip(rows, prints, roots, strict=True)), key=str)
    got = [(r.doc_id, r.fingerprint % (1 << 64), r.component) for r in S.simhash_groups(docs, most=most, blocks=blocks).collect()]
    assert sorted(got, key=str) == want


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert S.simhash_groups(none).count() == 0


def test_components_of_chains(spark):
    edges = spark.range(1, 200).select(F.col("id").alias("node"), (F.col("id") - 1).alias("root"))
    assert {r.component for r in S.components(edges).collect()} == {0}


def test_components_of_a_star_with_many_ends(spark):
    """The centre is a heavy key of the joins: over 100 rows and over a ten-thousandth of all."""
    edges = spark.range(1, 3000).select(F.col("id").alias("node"), F.lit(0).cast("long").alias("root")).unionByName(spark.range(5000, 5040).select(F.col("id").alias("node"), F.lit(4999).cast("long").alias("root")))
    found = {r.node: r.component for r in S.components(edges).collect()}
    assert found == dict.fromkeys(range(3000), 0) | dict.fromkeys(range(4999, 5040), 4999)

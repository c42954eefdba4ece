"""The prefix trie against whole rebuilt conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from rolodeck.llm import trie as T


def plain(rows):
    """rows: (conv_id, turn, role, text). The same table from rebuilt texts."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(x)] for c, x in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole = tuple(turns.get(base, [])[:h] + turns[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    out = []
    for node, cs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        leaf = lambda n: not any(m[: len(n)] == n and len(m) > len(n) for m in members)
        out.append(
            (
                cs[0],
                len(node),
                members[node[:-1]][0] if node else None,
                len(cs),
                sum(len(n) == len(node) + 1 for n in below),
                sum(map(leaf, below)),
                sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
                hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def found(df):
    return sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect()), key=str)


def rows(seed):
    rng = random.Random(seed)
    said = ["hi", "Hi", "é", "", None, "long " * 20, "日本"]
    out = []
    for c in [*range(0, 12), *range(100, 130), *range(203, 215), -1, -100, -101, -105, 305]:
        for t in range(rng.choice([1, 2, 3, 6, 7, 9])):
            out.append((c, rng.choice([None, t, t, t, 3]), rng.choice(["user", "assistant", None]) if rng.random() < 0.2 else "user", rng.choice(said[: rng.choice([1, 2, 7])])))
    out += [(400, t, "user", f"turn {t % 7}") for t in range(40)] + [(c, t, "user", f"turn {t % 7}") for c in (401, 402) for t in range(30)]
    return out + [(None, 0, "user", "nobody's"), out[3], out[3], out[20]]


@pytest.mark.parametrize("seed, block", [(1, 4096), (2, 3), (3, 1)])
def test_against_rebuilt_texts(spark, monkeypatch, seed, block):
    """Null turns, roles, texts and ids, tied and repeated rows, absent bases, negative ids, turnless and long conversations."""
    monkeypatch.setattr(T, "BLOCK", block)
    data = rows(seed)
    docs = spark.createDataFrame([(*r, "x") for r in data], "conv_id long, turn long, role string, text string, depth string").repartition(5)
    assert found(T.prefix_trie(docs)) == plain(data)


def test_a_conversation_with_a_third_of_all_rows(spark):
    """It lies in several ranges, as do two that share its turns."""
    kind = "conv_id long, turn long, role string, text string"
    data = [(c, t, "user", f"{t * t % 11}") for c in (500, 501, 507) for t in range(150)] + [(c, t, "user", "x") for c in range(510, 520) for t in range(9)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = spark.createDataFrame(data, kind)
        at = T.placed_turns(T._turns(docs, 0)).collect()
        assert len({r.part for r in at if r.c == 500}) > 1
        assert sorted(r.before + r.local for r in at if r.c == 500) == list(range(150))
        assert found(T.prefix_trie(docs)) == plain(data)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_fingerprints_are_a_monoid():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-(2**63), 2**63, (2, 50))
    whole = T.terms(a, b, np.arange(50), 0)
    head, rest = T.terms(a[:20], b[:20], np.arange(20), 0), T.terms(a[20:], b[20:], np.arange(30), 0)
    for k, base in enumerate(T.bases(0)):
        assert sum(whole[k].tolist()) % T.PRIME == (sum(head[k].tolist()) + pow(int(base), 20, T.PRIME) * sum(rest[k].tolist())) % T.PRIME


def test_met_fingerprints_are_noticed(spark, monkeypatch):
    """With bases of 1, orders of turns can't be told apart: another seed is taken."""
    real = T.bases
    monkeypatch.setattr(T, "terms", lambda a, b, e, seed, f=T.terms: [(x & 1) for x in (a, a >> 1, b, b >> 1)] if seed == 0 else f(a, b, e, seed))
    data = [(c, t, "user", x) for c, xs in ((0, "abcdefgh"), (1, "bacdefhg"), (2, "cabdefgh"), (3, "hgfedcba")) for t, x in enumerate(xs)]
    docs = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    assert found(T.prefix_trie(docs)) == plain(data)
    assert real is T.bases


def test_empty(spark):
    kind = "conv_id long, turn long, role string, text string"
    assert T.prefix_trie(spark.createDataFrame([], kind)).count() == 0
    assert T.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], kind)).count() == 0

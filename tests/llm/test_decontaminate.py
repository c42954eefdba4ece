"""Benchmark passages against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql.classic.dataframe import DataFrame

from rolodeck.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        for x in [tuple(w[k : k + 13]) for k in range(len(w) - 12)] or ([tuple(w)] if w else []):
            windows.setdefault(x, set()).add(i)
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for x, named in windows.items():
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k : k + len(x)]) == x:
                    hit |= set(range(k, k + len(x)))
                    ids |= {str(i) for i in named if i is not None}
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def tables(spark, seed):
    rng = random.Random(seed)
    some = lambda n, m: " ".join(rng.choice("abcdé") + rng.choice(["", "9"]) for _ in range(rng.randint(n, m)))
    items = [(i, some(0, 20)) for i in range(15)] + [(3, some(5, 16)), (None, some(14, 14)), (20, None), (21, ""), (22, "A"), (23, some(13, 13))]
    docs = []
    for i in range(40):
        parts = [some(0, 10)] + [rng.choice(items)[1] or "" for _ in range(rng.randint(0, 2))] + [some(0, 30)]
        docs.append((i, rng.choice([" ", ". ", "\n"]).join(parts).upper() if i % 5 == 0 else " ".join(parts)))
    docs += [(50, None), (51, ""), (None, some(40, 40)), (2, docs[2][1]), (52, "x " * 60_000 + items[20][1])]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("most", [1_000_000, 60])
def test_against_brute_force(spark, seed, most):
    """As one block of patterns, and as many blocks one after another."""
    docs, items, d, b = tables(spark, seed)
    got = D.find_contamination(d, b, most_words=most, keep_text=False)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_words_of():
    for t in ["Ab-c 1x\x00é É_z`{~", "", "  ", "\x7f"]:
        assert [w.decode() for w in D.words_of(t.encode())] == words(t)


def test_empty_benchmark_and_clash(spark):
    docs, _, d, b = tables(spark, 0)
    got = D.find_contamination(d, b.limit(0)).collect()
    assert len(got) == len(docs) and not any(r.n_hit or r.contaminated for r in got)
    assert D.find_contamination(d.limit(0), b).count() == 0
    odd = d.withColumnRenamed("doc_id", "n_HIT")
    with pytest.raises(ValueError):
        D.find_contamination(odd, b)
    assert D.find_contamination(odd, b, prefix="x_").columns[:2] == ["n_HIT", "text"]


def test_many_blocks_write_no_text(spark, monkeypatch):
    """A benchmark of many blocks: one narrow pass, in whose plan nothing is shuffled or read from a checkpoint; only the benchmark is written."""
    docs, items, d, b = tables(spark, 7)
    monkeypatch.setattr(DataFrame, "checkpoint", lambda *_: pytest.fail("a checkpoint"))
    got = D.find_contamination(d, b, most_words=20, keep_text=False)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)

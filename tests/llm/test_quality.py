"""Features, exact bounds and certified cutoffs."""

import random
from fractions import Fraction
from math import comb

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rolodeck.llm import quality as Q


def plain_repeats(words, k=8):
    windows = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit |= set(range(i, i + k))
    return len(hit)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60))
def test_repeated_words(words):
    assert Q.repeated_words(words) == plain_repeats(words)


@pytest.mark.parametrize("text, want", [(None, (0, 0, 0, 0, 0)), ("", (0, 0, 0, 0, 0)), ("é#b\n\n é#b \né#b", (3, 9, 3, 1, 0)), ("a\n \n\na\na", (3, 3, 0, 2, 0)), ("one two", (2, 6, 0, 0, 0))])
def test_features(text, want):
    assert Q.features(text.encode() if text is not None else None)[:5] == want


@pytest.mark.parametrize("k, n, p", [(0, 10, 0.01), (3, 50, 0.1), (50, 50, 0.1), (0, 0, 0.1), (7, 400, 0.01)])
def test_binomial_tail_is_exact(k, n, p):
    q = Fraction(str(p))
    want = sum(comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(min(k, n) + 1)) if n else 1
    assert Q.binomial_tail(k, n, p) == pytest.approx(float(want), rel=1e-9)


def plain_choice(rows, alpha, delta):
    strata = {s for s, _, _ in rows}
    out = {}
    for s in strata:
        good = [t for x, q, t in rows if x == s and q == 1]
        bad = [t for x, q, t in rows if x == s and q == 0]
        best, at = 0, None
        for step in range(len(Q.LADDER)):
            rejected, caught = sum(t <= step for t in good), sum(t <= step for t in bad)
            if Q.binomial_tail(rejected, len(good), alpha) > delta / len(strata):
                break
            if caught - rejected > best:
                best, at = caught - rejected, step
        out[s] = at
    return out


@pytest.mark.parametrize("seed", range(3))
def test_certified_steps(spark, seed):
    rng = random.Random(seed)
    last = len(Q.LADDER)
    rows = [(s, 1, last if rng.random() < 0.97 else rng.randint(4, last)) for s in ("en", "de", None) for _ in range({"en": 900, "de": 40, None: 500}[s])]
    rows += [(s, 0, rng.randint(0, last)) for s in ("en", "de", None) for _ in range(60)]
    got = {r.stratum: r.cut for r in Q.certified_steps(spark.createDataFrame(rows, "stratum string, quality int, step int"), 0.02, 0.05).collect()}
    assert got == plain_choice(rows, 0.02, 0.05)
    assert got["de"] is None  # 40 documents certify nothing


def corpus(spark):
    rng = random.Random(2)
    good = lambda: " ".join(rng.choice(["sun", "moon", "tree", "river", "stone"]) + str(rng.randrange(500)) for _ in range(60))
    bad = lambda: " ".join(w + "$$$" for w in good().split())
    rows, labels = [], []
    for i in range(700):
        junk = i % 7 == 0
        rows.append((i, bad() if junk else good(), "en", 1))
        if i % 8:
            labels.append((i, 0 if junk else 1))
    rows += [(1000, None, "en", 1), (1001, "", None, 1), (1002, bad(), "xx", 1), (1003, "a b c d e f g h " * 30, "en", 1), (None, good(), "en", 1), (5, good(), "en", 1), (1004, good() + " w" * 50_000, "en", 1)]
    labels += [(None, 1), (99999, 1), (3, None), (4, 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words int"), spark.createDataFrame(labels, "doc_id long, quality int")


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_keep_good(spark, monkeypatch, most):
    """With labels told to all tasks, and with more than can be."""
    monkeypatch.setattr(Q, "BROADCAST_LABELS", most)
    docs, labels = corpus(spark)
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert all(i is None or i >= 1000 or i % 7 for i in ids)
    assert sum(i is not None and i < 700 for i in ids) == 600 + 1  # every good one, one of them twice
    assert {1002, None} <= set(ids) and not {1000, 1001, 1003, 1004} & set(ids)  # no labels: only base rules


def test_verdicts(spark):
    docs, labels = corpus(spark)
    got = Q.quality_verdicts(docs.drop("n_words"), labels)
    assert got.count() == docs.count()
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[1000].n_words == 0 and rows[1000].base_failed and not rows[1000].kept
    assert rows[1003].n_repeat_words == 240 and rows[1003].base_failed
    assert not rows[0].kept and not rows[0].base_failed


def test_without_labels_and_empty(spark):
    docs, labels = corpus(spark)
    assert Q.keep_good(docs, labels.limit(0)).filter("doc_id = 0").count() == 1
    assert Q.keep_good(docs.limit(0), labels).count() == 0
    with pytest.raises(ValueError):
        Q.with_features(docs)


def test_query_in_which_the_method_rejects(spark):
    """At sf0.1 there are labels enough to certify cutoffs: the whole query against brute force, with documents that only the method rejects."""
    from rolodeck.llm import queries

    folder, last = "/root/testdata/sf0.1", len(Q.LADDER)
    seen, verdicts = {}, {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "text").collect():
        n, _, symbols, dup_lines, repeated, lines, upper, letters, exclaims = Q.features((r.text or "").encode())
        shares = {"symbols per word": (symbols, n), "exclamation marks per word": (exclaims, n), "capitals among letters": (upper, letters), "repeated lines": (dup_lines, lines)}
        signal = max(a / b / Q.SIGNALS[k] if b else 0.0 for k, (a, b) in shares.items())
        step = sum(1.0 / signal > x for x in Q.LADDER) if signal else last
        verdicts[r.doc_id] = (r.lang, n < 20 or 100 * repeated > 30 * n, step)
        seen[r.doc_id] = r.text
    holdout = {}
    for r in spark.read.parquet(f"{folder}/labels.parquet").collect():
        lang, failed, step = verdicts.get(r.doc_id, (None, True, 0))
        if not failed and r.quality in (0, 1):
            old = holdout.get((lang, seen[r.doc_id]), (0, last))
            holdout[lang, seen[r.doc_id]] = (max(old[0], r.quality), min(old[1], step))
    cuts = plain_choice([(lang, q, step) for (lang, _), (q, step) in holdout.items()], 0.01, 0.05)
    want = {d: (failed, not failed and not (cuts.get(lang) is not None and step <= cuts[lang])) for d, (lang, failed, step) in verdicts.items()}
    got = {r.doc_id: (r.base_failed, r.kept) for r in queries.op5_quality(spark, folder).collect()}
    assert got == want and sum(not failed and not kept for failed, kept in got.values()) > 0


def test_copies_of_a_text_count_once(spark):
    """300 labelled copies of one good text, and an id labelled twice, certify no more than one text does."""
    good = " ".join(f"w{i}" for i in range(40)) + "!" * 8
    docs = spark.createDataFrame([(i, good, "en") for i in range(300)] + [(300 + i, " ".join(f"v{i}x{j}" for j in range(40)), "en") for i in range(3)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(303)] + [(301, 1), (301, 0)], "doc_id long, quality int")
    assert [(r.stratum, r.cut, r.n_good) for r in Q.choose_cutoffs(docs, labels).collect()] == [("en", None, 4)]

"""Near copies against brute force, and in the pipeline's stage."""

import random

import numpy as np
import pytest

from rolodeck.llm import neardup as N


def plain_shingles(text, k=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(texts, least=0.8):
    """For each text the smallest number of its group."""
    sets, parent = [plain_shingles(t) for t in texts], list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both >= least * (len(a) + len(sets[j]) - both) - 1e-9:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(texts))]


def planted(seed=3, bases=40):
    """Texts of 60 to 200 words, each with copies whose similarity lies between about 0.6 and 1, some of copies of copies."""
    rng = random.Random(seed)
    texts = []
    for _ in range(bases):
        family = [[f"w{rng.randrange(5000)}" for _ in range(rng.randint(60, 200))]]
        for _ in range(rng.randint(0, 6)):
            copy = list(rng.choice(family))
            for _ in range(rng.randint(0, max(1, len(copy) // 30))):
                copy[rng.randrange(len(copy))] = f"n{rng.randrange(5000)}"
            family.append(copy)
        texts += [" ".join(t) for t in family]
    rng.shuffle(texts)
    return texts


def roots_of(edges, n):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(n)]


@pytest.mark.parametrize("work", [1, 300, 1 << 22])
@pytest.mark.parametrize("sided", [False, True])
@pytest.mark.parametrize("way", [N._products, N._listed])
def test_sets_in_a_task(monkeypatch, work, sided, way):
    monkeypatch.setattr(N, "_products", way)
    monkeypatch.setattr(N, "_listed", way)
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(12):
        base = rng.choice(400, rng.integers(1, 40), replace=False)
        for _ in range(rng.integers(1, 6)):
            sets.append(np.unique(np.where(rng.random(len(base)) < 0.06, rng.integers(0, 400, len(base)), base)).astype(np.uint64))
    sets.append(np.zeros(0, np.uint64))
    side = rng.integers(1, 3, len(sets)) if sided else np.zeros(len(sets), int)
    close = lambda a, b: len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b)) - 1e-9 and len(a)
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if close(sets[i], sets[j]) and (not sided or side[i] != side[j])]
    assert len(pairs) > 5
    assert N.set_roots(sets, side, 0.8, work).tolist() == roots_of(pairs, len(sets))


def test_shingles_and_fingerprints():
    """Words in any case and spacing, each shingle once; bits differ as often as the similarity says."""
    assert len(N.shingles(b"a b c d e a b c d e", 5)) == 5 and len(N.shingles(b"a b", 5)) == 1 and not len(N.shingles(None, 5))
    assert N.shingles(b"A  b\tC d E", 5).tolist() == N.shingles(b"a b c d e", 5).tolist() != N.shingles(b"a b c d f", 5).tolist()
    rng, apart = np.random.default_rng(2), []
    for _ in range(200):
        both = rng.integers(0, 1 << 63, 320, dtype=np.uint64)  # 280 each, 240 in common: similarity 0.75
        a, b = N.fingerprint(both[:280]), N.fingerprint(both[40:])
        apart.append(int(np.bitwise_count(a ^ b).sum()))
    assert abs(np.mean(apart) / 256 - N.bit_odds(0.75)) < 0.01
    plain = [int(x) for x in N.fingerprint(np.array([7, 7 << 50, 12345], np.uint64))]
    assert plain == [int(x) for x in N.fingerprint(np.array([12345, 7, 7 << 50], np.uint64))]


def test_masks_find_what_is_promised():
    rng = np.random.default_rng(1)
    for nodes in (100, 1 << 20):
        plan, most = N.search_plan(nodes, 0.8, 0.99, 64)
        apart = rng.random((4000, 256)) < N.bit_odds(0.8)
        diffs = [int("".join("01"[int(x)] for x in row), 2) for row in apart]
        wide = [sum(m << 64 * k for k, m in enumerate(mask)) for mask in plan]
        found = np.mean([d.bit_count() <= most and any(d & m == 0 for m in wide) for d in diffs])
        assert 0.98 < found <= 1


@pytest.mark.parametrize("sizes", [{}, {"most": 4, "most_shingles": 300}])
def test_large_clusters_in_blocks(spark, sizes):
    """A cluster of 400 near copies, some of them linked only through others, and a hot centre."""
    rng, texts = random.Random(6), []
    base = [f"w{i}" for i in range(80)]
    for _ in range(300 if not sizes else 40):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(80)] = f"n{rng.randrange(50)}"
        texts.append(" ".join(copy))
    texts += planted(9, 5)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    nodes, found = N.near_copies(docs, **sizes)
    part = {r.node: r.component for r in found.collect()}
    by_part = {}
    for r in nodes.collect():
        by_part.setdefault(part.get(r.node, r.node), []).append(r.first.id)
    assert sorted(min(v) for v in by_part.values()) == sorted(set(brute(texts)))


def test_extra_columns_and_repeated_rows(spark):
    """Columns named as helpers, a map, and repeated rows that differ elsewhere: the smallest stays, whatever the order of rows."""
    rows = [(1, "same words here", "b", {"k": 1}), (1, "same words here", "a", {"k": 2}), (1, "same words here", "a", None), (2, None, "x", {}), (None, "", "y", {})]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, _hash string, _missing map<string,int>")
        kept = N.keep_one(docs)
        assert kept.columns == docs.columns
        assert sorted((r.doc_id, r._hash, r._missing) for r in kept.collect()) == [(1, "a", {"k": 2}), (2, "x", {})]


def test_against_brute_force(spark):
    """Null and short texts, null ids, repeated rows, and a column that clashes."""
    texts = [*planted(), None, "", "  ", "a b c", "A  b C", "lonely words"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(3, texts[3], "x"), (None, "a b c", "x"), (None, "no id here", "x")], "doc_id long, text string, node string")
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([*set(brute(texts)), None], key=str)


def test_stage_drops_copies_of_similarity_four_fifths(spark, small):
    """Copies at 0.8 to 0.9 go; pairs below 0.8 stay."""
    import corpus_pipeline as P

    rng, texts, gone = random.Random(8), [], set()
    for _ in range(60):
        base = [f"w{rng.randrange(9000)}" for _ in range(144)]
        for edits in (3, 4):  # 140 shingles each, 5 changed by each edit: similarity 125/155 (0.806) and 120/160 (0.75)
            copy = list(base)
            for e in range(edits):
                copy[10 + 30 * e] = f"n{rng.randrange(9000)}"
            if edits == 3:
                gone.add(len(texts) + 1)
                texts += [" ".join(base), " ".join(copy)]
            else:
                other = [f"o{w}" for w in base]
                texts += [" ".join(other), " ".join(f"o{w}" for w in copy)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in P.drop_near_duplicates(spark, docs, small).collect()}
    assert kept == set(range(len(texts))) - gone


def test_empty(spark):
    assert N.keep_one(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def exact_pairs(sets, least=0.8):
    """All pairs of sets at that similarity: such sets share one of their rarest elements; what shares one is compared as a whole."""
    import collections

    count = collections.Counter(x for s in sets for x in s)
    listed, found = collections.defaultdict(list), []
    for i, s in enumerate(sets):
        rare = sorted(s, key=lambda x: (count[x], x))[: len(s) - int(-(-least * len(s) // 1)) + 1]
        for j in {j for x in rare for j in listed[x]}:
            both = len(s & sets[j])
            if both >= least * (len(s) + len(sets[j]) - both) - 1e-9:
                found.append((j, i))
        for x in rare:
            listed[x].append(i)
    return found


def test_the_stage_over_a_large_table(spark):
    """Over all of sf0.1 the stage keeps what exact comparison of all pairs keeps: no link is lost, none is added."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = sorted((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())
    codes = {}
    sets = [{codes.setdefault(x, len(codes)) for x in plain_shingles(t)} for _, t in rows]
    root = roots_of(exact_pairs(sets), len(sets))
    empty = [i for i, s in enumerate(sets) if not s]
    want = sorted(rows[i][0] for i in range(len(rows)) if root[i] == i and (sets[i] or i == empty[0]))
    assert sorted(r.doc_id for r in N.keep_one(docs).select("doc_id").collect()) == want
    assert len(want) < len(rows)


def exchanged(df):
    """The columns that each exchange of the plan moves."""
    import re

    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(r"\(\d+\) Exchange[^\n]*\nInput \[\d+\]: \[([^\]]*)\]", plan)


def test_texts_are_shuffled_once(spark, tmp_path):
    """Without any broadcast join: sets are made where texts are read, and only the rows that stay are dealt, once."""
    docs = spark.createDataFrame([(i % 90, t) for i, t in enumerate(planted())], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        d = docs.select(N.F.col("doc_id").alias("id"), "text", N.content_hash("text").alias("content"))
        wanted = d.limit(20).select(N.F.monotonically_increasing_id().alias("node"), N.F.col("id").alias("id_"), N.F.col("content").alias("content_"))
        moved = exchanged(N.named_sets(d, wanted, 5))
        assert moved and not any("text#" in m for m in moved if "shingles" in m or "content#" in m)
        assert sum("text#" in m for m in exchanged(N.keep_one(docs))) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_named_sets_of_repeated_rows(spark):
    """Null ids and repeated rows: a set for each node, whatever the number of its rows."""
    rows = [(1, "a b c d e f"), (None, "a b c d e f")] + [(None, "x y z u v w")] * 50 + [(2, None), (2, "other words here")]
    d = spark.createDataFrame(rows, "id long, text string").withColumn("content", N.content_hash("text"))
    wanted = d.filter("id is null or id = 1").distinct().select(N.F.xxhash64("id", "content").alias("node"), N.F.col("id").alias("id_"), N.F.col("content").alias("content_"))
    got = {r.node: r.shingles for r in N.named_sets(d, wanted, 5).collect()}
    want = {r.node: N.shingles(t.encode(), 5).tobytes() for r in wanted.collect() for i, t in rows if i == r.id_ and t and d.filter(N.F.col("text") == t).first().content == r.content_}
    assert got == want and len(got) == 3


def test_key_filter(spark):
    rng = np.random.default_rng(1)
    keys, others = rng.integers(-(2**63), 2**63, (2, 3000))
    f = N.KeyFilter.of(spark.createDataFrame([(int(k),) for k in keys], "k long"), "k", 1 << 16)
    assert f.has(keys).all() and f.has(others).mean() < 0.02
    assert not N.KeyFilter.of(spark.createDataFrame([], "k long"), "k").has(others).any()

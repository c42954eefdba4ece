"""Each stage of the pipeline on odd rows and odd columns."""

import pytest

STAGES = ("quality rules", "near duplicates", "benchmark decontamination", "source mixing", "sharding")


def odd(spark):
    words = lambda a, n: " ".join(f"{a}{i}" for i in range(n))
    rows = [
        (1, words("a", 60), "en", "x"),
        (1, words("a", 60), "en", "x"),
        (2, words("b", 60), None, None),
        (None, words("c", 60), "en", "x"),
        (None, None, "en", "x"),
        (3, None, None, "y"),
        (4, "", "en", "y"),
        (5, words("long", 60_000), "en", "y"),
        (6, words("a", 60), "en", "y"),
    ]
    names = "doc_id long, text string, lang string, source string, _times int, _hash string, _q_kept boolean, _d_hit binary, Component string, _missing map<string,int>, n_words long, shard int"
    return spark.createDataFrame([(*r, 1, "h", True, b"x", "c", {"k": 1}, 7, 9) for r in rows], names)


@pytest.mark.parametrize("name", STAGES)
def test_stage(spark, small, name):
    import corpus_pipeline as P

    docs = odd(spark)
    stage = dict(P.STAGES)[name]
    kept = stage(spark, docs, small)
    assert kept.columns == docs.columns + (["shard_", "slot"] if name == "sharding" else [])
    rows = kept.collect()
    assert all((r._times, r._hash, r._q_kept, r.Component, r.n_words, r.shard, r._missing) == (1, "h", True, "c", 7, 9, {"k": 1}) for r in rows)
    ids = sorted((r.doc_id for r in rows), key=str)
    assert ids == {"quality rules": [1, 1, 2, 5, 6, None], "near duplicates": [1, 2, 3, 5, None], "benchmark decontamination": [1, 1, 2, 3, 4, 5, 6, None, None], "sharding": [1, 1, 2, 3, 4, 5, 6, None, None]}.get(name, ids)
    if name == "source mixing":
        assert set(ids) <= {1, 2, 5, 6, None} and all(r.text for r in rows)
    if name == "sharding":
        assert sorted(r.shard_ + 16 * r.slot for r in rows) == list(range(9))


@pytest.mark.parametrize("name", STAGES)
def test_empty(spark, small, name):
    import corpus_pipeline as P

    assert dict(P.STAGES)[name](spark, odd(spark).limit(0), small).count() == 0

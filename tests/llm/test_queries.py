"""The operators' queries against their SQL, and the pipeline's stages."""

import pytest

from rolodeck.llm import queries as Q

from ..compare import database, normal


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_matches_sql(spark, small, name):
    ours, theirs = Q.queries()[name](spark, small).toPandas(), database(small).sql(Q.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert normal(ours) == normal(theirs)


def test_pipeline(spark, small, tmp_path):
    """Each stage, on what its predecessor kept, against its brute-force version."""
    import corpus_pipeline as P

    from rolodeck.llm import quality

    from . import test_decontaminate, test_mixing, test_neardup

    def good(rows):
        """With so few labels no cutoff can be certified: the base rules decide."""
        kept = []
        for r in rows:
            n, _, _, _, repeated = quality.features(r.text.encode())[:5]
            if n >= 20 and 100 * repeated <= 30 * n:
                kept.append(r.doc_id)
        return kept

    def single(rows):
        """Groups by five-word shingles and a similarity of 0.8, as the contract has it for stages."""
        first = {}
        for r, root in zip(rows, test_neardup.brute([r.text for r in rows]), strict=True):
            first[root] = min(first.get(root, r.doc_id), r.doc_id)
        return first.values()

    def clean(rows):
        items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
        return [d for d, *_, bad in test_decontaminate.brute([(r.doc_id, r.text) for r in rows], items) if not bad]

    def mixed(rows):
        taken, _, _ = test_mixing.plain_mix([(r.doc_id, r.source, r.text) for r in rows], [5, 2, 1], 1.5, 2, "mix-0")
        return [d for d, n in taken.items() for _ in range(n)]

    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, rows = docs.columns, docs.collect()
    for i, ((_, stage), brute) in enumerate(zip(P.STAGES, (good, single, clean, mixed, None), strict=True)):
        stage(spark, docs, small).write.parquet(path := str(tmp_path / str(i)))
        docs = spark.read.parquet(path)
        before, rows = rows, docs.collect()
        assert docs.columns == columns + (["shard", "slot"] if brute is None else [])
        assert rows and sorted(r.doc_id for r in rows) == sorted(brute(before) if brute else (r.doc_id for r in before))
    assert sorted(r.slot * 16 + r.shard for r in rows) == list(range(len(before)))

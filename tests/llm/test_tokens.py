"""Token files and their scans."""

import numpy as np
import pytest

from rolodeck.llm import tokens as T
from rolodeck.llm.queries import SPLIT, VOCABULARY


@pytest.fixture(scope="module")
def vocabulary():
    return T.load_vocabulary(VOCABULARY)


def test_counts(spark, vocabulary):
    texts = ["hello world", "", None, "a", "é<|endoftext|>ü " * 30, "word " * 30_000, "hello world"]
    rows = [(i if i != 3 else None, t, "x") for i, t in enumerate(texts)] + [(0, "hello world", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, path string")
    words = T.Vocabulary(vocabulary, SPLIT)
    want = sorted((str(i), len(words.encode(t or ""))) for i, t, _ in rows)
    got = T.document_tokens(df, vocabulary, SPLIT).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == want
    assert T.document_tokens(df.limit(0), vocabulary, SPLIT).count() == 0


@pytest.mark.parametrize("width, dtype", [(2, "<u2"), (4, "<u4")])
@pytest.mark.parametrize("step", [1, 2, 3, 7, 1000])
def test_blocks_are_stitched(spark, tmp_path, width, dtype, step):
    rng = np.random.default_rng(step)
    want, files = {}, []
    for k, lengths in enumerate([[0], [3, 0, 0, 5, 1], rng.integers(0, 9, 40).tolist(), [], [25], [4, 2]]):
        data = [x for n in lengths for x in [*rng.integers(0, 9, n).tolist(), 9]]
        if k >= 4:
            data = data[:-1]  # the last document has no separator
        path = tmp_path / f"{k}.tok"
        path.write_bytes(np.array(data, dtype).tobytes())
        files.append((str(path),))
        want |= {(str(path), i): n for i, n in enumerate(lengths)}
    got = T.count_tokens_by(spark.createDataFrame(files, "path string"), 9, width, step * width).collect()
    assert {(r.path, r.ordinal): r.n_tokens for r in got} == want


def test_broken_file(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"abc")
    with pytest.raises(Exception, match="no multiple"):
        T.count_tokens(spark.createDataFrame([(str(tmp_path / "x"),)], "path string"), 9).collect()

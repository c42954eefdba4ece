"""Languages by error-correcting codes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rolodeck.llm import langid as L
from rolodeck.llm import queries


@pytest.mark.parametrize("k", [2, 3, 4, 6, 7, 20])
def test_codewords_are_apart(k):
    code = L.codewords(k)
    apart = [(code[i] != code[j]).sum() for i in range(k) for j in range(i)]
    assert set(np.unique(code)) == {-1, 1} and min(apart) >= max(1, code.shape[1] // 5)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", F.length("text").alias("n"))
    got = queries.op10_language(spark, folder).join(docs, "doc_id").filter("lang is not null and n >= 200")
    right = got.groupBy("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("share"), F.min("score").alias("low"), F.max("score").alias("high")).collect()
    assert len(right) == 2
    for r in right:
        assert r.share > 0.97 and 0 <= r.low <= r.high <= 1


def test_edges(spark):
    rows = [(1, "the cat and the dog sat on the mat", "en"), (2, "le chat et le chien sont là", "fr"), (3, "no language given", None), (4, None, "en"), (5, "", "fr"), (6, "123 !?", "en"), (7, "日本語", None), (None, "the dog", "en"), (1, "the cat", "en"), (8, "le chien " * 30_000, "fr")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, score_ int")
    model = L.train(df)
    assert model.languages == ["en", "fr"]
    got = L.identify(df, model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all((by[i].lang_pred, by[i].score) == ("und", 0.0) for i in (4, 5, 6))
    assert by[7].lang_pred in ("en", "fr") and by[8].lang_pred == "fr" and by[2].lang_pred == "fr" and not by[8].ambiguous
    none = L.train(df.limit(0))
    assert {r.lang_pred for r in L.identify(df, none).collect()} == {"und"}
    assert L.identify(df.limit(0), model).count() == 0
    with pytest.raises(ValueError):
        L.identify(df.withColumnRenamed("lang", "Score"), model)


def test_one_language(spark):
    df = spark.createDataFrame([("some words", "en")], "text string, lang string")
    assert L.Model.predict(L.train(df), b"words")[:2] == ("en", 1.0)


def plain_letters(text):
    out = [32]
    for c in text:
        c = c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32
        if c != 32 or out[-1] != 32:
            out.append(c)
    return out if out[-1] == 32 else [*out, 32]


def plain_grams(text):
    """Bigrams and trigrams one by one, each hashed into 13 bits."""
    x, counts = plain_letters(text), {}
    for i in range(len(x) - 1):
        two = x[i] * 257 + x[i + 1]
        places = [(two * 2654435761) % 2**32 >> 19]
        if i + 2 < len(x):
            places.append(((two * 263 + x[i + 2] + 0x10000) % 2**32 * 2246822519) % 2**32 >> 19)
        for p in places:
            counts[p] = counts.get(p, 0) + 1
    return counts


def plain_model(labelled):
    """(languages, classify): all splits of the languages, a log-odds classifier for each, and loss-weighted decoding, in plain loops."""
    import math

    totals = {}
    for text, lang in labelled:
        if text is not None and lang is not None:
            for g, n in plain_grams(text.encode()).items():
                totals.setdefault(lang, {})[g] = totals.get(lang, {}).get(g, 0) + n
    names = sorted(totals)
    share = [[(totals[n].get(g, 0) + 0.5) / (sum(totals[n].values()) + 0.5 * 8192) for g in range(8192)] for n in names]
    splits = [[0, *[bits >> i & 1 for i in range(len(names) - 1)]] for bits in range(2 ** (len(names) - 1) - 1)]
    splits = [[1, *s[1:]] for s in splits]
    trained = []
    for side in splits:
        mean = lambda want, g, side=side: sum(share[i][g] for i in range(len(names)) if side[i] == want) / sum(x == want for x in side)
        weights = [math.log(mean(1, g)) - math.log(mean(0, g)) for g in range(8192)]
        margins = [sum(p * w for p, w in zip(s, weights, strict=True)) for s in share]
        trained.append((side, weights, max(min(m if x else -m for m, x in zip(margins, side, strict=True)), 1e-6), 2 / max(sum(map(abs, margins)) / len(margins), 1e-9)))
    trust = sum(t for _, _, t, _ in trained)

    def classify(text):
        if text is None or not any(c.isalpha() for c in text):
            return "und", 0.0
        counts = plain_grams(text.encode())
        margin = [sum(n * w[g] for g, n in counts.items()) / sum(counts.values()) * scale for _, w, _, scale in trained]
        loss = [sum(4 * t / trust * math.exp(-m if side[i] else m) for (side, _, t, _), m in zip(trained, margin, strict=True)) for i in range(len(names))]
        best = min(range(len(names)), key=lambda i: loss[i])
        return names[best], 1 / sum(math.exp(loss[best] - x) for x in loss)

    return classify


def test_query_against_plain_version(spark, small):
    """op10 over a whole small table, its training rows, weights and decoding by a version in plain loops."""
    import zlib

    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in docs}
    classify = plain_model([(r.text, r.lang) for r in docs if not held[r.doc_id]])
    text = {r.doc_id: r.text for r in docs}
    got = queries.op10_language(spark, small).collect()
    assert len(got) == len(docs)
    for r in got:
        name, score = classify(text[r.doc_id])
        assert (r.held_out, r.lang_pred) == (held[r.doc_id], name) and r.score == pytest.approx(score, abs=1e-9)


def test_many_languages(spark):
    """All of 700 are known, and found again; a limit keeps those with most text, ties by name."""
    df = spark.createDataFrame([(f"{chr(0x4E00 + 7 * i)}{chr(0x4E00 + 7 * i + 3)} " * (300 + i % 5), f"l{i:03}") for i in range(700)], "text string, lang string")
    model = L.train(df)
    assert len(model.languages) == 700 and model.weights.shape == (L.DIMENSIONS, model.code.shape[1])
    got = L.identify(df.filter("lang like '%50'"), model).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.8 * len(got) and len(got) == 7
    few = spark.createDataFrame([("aa bb", "q"), ("aa bb", "b"), ("aa bb", "c"), ("aa bb cc dd", "z")], "text string, lang string")
    assert L.train(few, most=3).languages == ["b", "c", "z"]
    assert L.train(few).languages == ["b", "c", "q", "z"]


def test_drawn_codewords(monkeypatch):
    monkeypatch.setattr(L, "SEARCHED", 50)
    code = L.codewords(60)
    assert len({tuple(r) for r in code.tolist()}) == 60
    assert min((code[i] != code[j]).sum() for i in range(60) for j in range(i)) >= code.shape[1] // 5

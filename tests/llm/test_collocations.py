"""Collocations against plain counting."""

import random
import re
from collections import Counter

import pytest

from rolodeck.llm import collocations as C


def plain(rows, least=30, inside=80, top=2000, scale=2_000_000):
    """rows: (text, lang). The same table by whole texts and dictionaries."""
    count = Counter()
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    count[lang or "und", tuple(words[i : i + n])] += 1
    out = []
    for of in {k[0] for k in count}:
        total = sum(f for (x, w), f in count.items() if x == of and len(w) == 1)
        good = {w: f for (x, w), f in count.items() if x == of and len(w) > 1 and f >= least}
        most = Counter()
        for w, f in good.items():
            for n in range(2, len(w)):
                for i in range(len(w) - n + 1):
                    most[w[i : i + n]] = max(most[w[i : i + n]], f)
        kept = []
        for w, a in good.items():
            if 100 * most[w] >= inside * a:
                continue
            score, k = min((scale * a // (count[of, w[:k]] + count[of, w[k:]]), k) for k in range(1, len(w)))
            kept.append((-score, -a, " ".join(w).encode(), count[of, w[:k]], count[of, w[k:]]))
        out += [(of, i, p.decode(), -a, left, right, total, -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def found(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def rows(seed):
    rng = random.Random(seed)
    words = ["the", "of", "Ä", "ß", "naïve", "x", "\x00", "日本", "a%b", "_", "New", "york", "\xa0"] + [f"w{i}" for i in range(30)]
    out = []
    for _ in range(60):
        n = rng.choice([0, 1, 2, 3, 5, 40, 400])
        text = "".join(rng.choice(words[: rng.choice([4, 43])]) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "?!", " ; "]) for _ in range(n))
        out.append((text, rng.choice(["en", "en", "de", None, "und"])))
    return out + [(None, "en"), ("", None), (" .\n", "fr"), ("same same same same same " * 50, "en"), out[5], out[5]] + [out[7]] * 40


@pytest.mark.parametrize("seed, every, portion", [(1, 24, 4 << 20), (2, 1, 300), (3, 3, 60), (4, 10**9, 4 << 20)])
def test_against_plain_counting(spark, monkeypatch, seed, every, portion):
    """Chunks of many lengths, texts in portions, copies, odd words; null and empty texts and languages."""
    data = rows(seed)
    parse, portions = C.parse, C.portions
    monkeypatch.setattr(C, "PORTION", portion)
    chunks, of, last = parse([(t or "").encode() for t, _ in data], every)
    assert last.sum() == len(set(of.tolist()))
    assert all(b"".join(portions(t.encode(), portion)) == t.encode() for t, _ in data if t)
    docs = spark.createDataFrame(data, "text string, lang string").repartition(3)
    got = found(C.collocations(docs, least=4, top=50))
    assert got == plain(data, least=4, top=50)
    assert len(got) > 50


@pytest.mark.parametrize("every", [1, 2, 7, 24])
def test_each_place_counts_once(every):
    data = [t or "" for t, _ in rows(9)]
    chunks, of, last = C.parse([t.encode() for t in data], every)
    spans = C.Spans(chunks.to_pylist())
    count = Counter()
    for i, (chunk, end) in enumerate(zip(chunks.to_pylist(), last, strict=True)):
        n = len(re.findall(rb"[^ \n]+", chunk))
        for j in range(n if end else n - C.OVERLAP):
            at = spans.first[i] + j
            for k in range(1, min(4, spans.left[at]) + 1):
                count[spans.data[spans.starts[at] : spans.ends[at + k - 1]].tobytes()] += 1
    want = Counter()
    for text in data:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            for k in range(1, 5):
                want.update(" ".join(words[i : i + k]).encode() for i in range(len(words) - k + 1))
    assert count == want


def test_copies_share_chunks():
    rng = random.Random(3)
    passage = " ".join(f"p{rng.randrange(500)}" for _ in range(2000))
    one, _, _ = C.parse([passage.encode()])
    both, _, _ = C.parse([f"before this {passage}".encode(), f"{passage} and behind it".encode()])
    assert len(set(one.to_pylist()) & set(both.to_pylist())) >= len(one) - 2
    assert len(set(both.to_pylist())) <= len(one) + 4


def test_large_counts_stay_exact(spark, monkeypatch):
    """Products beyond 64 bits."""
    found = spark.createDataFrame([("en", "a b", 2, 8 * 10**18), ("en", "a", 1, 9 * 10**18), ("en", "b", 1, 9 * 10**18 - 1)], "lang string, phrase string, n_words int, f long")
    totals = spark.createDataFrame([("en", 5)], "lang string, n long")
    monkeypatch.setattr(C, "phrases", lambda *_: (found, totals))
    [row] = C.collocations(None).collect()
    assert row.score == 2_000_000 * 8 * 10**18 // (18 * 10**18 - 1)


def test_empty(spark):
    assert C.collocations(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0
    assert C.collocations(spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")).count() == 0

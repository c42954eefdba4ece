"""Language identification with error-correcting output codes.

Each language has a codeword of bits, far from all others. Each bit splits the languages in two, and a binary classifier over hashed byte n-grams (2 and
3 bytes of the text's letters) predicts it: a document's margin is the mean log-odds of its n-grams between the two sides. Decoding adds up, for each
codeword, an exponential loss of the margins against its bits, weighted by how reliable each bit's classifier is, and takes the codeword of least loss. A document whose two best
codewords are nearly as good is flagged ambiguous.

Training is one aggregation over all training documents (no sample): n-gram counts by language are summed inside tasks, then over tasks, into an array of DIMENSIONS numbers for each language. The driver reads these
arrays one by one and keeps the classifiers' sums only (DIMENSIONS x bits numbers; bits grow with the logarithm of the number of languages). All languages are learnt; ``most`` may limit them. Prediction is one narrow pass.

Defined results: a text that is null or has no letter is ``und`` with score 0; so is every text if there is nothing to learn from. Rows stay one for one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .util import binary, checkpointed, extended, text_slices

DIMENSIONS = 1 << 13
#: So many languages' counts are held by a task at a time (64 KB each).
HELD = 500
#: Beyond so many languages codewords are drawn with more bits and not searched for.
SEARCHED = 4_000
UNKNOWN = "und"
#: ASCII letters in lower case, bytes beyond ASCII as they are, all else a blank.
_LETTERS = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint8)


def has_letter(text: bytes) -> bool:
    """Whether a text has a letter of any script."""
    if any(65 <= c <= 90 or 97 <= c <= 122 for c in text[:256]):
        return True
    return any(ch.isalpha() for ch in text.decode())


def grams(text: bytes) -> np.ndarray:
    """How often each hashed n-gram occurs in a text's letters; runs of blanks count once."""
    letters = _LETTERS[np.frombuffer(b" " + text + b" ", np.uint8)]
    kept = np.ones(len(letters), bool)
    kept[1:] = (letters[1:] != 32) | (letters[:-1] != 32)
    letters = letters[kept]
    x = letters.astype(np.uint32)
    two = x[:-1] * np.uint32(257) + x[1:]
    three = two[:-1] * np.uint32(263) + x[2:]
    hashed = np.concatenate([two * np.uint32(2654435761), (three + np.uint32(0x10000)) * np.uint32(2246822519)]) >> np.uint32(19)
    return np.bincount(hashed, minlength=DIMENSIONS)


def codewords(k: int) -> np.ndarray:
    """k codewords of +1 and -1. Up to 6 languages: all splits (exhaustive codes); more: a seeded, greedy search for columns that keep rows apart; beyond SEARCHED: drawn, with bits enough for them to be far apart."""
    if k < 2:
        return np.ones((k, 1))
    if k <= 6:
        splits = np.arange((1 << (k - 1)) - 1)  # all bits set would be no split
        rows = [np.ones(len(splits), int), *[np.where(splits >> i & 1, 1, -1) for i in range(k - 1)]]
        return np.array(rows)
    bits = max(15, 4 * int(np.ceil(np.log2(k))))
    rng, code = np.random.default_rng(k), np.zeros((k, 0), int)
    if k > SEARCHED:
        return rng.choice([-1, 1], size=(k, 2 * bits))
    first, second = np.triu_indices(k, 1)
    apart = np.zeros(len(first), np.int16)
    for _ in range(bits):  # column by column: of fifty drawn ones the one that leaves the nearest rows farthest apart, and fewest of them so near
        best = None
        for c in rng.choice([-1, 1], size=(50, k)):
            if abs(c.sum()) == k:
                continue
            after = apart + (c[first] != c[second])
            nearest = int(after.min())
            worth = (nearest, -int((after == nearest).sum()))
            if best is None or worth > best[0]:
                best = (worth, c, after)
        code, apart = np.column_stack([code, best[1]]), best[2]
    return code


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # DIMENSIONS x bits: log-odds of an n-gram
    trust: np.ndarray  # of each bit
    scale: np.ndarray  # of each bit's margins

    def predict(self, text: bytes | None, close: float = 0.1) -> tuple[str, float, bool]:
        """(language, score from 0 to 1, ambiguous)."""
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, False
        counts = grams(text)
        margins = counts @ self.weights / max(1, counts.sum()) * self.scale
        loss = np.exp(-self.code * margins) @ self.trust
        order = np.argsort(loss, kind="stable")
        if len(order) == 1:
            return self.languages[order[0]], 1.0, False
        chance = np.exp(-(loss - loss[order[0]]))
        score = float(1 / chance.sum())
        return self.languages[order[0]], score, bool(loss[order[1]] - loss[order[0]] < close)


def count_grams(labelled: DataFrame, text: str, lang: str, most: int | None = None) -> DataFrame:
    """(lang, counts): each language's n-gram counts, DIMENSIONS longs as bytes; of more than ``most`` languages those with most n-grams, ties by name. A checkpointed table.

    Each task sums what it reads, some languages at a time; (language, n-gram) sums are shuffled, and those of a language become one row.
    """
    kinds = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).filter("lang is not null and text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def done() -> Iterator[pa.RecordBatch]:
            for name, counts in sums.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["lang", "gram", "n"])
            sums.clear()

        for batch in text_slices(batches, "text"):
            for name, t in zip(batch.column("lang").to_pylist(), binary(batch.column("text")), strict=True):
                sums[name] = sums[name] + grams(t) if name in sums else grams(t)
                if len(sums) > HELD:
                    yield from done()
        yield from done()

    def gather(rows: pa.Table) -> pa.Table:
        counts = np.zeros(DIMENSIONS, np.int64)
        counts[rows.column("gram").to_numpy()] = rows.column("n").to_numpy()
        return pa.table({"lang": rows.column("lang").slice(0, 1), "counts": pa.array([counts.tobytes()], pa.binary())})

    sums = kinds.mapInArrow(run, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    if most is not None:
        sums = checkpointed(sums)
        kept = sums.groupBy("lang").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "lang").limit(most)
        sums = sums.join(kept.select("lang"), "lang", "left_semi")
    return checkpointed(sums.groupBy("lang").applyInArrow(gather, "lang string, counts binary").orderBy("lang"))


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", most: int | None = None) -> Model:
    """A model from all labelled rows with a text and a language; most: of so many languages, those with most text."""
    found = count_grams(labelled, text, lang, most)
    names = [r.lang for r in found.select("lang").collect()]  # a name for each language; texts stay where they are
    code = codewords(len(names))
    if not names:
        return Model([], code, np.zeros((DIMENSIONS, 1)), np.ones(1), np.ones(1))

    def profiles() -> Iterator[np.ndarray]:
        """The languages' shares of n-grams, in order of their names, one at a time: each language counts alike, however many rows it has."""
        for row in found.toLocalIterator():
            counts = np.frombuffer(row.counts, np.int64)
            yield (counts + 0.5) / (counts.sum() + 0.5 * DIMENSIONS)

    sums = np.zeros((2, code.shape[1], DIMENSIONS))  # of both sides of each bit
    for own, profile in zip(code, profiles(), strict=True):
        sums[0, own > 0] += profile
        sums[1, own < 0] += profile
    plus, minus = (code > 0).sum(axis=0), (code < 0).sum(axis=0)
    split = (plus > 0) & (minus > 0)  # any other bit tells nothing
    weights = np.zeros((code.shape[1], DIMENSIONS))
    weights[split] = np.log(sums[0, split] / plus[split, None]) - np.log(sums[1, split] / minus[split, None])
    margins = np.array([weights @ profile for profile in profiles()])  # of a long text in each language
    least = np.maximum((margins * code).min(axis=0), 1e-6)  # a bit that separates its languages well is trusted more
    return Model(names, code, weights.T.copy(), least / least.sum() * 4, 2.0 / np.maximum(np.abs(margins).mean(axis=0), 1e-9))


def identify(docs: DataFrame, model: Model, text: str = "text", into: tuple[str, str, str] = ("lang_pred", "score", "ambiguous"), keep_text: bool = True) -> DataFrame:
    """docs, whatever its columns, and the predicted language, its score and whether it is ambiguous."""
    clash = {c.lower() for c in docs.columns} & {c.lower() for c in into}
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already; choose others with into=")
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in text_slices(batches, text):
            rows = [own.predict(t) for t in binary(batch.column(text))]
            kept = [i for i, c in enumerate(batch.schema.names) if keep_text or c != text]
            new = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.string(), pa.float64(), pa.bool_()), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *new], names=[*(batch.schema.names[i] for i in kept), *into])

    kinds = (T.StringType(), T.DoubleType(), T.BooleanType())
    return docs.mapInArrow(run, extended(docs if keep_text else docs.drop(text), [T.StructField(n, k) for n, k in zip(into, kinds, strict=True)]))

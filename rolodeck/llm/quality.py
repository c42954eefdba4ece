"""Quality rules with risk-controlled thresholds.

A document's *features* come from its whole text. Fixed base rules reject texts that are too short or repeat themselves. Beyond them, each of several
*signals* (see SIGNALS) is compared with a cutoff, and cutoffs are not guessed but certified on labelled documents:

* The signals' cutoffs move together over a fixed ladder of strictness, from lenient to strict, so that a stricter step rejects all that a more lenient one rejects.
* For each stratum (by default the language) and each step, the labelled good documents that pass the base rules are the holdout, and those that the step would
  reject are false rejections. The exact binomial tail P(X <= rejected | n, alpha) is the p-value of "this step rejects more than alpha of good documents".
* Steps are tested in order, from lenient to strict, until one fails (fixed-sequence testing needs no correction inside a stratum); over strata the level delta is
  divided by their number (Bonferroni). So with probability 1 - delta no stratum's chosen step rejects more than alpha of its good documents.
* Among a stratum's certified steps the one with the largest excess of labelled bad over labelled good rejections is chosen, the most lenient of equals: being stricter
  would risk good documents for little.

A stratum whose holdout can't certify any step, or that has no labels, rejects by base rules only.

The ladder and counts are aggregates in Spark: (stratum, strictest step that a document fails) is counted, a running sum gives each step's rejections, and the
table that decides has at most strata x steps rows. Documents are one narrow pass, twice: once for the labelled ones, once to apply the cutoffs.

The bound holds for independent draws, so the holdout is of distinct texts: of each stratum's labelled rows of one text, whatever their ids and labels, one counts, as good if any of its labels
says so. (Near copies still count as two.)

Defined results: a null or empty text has no words and fails the base rules. A null stratum is a stratum. Labels with null or unknown ids or null quality are ignored. Rows, repeated or not,
stay one for one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .util import binary, checkpointed, extended, free_prefix, fresh, text_or_empty, text_slices

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_exclaims")
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
#: Up to so many labels (16 bytes each) are told to all tasks, so that features are worked out for labelled documents only. With more, which are a good part of any corpus, features of all
#: documents are worked out and meet the labels without their texts: a join before would shuffle texts.
BROADCAST_LABELS = 1_000_000
#: The column with a hash of the text beside FEATURES.
CONTENT = "_text_hash"
#: Of each signal the value at which strictness 1 rejects.
SIGNALS = {"symbols per word": 0.25, "exclamation marks per word": 0.25, "capitals among letters": 0.5, "repeated lines": 0.4}
#: Steps of strictness, lenient to strict: a signal is rejected at its value above divided by the step.
LADDER = tuple(round(0.25 * 1.25**i, 4) for i in range(14))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of so many words that occur twice or more in the text, the first occurrence included.

    Equal windows have equal rolling hashes, so a text whose hashes all differ has none. In others, windows are compared exactly: runs of 1, 2, 4, 8 words are
    ranked, each from the ranks of its two halves, so memory stays in proportion to the words.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = np.zeros(n, np.uint64)
    for i in range(window):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
    rolled.sort()
    if not (rolled[1:] == rolled[:-1]).any():
        return 0
    seen: dict[bytes, int] = {}
    rank = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    length = 1
    while length < window:
        step = min(length, window - length)
        pair = rank[: len(words) - length - step + 1] * (int(rank.max()) + 1) + rank[step : len(words) - length + 1]
        _, rank = np.unique(pair, return_inverse=True)
        length += step
    starts = np.bincount(rank)[rank] > 1
    if not starts.any():
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(starts)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


_BLANKS = b" \t\n\x0b\x0c\r"
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_NO_CHARACTER = _BLANKS + bytes(range(0x80, 0xC0))  # a character of UTF-8 has one byte that is none of the latter


def _count(raw: bytes, of: bytes) -> int:
    return len(raw) - len(raw.translate(None, of))


def features(text: bytes | None) -> tuple[int, ...]:
    """FEATURES of one text."""
    raw = text or b""
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    chars = len(raw.translate(None, _NO_CHARACTER))
    return (len(words), chars, _count(raw, SYMBOLS), len(lines) - len(set(lines)), repeated_words(words), len(lines), _count(raw, _UPPER), _count(raw, _UPPER + _LOWER), raw.count(b"!"))


def with_features(docs: DataFrame, text: str = "text", prefix: str = "", keep_text: bool = True) -> DataFrame:
    """docs, whatever its columns, and FEATURES as longs, named with prefix."""
    names = [prefix + x for x in FEATURES]
    clash = {c.lower() for c in docs.columns} & {c.lower() for c in names}
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already; choose a prefix=")
    base = docs if keep_text else docs.drop(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text):
            rows = [features(t) for t in binary(batch.column(text))]
            new = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            kept = [i for i, c in enumerate(batch.schema.names) if keep_text or c != text]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *new], names=[*(batch.schema.names[i] for i in kept), *names])

    return docs.mapInArrow(run, extended(base, [T.StructField(n, T.LongType()) for n in names]))


def base_failed(prefix: str = "") -> Column:
    n = F.col(f"{prefix}n_words")
    return (n < 20) | (100 * F.col(f"{prefix}n_repeat_words") > 30 * n)


def strictness(prefix: str = "") -> Column:
    """The smallest strictness that rejects a document: what its strongest signal reaches of its value in SIGNALS, upside down. Null: none does."""
    c = lambda x: F.col(prefix + x).cast("double")
    share = {
        "symbols per word": F.try_divide(c("n_symbols"), c("n_words")),
        "exclamation marks per word": F.try_divide(c("n_exclaims"), c("n_words")),
        "capitals among letters": F.try_divide(c("n_upper"), c("n_letters")),
        "repeated lines": F.try_divide(c("n_dup_lines"), c("n_lines")),
    }
    strongest = F.greatest(*[F.coalesce(share[k], F.lit(0.0)) / F.lit(v) for k, v in SIGNALS.items()])
    return F.try_divide(F.lit(1.0), strongest)


def step_of(strict: Column) -> Column:
    """The first step of LADDER that rejects such a document; one beyond the last if none does."""
    return sum((F.when(strict > F.lit(x), 1).otherwise(F.when(strict.isNull(), 1).otherwise(0)) for x in LADDER), F.lit(0))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial X, exact up to rounding."""
    if n == 0 or k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def certified_steps(holdout: DataFrame, alpha: float, delta: float) -> DataFrame:
    """(stratum, step, n_good): the chosen step, null where none is certified. holdout: stratum, quality, step (first step that rejects)."""
    counts = checkpointed(holdout.groupBy("stratum", "step").agg(F.sum(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.sum(F.when(F.col("quality") == 0, 1).otherwise(0)).alias("bad")))
    strata = max(1, counts.select("stratum").distinct().count())
    ladder = counts.select("stratum").distinct().withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(len(LADDER)))))
    full = ladder.join(counts.withColumnsRenamed({"stratum": "s_", "step": "t_"}), F.col("stratum").eqNullSafe(F.col("s_")) & (F.col("step") == F.col("t_")), "left")
    rising, whole = Window.partitionBy("stratum").orderBy("step"), Window.partitionBy("stratum")
    g, b = F.coalesce("good", F.lit(0)), F.coalesce("bad", F.lit(0))
    sums = full.select("stratum", "step", F.sum(g).over(rising).alias("rejected"), F.sum(b).over(rising).alias("caught"), F.sum(g).over(whole).alias("n")).filter(F.col("step") < len(LADDER))

    @F.pandas_udf("double")
    def p_value(k: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([binomial_tail(int(a), int(b), alpha) for a, b in zip(k, n, strict=True)])

    tested = sums.withColumn("p", p_value("rejected", "n")).withColumn("failed", F.max((F.col("p") > F.lit(delta / strata)).cast("int")).over(rising))
    tested = tested.withColumn("gain", F.when(F.col("failed") == 0, F.col("caught") - F.col("rejected")))
    best = tested.withColumn("most", F.max("gain").over(whole))
    chosen = F.min(F.when((F.col("gain") == F.col("most")) & (F.col("most") > 0), F.col("step")))
    return best.groupBy("stratum").agg(chosen.alias("cut"), F.max("n").alias("n_good"))


def choose_cutoffs(docs: DataFrame, labels: DataFrame, stratum: str = "lang", id: str = "doc_id", text: str = "text", quality: str = "quality", alpha: float = 0.01, delta: float = 0.05, featured: DataFrame | None = None) -> DataFrame:
    """(stratum, cut, n_good), one row for each stratum with labels; docs' labelled rows are the holdout.

    featured: columns id, stratum, CONTENT and FEATURES of docs, if they are worked out already.
    """
    # One label for each id, so that no join multiplies rows.
    marks = checkpointed(labels.filter(F.col(id).isNotNull() & F.col(quality).isin(0, 1)).groupBy(F.col(id).alias("label_id")).agg(F.max(quality).alias("quality")))
    if featured is None:
        ids = docs.select(F.col(id).alias("id"), F.col(stratum).alias("stratum"), F.col(text).cast("string").alias("text"), F.xxhash64(text_or_empty(F.col(text))).alias(CONTENT))
        if marks.count() <= BROADCAST_LABELS:
            ids = ids.join(F.broadcast(marks.select("label_id")), F.col("id") == F.col("label_id"), "left_semi")
        featured = with_features(ids, "text", keep_text=False)
    else:
        featured = featured.select(F.col(id).alias("id"), F.col(stratum).alias("stratum"), CONTENT, *FEATURES)
    scored = featured.filter(~base_failed()).select("id", "stratum", CONTENT, step_of(strictness()).alias("step"))
    labelled = scored.join(marks, F.col("id") == F.col("label_id")).groupBy("stratum", CONTENT).agg(F.max("quality").alias("quality"), F.min("step").alias("step"))
    return certified_steps(labelled, alpha, delta)


def judged(featured: DataFrame, cutoffs: DataFrame, stratum: str = "lang", prefix: str = "", into: tuple[str, str] = ("base_failed", "kept")) -> DataFrame:
    """featured (any columns, and FEATURES with prefix) and ``base_failed`` and ``kept``.

    The cutoffs have one row for each stratum with labels; up to a bound they are broadcast.
    """
    of, cut = fresh(featured.columns, "_of"), fresh(featured.columns, "_cut")
    small = cutoffs.filter("cut is not null").select(F.col("stratum").alias(of), F.col("cut").alias(cut))
    if small.count() <= 10_000:
        small = F.broadcast(small)
    joined = featured.join(small, F.col(stratum).eqNullSafe(F.col(of)), "left")
    rejected = F.coalesce(step_of(strictness(prefix)) <= F.col(cut), F.lit(False))
    return joined.withColumns({into[0]: base_failed(prefix), into[1]: ~base_failed(prefix) & ~rejected}).drop(of, cut)


def quality_verdicts(docs: DataFrame, labels: DataFrame, stratum: str = "lang", id: str = "doc_id", text: str = "text", alpha: float = 0.01, delta: float = 0.05) -> DataFrame:
    """One row for each document: id, stratum, FEATURES, base_failed, kept. Texts are read once; the features are kept by a checkpoint."""
    content = F.xxhash64(text_or_empty(F.col(text))).alias(CONTENT)
    featured = checkpointed(with_features(docs.select(F.col(id), F.col(stratum), F.col(text).cast("string").alias(text), content), text, keep_text=False))
    cutoffs = checkpointed(choose_cutoffs(docs, labels, stratum, id, text, alpha=alpha, delta=delta, featured=featured))
    return judged(featured.drop(CONTENT), cutoffs, stratum)


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", id: str = "doc_id", text: str = "text", alpha: float = 0.01, delta: float = 0.05) -> DataFrame:
    """docs without the rows that the rules reject. The documents themselves are never shuffled."""
    cutoffs = checkpointed(choose_cutoffs(docs, labels, stratum, id, text, alpha=alpha, delta=delta))
    prefix = free_prefix(docs.columns, "_q_")
    verdicts = judged(with_features(docs, text, prefix), cutoffs, stratum, prefix, (f"{prefix}base", f"{prefix}kept"))
    return verdicts.filter(F.col(f"{prefix}kept")).select(*docs.columns)

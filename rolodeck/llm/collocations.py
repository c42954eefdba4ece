"""Phrase collocations, counted by prefix-free parsing.

Texts are lower-cased (A-Z), split at sentence marks into pieces and these at blanks into words. Everything is counted per language. How, without ever shuffling a row for each place of a phrase:

1. *Parse.* A text's words are cut into chunks: a chunk ends where the hash of its last ``OVERLAP`` words is 0 modulo ``EVERY``, and the next chunk begins with these words again. The same passage gives the
   same chunks wherever it stands, so that copies fall together in a *dictionary* of distinct chunks with frequencies, made by an aggregation that combines before it shuffles.
2. *Count.* N-grams are counted inside distinct chunks, weighted by the chunk's frequency. What starts within the last OVERLAP words of a chunk belongs to the next chunk, which has it too; only a text's last chunk
   counts these places itself. So each place counts once.
3. *Prune.* A phrase that occurs ``least`` times has only parts that do. Words are counted first, then pairs of frequent words, then phrases of three and four words all of whose pairs are frequent. Tasks know what is frequent
   from a Bloom filter of fixed size (``FILTER_BITS``), whatever the corpus; it lets more pass than it should, never less, and what passes is counted exactly. When a corpus has far more frequent pairs than the filter has
   bits, nothing is pruned any more and the last pass shuffles more; results are the same.
4. Scores, containment and ranking are joins, aggregations and one sort over candidates only, in whole numbers and decimals.

Defined results: null texts are empty; a text without words adds nothing. A null language is ``und``. Repeated rows count each time. ids and other columns are not looked at. An empty table gives an empty result. Texts of over
``PORTION`` bytes are parsed in portions cut at sentence marks, which no phrase crosses.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import numbered
from .util import binary, checkpointed, filesystem, join_hot, new_folder, text_slices

LONGEST = 4
#: Words that neighbouring chunks share: all but one of the longest phrase.
OVERLAP = LONGEST - 1
#: One of so many places ends a chunk.
EVERY = 24
#: Bytes of text or chunks that are looked at together.
PORTION = 4 << 20
FILTER_BITS = 1 << 25
#: Hash functions of the filter.
PROBES = 3

_BREAK, _BLANK = 10, 32
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 0: part of a word; 1: a blank; 2: a mark between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 32]] = 1
_KIND[[*b".,;:!?\n\v\f\r"]] = 2


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word data[start:end], by differences of one running sum over all bytes."""
    powers = np.empty(len(data) + 1, np.uint64)
    powers[0] = 1
    powers[1:] = _BASE
    np.multiply.accumulate(powers, out=powers)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
    back = np.uint64(pow(int(_BASE), -1, 1 << 64))
    undo = np.empty(len(data) + 1, np.uint64)
    undo[0] = 1
    undo[1:] = back
    np.multiply.accumulate(undo, out=undo)
    return _mixed((sums[ends] - sums[starts]) * undo[starts] + (ends - starts).astype(np.uint64))


def phrase_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of the n words that start at each place but the last n - 1."""
    out = words[: max(0, len(words) - n + 1)]
    for i in range(1, n):
        out = _mixed(out * np.uint64(3) + words[i : len(words) - n + 1 + i])
    return out


def gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """data[start:end] for each pair, as Arrow binary."""
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at])])


def portions(text: bytes, most: int = PORTION) -> Iterator[bytes]:
    """The text in parts of about ``most`` bytes, cut behind marks between pieces; a text without such marks stays whole."""
    import re

    mark, at = re.compile(rb"[.,;:!?\x0A-\x0D]"), 0
    while len(text) - at > most and (m := mark.search(text, at + most)):
        yield text[at : m.end()]
        at = m.end()
    yield text[at:] if at else text


def parse(texts: list[bytes], every: int = EVERY) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(chunk, number of its text, whether it is the text's last) of all texts. In chunks a blank stands between words, a line feed between pieces."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    raw = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    kind = _KIND[raw]
    inside = kind == 0
    before = np.concatenate([[False], inside[:-1]])
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(~inside & before)
    if not len(starts):
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64), np.zeros(0, bool)
    marks = np.concatenate([[0], np.cumsum(kind == 2)])
    behind = np.append(starts[1:], len(raw))
    raw = raw.copy()
    raw[ends] = np.where(marks[behind] > marks[ends], _BREAK, _BLANK)
    data = raw[inside | before]  # each word, and one byte behind it
    length = ends - starts
    last_at = np.cumsum(length + 1) - 1
    first_at = last_at - length
    hashes = word_hashes(data, first_at, last_at)
    of = np.searchsorted(np.cumsum(sizes), starts, "right")
    final = np.append(of[1:] != of[:-1], True)
    trigger = np.zeros(len(starts), bool)
    if len(starts) >= OVERLAP:
        trigger[OVERLAP - 1 :] = (phrase_hashes(hashes, OVERLAP) % np.uint64(every) == 0) & (of[OVERLAP - 1 :] == of[: len(of) - OVERLAP + 1])
    stop = np.flatnonzero(trigger | final)
    of, final = of[stop], final[stop]
    begin = np.append(0, stop[:-1] - OVERLAP + 1)
    begin[1:] = np.where(final[:-1], stop[:-1] + 1, begin[1:])
    return gathered(data, first_at[begin], last_at[stop]), of, final


def dictionary(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, chunk, last, freq): the distinct chunks of all texts and how often each occurs."""
    d = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text")).filter(F.col("text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", PORTION):
            parts = [(i, p) for i, t in enumerate(binary(batch.column("text"))) for p in portions(t)]
            at = 0
            while at < len(parts):  # several at once, or one long one
                end, held = at, 0
                while end < len(parts) and (end == at or held + len(parts[end][1]) <= PORTION):
                    held, end = held + len(parts[end][1]), end + 1
                chunk, of, final = parse([p for _, p in parts[at:end]])
                row = pa.array(np.fromiter((i for i, _ in parts[at:end]), np.int64, end - at)[of])
                if len(of):
                    yield pa.RecordBatch.from_arrays([batch.column("lang").take(row), chunk.cast(pa.binary()), pa.array(final)], names=["lang", "chunk", "last"])
                at = end

    return d.mapInArrow(run, "lang string, chunk binary, last boolean").groupBy("lang", "chunk", "last").agg(F.count(F.lit(1)).alias("freq"))


class Frequent:
    """A Bloom filter of phrases, as 64-bit words."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for i in range(PROBES):
            bit = _mixed(hashes + np.uint64(i)) % np.uint64(FILTER_BITS)
            out &= (self.words[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        return out


def _keyed(lang: list[str | None], hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Hashes that depend on the language too."""
    salt = word_salts(lang)
    return _mixed(hashes ^ salt[of])


def word_salts(lang: list[str | None]) -> np.ndarray:
    import xxhash

    known: dict[str | None, int] = {}
    return np.fromiter((known[x] if x in known else known.setdefault(x, xxhash.xxh64_intdigest(x or "")) for x in lang), np.uint64, len(lang))


def frequent(phrases: DataFrame) -> Frequent:
    """The filter of (lang, phrase) rows. Its words, at most FILTER_BITS / 64 rows whatever the phrases' number, are the only rows that the driver sees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            spans = Spans(binary(batch.column("phrase")))
            n = np.diff(np.append(spans.first, len(spans.starts)))
            hashes = np.empty(batch.num_rows, np.uint64)
            for k in np.unique(n):
                rows = n == k
                hashes[rows] = phrase_hashes(spans.hashes, int(k))[spans.first[rows]]
            hashes = _keyed(batch.column("lang").to_pylist(), hashes, np.arange(batch.num_rows))
            bit = np.unique(np.concatenate([_mixed(hashes + np.uint64(i)) % np.uint64(FILTER_BITS) for i in range(PROBES)]))
            at = (bit >> np.uint64(6)).astype(np.int64)
            new = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            word = np.bitwise_or.reduceat(np.uint64(1) << (bit & np.uint64(63)), new)
            yield pa.RecordBatch.from_arrays([pa.array(at[new]), pa.array(word.view(np.int64))], names=["at", "word"])

    set_ = phrases.select("lang", "phrase").mapInArrow(run, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    words = np.zeros(FILTER_BITS // 64, np.uint64)
    words[set_.column("at").to_numpy()] = set_.column("word").to_numpy().view(np.uint64)
    return Frequent(words)


class Spans:
    """The words of chunks: where they lie, their hashes, and how many words follow each within its piece."""

    def __init__(self, chunks: list[bytes]):
        self.data = np.frombuffer(b"\n".join(chunks) + b"\n", np.uint8)
        self.ends = np.flatnonzero((self.data == _BREAK) | (self.data == _BLANK))
        self.starts = np.append(0, self.ends[:-1] + 1)
        sizes = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)) + 1)
        self.of = np.searchsorted(sizes, self.starts, "right")
        #: The number of each chunk's first word.
        self.first = np.searchsorted(self.of, np.arange(len(chunks)))
        self.hashes = word_hashes(self.data, self.starts, self.ends)
        stop = np.flatnonzero(self.data[self.ends] == _BREAK)
        self.left = stop[np.searchsorted(stop, np.arange(len(self.starts)))] - np.arange(len(self.starts)) + 1


def counted(chunks: DataFrame, lengths: tuple[int, ...], known: Frequent | None, part: int) -> DataFrame:
    """(lang, phrase, n_words, f): weighted counts of the phrases with so many words, all of whose parts of ``part`` words are known to be frequent (None: of all)."""
    shared = chunks.sparkSession.sparkContext.broadcast(known.words) if known else None

    def count(table: pa.Table) -> Iterator[pa.RecordBatch]:
        spans = Spans(binary(table.column("chunk")))
        places = np.arange(len(spans.starts))
        beyond = np.append(spans.first[1:], len(places))[spans.of]
        own = table.column("last").to_numpy(zero_copy_only=False)[spans.of] | (places < beyond - OVERLAP)
        weight = table.column("freq").to_numpy()[spans.of]
        langs = table.column("lang").combine_chunks().dictionary_encode()
        lang = langs.indices.to_numpy()[spans.of].astype(np.int64)
        words = gathered(spans.data, spans.starts, spans.ends).dictionary_encode()
        word = words.indices.to_numpy().astype(np.int64)
        size = len(words.dictionary)
        if shared is not None:
            good = np.zeros(len(places), bool)
            good[: len(places) - part + 1] = Frequent(shared.value).has(_keyed(langs.dictionary.to_pylist(), phrase_hashes(spans.hashes, part), lang[: len(places) - part + 1]))
        at, key = places, lang * size + word  # exact numbers of the phrases that start at these places
        for n in range(1, max(lengths) + 1):
            if n > 1:
                at_, keep = at, spans.left[at] >= n
                if shared is not None and n >= part:
                    keep &= good[np.minimum(at + n - part, len(places) - 1)]
                at, key = at_[keep], key[keep]
                key = np.unique(key, return_inverse=True)[1] * size + word[at + n - 1]
            if shared is not None and n == 1 and part == 1:
                at, key = at[good], key[good]
            if n not in lengths:
                continue
            mine = own[at]
            a, k = at[mine], key[mine]
            if not len(a):
                continue
            _, one, group = np.unique(k, return_index=True, return_inverse=True)
            f = np.zeros(len(one), np.int64)
            np.add.at(f, group, weight[a])
            one = a[one]
            phrase = gathered(spans.data, spans.starts[one], spans.ends[one + n - 1])
            yield pa.RecordBatch.from_arrays([langs.dictionary.take(pa.array(lang[one])), phrase.cast(pa.binary()), pa.array(np.full(len(one), n, np.int32)), pa.array(f)], names=["lang", "phrase", "n_words", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            if size >= PORTION:
                yield from count(pa.Table.from_batches(held))
                held, size = [], 0
        if held:
            yield from count(pa.Table.from_batches(held))

    found = chunks.mapInArrow(run, "lang string, phrase binary, n_words int, f long")
    return found.groupBy("lang", "phrase", "n_words").agg(F.sum("f").alias("f"))


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n_words, f) of words and phrases of up to four words that occur at least so often, and (lang, n), the number of all words. Both are checkpointed."""
    folder = new_folder(docs.sparkSession, "chunks")
    files, inner = filesystem(folder)
    try:
        dictionary(docs, text, lang).write.parquet(folder)  # read three times; gone when all is counted
        chunks = docs.sparkSession.read.parquet(folder)
        words = checkpointed(counted(chunks, (1,), None, 1))
        totals = checkpointed(words.groupBy("lang").agg(F.sum("f").alias("n")))
        often = F.col("f") >= least
        words = words.filter(often)
        pairs = checkpointed(counted(chunks, (2,), frequent(words), 1).filter(often))
        longer = counted(chunks, tuple(range(3, LONGEST + 1)), frequent(pairs), 2).filter(often)
        found = checkpointed(words.unionByName(pairs).unionByName(longer).withColumn("phrase", F.col("phrase").cast("string")))
    finally:
        files.delete_dir(inner)
    return found, totals


def _parts(first: int, n: int):
    return F.array_join(F.slice("words", first, n), " ")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, inside: int = 80, top: int = 2000, scale: int = 2_000_000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of two to four words.

    a: the phrase's occurrences, at least ``least``; l and r: those of its two parts at the cut that gives the lowest score, the first such cut; score: scale * a / (l + r), rounded down. A phrase that a longer candidate
    contains is dropped if that has at least ``inside`` percent of its occurrences. Rank by score, occurrences, and the phrase's bytes.
    """
    found, totals = phrases(docs, text, lang, least)
    candidates = found.filter("n_words > 1").select("lang", "phrase", "n_words", F.col("f").alias("a"), F.split("phrase", " ", -1).alias("words"))
    f = found.select(F.col("lang").alias("lang_"), F.col("phrase").alias("part"), F.col("f").alias("f_"))
    cuts = candidates.select("lang", "phrase", "a", "words", "n_words", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"))

    def frequency(df: DataFrame, part, into: str) -> DataFrame:
        asked = df.withColumn("asked", part)
        return asked.join(f, (F.col("lang") == F.col("lang_")) & (F.col("asked") == F.col("part"))).withColumn(into, F.col("f_")).drop("asked", "lang_", "part", "f_")

    both = frequency(frequency(cuts, F.array_join(F.slice("words", F.lit(1), F.col("k")), " "), "l"), F.array_join(F.slice("words", F.col("k") + 1, F.col("n_words") - F.col("k")), " "), "r")
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    scored = both.withColumn("top_", F.lit(scale).cast("decimal(18,0)") * exact("a")).withColumn("low_", exact("l") + exact("r")).withColumn("score", F.expr("top_ div low_"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    spans = [(i, n) for n in range(2, LONGEST) for i in range(1, LONGEST - n + 2)]  # of parts with two words or more, by their place
    parts = F.array(*[F.when(F.lit(i + n - 1) <= F.col("n_words"), _parts(i, n)) for i, n in spans])
    within = candidates.filter("n_words > 2").select("lang", "phrase", "a", F.explode(F.array_compact(parts)).alias("part")).filter("part <> phrase")
    covered = within.groupBy(F.col("lang").alias("lang_"), "part").agg(F.max("a").alias("most"))
    dropped = covered.withColumn("most_", F.col("most").cast("decimal(19,0)") * 100)
    kept = best.join(dropped, (F.col("lang") == F.col("lang_")) & (F.col("phrase") == F.col("part")), "left").filter(F.col("most_").isNull() | (F.col("most_") < exact("a") * inside))
    # Numbered by ranges of one order over all languages, each from its first number on: no task sees a language's candidates together.
    order = [F.col("lang"), F.desc("score"), F.desc("a"), F.col("phrase")]
    every = checkpointed(numbered(kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), order, "place"))
    starts = checkpointed(every.groupBy("lang").agg((F.min("place") - 1).alias("start"), F.count(F.lit(1)).alias("weight")).join(totals, "lang").withColumnRenamed("lang", "lang_"))
    ranked = join_hot(every, starts, ("lang", "lang_"), "weight", every.count()).withColumn("rank", F.col("place") - F.col("start")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

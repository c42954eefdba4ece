"""Benchmark decontamination: Wu-Manber multi-pattern search for benchmark passages, word by word.

A benchmark item's windows of ``width`` consecutive words are the patterns; an item of fewer words is one pattern. Patterns of equal length form one
searcher. With m its patterns' length and a block of two consecutive words, the searcher holds

* a block shift table: for each block of a pattern the distance from the block's last occurrence in any pattern to the pattern's end; a block that
  no pattern has lets the search skip m - 1 words at once,
* suffix-hash buckets: for a block with shift 0 the patterns that end with it,
* and it compares each such pattern with the text's words directly, so a hit is always a true occurrence.

The benchmark's patterns are compiled on the driver in blocks of at most ``most_words`` words (some 100 MB of tables) and broadcast; the documents are one narrow pass with no shuffle. A
larger benchmark is kept as files of such blocks in the shared folder: a task takes some documents, reads and compiles one block after another, and adds up what each finds. So it is one narrow pass whatever the benchmark's size,
no document is written or shuffled, and no task ever holds more than one block's tables and ``HELD`` bytes of text. The files stay there, for the result may be worked out again.

Defined results: a null, empty or word-less text has no words and no hits; items without words are ignored; an item with a null id marks words but is
not listed; items with equal ids count once. Rows, repeated or not, stay one for one. An empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .util import binary, extended, filesystem, new_folder, text_slices

#: Bytes of text that a task searches for one block after another.
HELD = 64 << 20
#: Bytes of words: digits, a-z after lower-casing A-Z, and all beyond ASCII; others are blanks.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: The same for Spark, on lower-cased text.
PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORDS).split()


class WuManber:
    """Patterns of one length m: {words: item ids}."""

    def __init__(self, patterns: dict[tuple[bytes, ...], set[str]]):
        self.m = len(next(iter(patterns)))
        self.items = patterns
        block = min(2, self.m)
        self.shift: dict = {}
        self.bucket: dict = {}
        for pattern in patterns:
            for end in range(block, self.m + 1):
                key = pattern[end - 2 : end] if block == 2 else pattern[0]
                self.shift[key] = min(self.shift.get(key, self.m), self.m - end)
            self.bucket.setdefault(key, []).append(pattern)

    def search(self, words: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        """(start, items) of each occurrence."""
        m, n, shift, bucket, items = self.m, len(words), self.shift, self.bucket, self.items
        if m == 1:
            for i, w in enumerate(words):
                if w in shift:
                    yield i, items[(w,)]
            return
        i, skip = m - 1, m - 1
        while i < n:
            key = (words[i - 1], words[i])
            step = shift.get(key, skip)
            if step:
                i += step
                continue
            start = i - m + 1
            for pattern in bucket[key]:
                if words[start] == pattern[0] and tuple(words[start : i + 1]) == pattern:
                    yield start, items[pattern]
                    break  # patterns are distinct
            i += 1


def compile_patterns(windows: list[tuple[tuple[bytes, ...], str | None]]) -> list[WuManber]:
    by_length: dict[int, dict] = {}
    for pattern, item in windows:
        if pattern:
            by_length.setdefault(len(pattern), {}).setdefault(pattern, set()).update(() if item is None else (item,))
    return [WuManber(p) for _, p in sorted(by_length.items())]


def item_windows(text: bytes | None, width: int) -> list[tuple[bytes, ...]]:
    words = words_of(text)
    return [tuple(words[i : i + width]) for i in range(len(words) - width + 1)] or ([tuple(words)] if words else [])


def _blocks(benchmark: DataFrame, id: str, text: str, most_words: int) -> list[DataFrame]:
    """The benchmark in parts of about most_words words each at most, or single items."""
    items = benchmark.select(F.col(id).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    words = items.agg(F.sum(F.regexp_count(F.lower("text"), F.lit(PATTERN)).cast("long"))).first()[0] or 0
    parts = -(-2 * words // most_words)
    if words <= most_words:
        return [items] if words else []
    return [items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == k) for k in range(parts)]


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = 13, share: tuple[int, int] = (1, 20), most_words: int = 1_000_000, prefix: str = "", keep_text: bool = True) -> DataFrame:
    """docs, whatever its columns, and n_words, n_hit, n_items (long), items_sha256 (string), contaminated (boolean).

    contaminated: at least one word is hit, and hits are at least share[0] / share[1] of the words. prefix: put before the new columns'
    names. keep_text: whether the result has the text.
    """
    names = [prefix + x for x in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")]
    clash = {c.lower() for c in docs.columns} & {c.lower() for c in names}
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already; choose a prefix=")
    parts = _blocks(benchmark, item_id, item_text, most_words)
    if len(parts) > 1:
        searchers = _Files(docs.sparkSession, parts, width)
    else:
        windows = [w for part in parts for r in part.toLocalIterator() for w in _windows([(r.item, (r.text or "").encode())], width)]
        searchers = _Shared(docs.sparkSession, compile_patterns(windows))
    kinds = (T.LongType(), T.LongType(), T.LongType(), T.StringType(), T.BooleanType())
    schema = extended(docs if keep_text else docs.drop(text), [T.StructField(n, t) for n, t in zip(names, kinds, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _together(text_slices(batches, text), text, HELD if searchers.several else 0):
            found = [_Hits() for batch in held for _ in range(batch.num_rows)]
            for block in searchers.blocks():
                rows = iter(found)
                for batch in held:
                    for t in binary(batch.column(text)):
                        next(rows).add(words_of(t), block)
            rows = iter(found)
            for batch in held:
                new = [next(rows).result(share) for _ in range(batch.num_rows)]
                columns = [pa.array(c, k) for c, k in zip(zip(*new, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()), strict=True)]
                kept = [i for i, c in enumerate(batch.schema.names) if keep_text or c != text]
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *columns], names=schema.names)

    return docs.mapInArrow(run, schema)


class _Hits:
    """What is found in one text: a mark for each word that is hit, and items."""

    def __init__(self):
        self.n, self.mark, self.ids = 0, None, set()

    def add(self, words: list[bytes], searchers: list[WuManber]) -> None:
        self.n = len(words)
        for s in searchers:
            for start, named in s.search(words):
                if self.mark is None:
                    self.mark = np.zeros(self.n, bool)
                self.mark[start : start + s.m] = True
                self.ids |= named

    def result(self, share: tuple[int, int]) -> tuple[int, int, int, str, bool]:
        n_hit = 0 if self.mark is None else int(self.mark.sum())
        return self.n, n_hit, len(self.ids), hashlib.sha256(",".join(sorted(self.ids)).encode()).hexdigest(), n_hit > 0 and n_hit * share[1] >= self.n * share[0]


def _windows(items: list[tuple[str | None, bytes]], width: int) -> list[tuple[tuple[bytes, ...], str | None]]:
    return [(w, item) for item, text in items for w in item_windows(text, width)]


def _together(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in lists of about ``most`` bytes of text."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(text).nbytes
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


class _Shared:
    """Searchers of one block, told to all tasks."""

    several = False

    def __init__(self, spark, searchers: list[WuManber]):
        self.told = spark.sparkContext.broadcast(searchers)

    def blocks(self) -> Iterator[list[WuManber]]:
        yield self.told.value


class _Files:
    """Blocks of a benchmark as files in the shared folder, compiled where they are used."""

    several = True

    def __init__(self, spark, parts: list[DataFrame], width: int):
        folder = new_folder(spark, "benchmark")
        self.width, self.paths = width, [f"{folder}/{k}" for k in range(len(parts))]
        files, inner = filesystem(folder)
        files.create_dir(inner)
        for path, part in zip(self.paths, parts, strict=True):
            with files.open_output_stream(filesystem(path)[1]) as out:
                rows = [(r.item, (r.text or "").encode()) for r in part.toLocalIterator()]
                items = pa.table({"item": pa.array([i for i, _ in rows], pa.string()), "text": pa.array([t for _, t in rows], pa.binary())})
                with pa.ipc.new_stream(out, items.schema) as writer:
                    writer.write_table(items)

    def blocks(self) -> Iterator[list[WuManber]]:
        for path in self.paths:
            files, inner = filesystem(path)
            with files.open_input_stream(inner) as found:
                items = pa.ipc.open_stream(found).read_all()
            yield compile_patterns(_windows(list(zip(items.column("item").to_pylist(), items.column("text").to_pylist(), strict=True)), self.width))

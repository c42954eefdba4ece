"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..cluster import checkpointed, filesystem, fresh, join_hot, shared_folder

__all__ = ["KeyFilter", "WORD", "binary", "checkpointed", "extended", "filesystem", "free_prefix", "fresh", "join_hot", "new_folder", "shared_folder", "spread", "table", "text_or_empty", "text_slices"]

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def free_prefix(columns: Iterable[str], base: str) -> str:
    """A prefix that starts with base and that none of columns starts with."""
    prefix, names = base, [c.lower() for c in columns]
    while any(c.startswith(prefix) for c in names):
        prefix += "_"
    return prefix


def new_folder(spark: SparkSession, kind: str) -> str:
    """A path, not used before, for files of one run inside the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def binary(column: pa.ChunkedArray | pa.Array) -> list:
    """The UTF-8 bytes of a string column; null stays None."""
    return column.cast(pa.large_binary()).to_pylist()


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 32 << 20) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a slice holds about ``most`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column)
        if texts.nbytes <= most:
            yield batch
            continue
        import pyarrow.compute as pc

        start, held = 0, 0
        for i, n in enumerate(pc.binary_length(texts.cast(pa.large_binary())).to_pylist()):
            if i > start and held + (n or 0) > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        yield batch.slice(start)


def extended(df: DataFrame, fields: list[T.StructField]) -> T.StructType:
    """df's schema and the fields after it."""
    return T.StructType([*df.schema.fields, *fields])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class KeyFilter:
    """A Bloom filter of 64-bit keys, of a fixed number of bits: it may let a key pass that is not among them, and never keeps out one that is."""

    PROBES = 3

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def _bits(keys: np.ndarray, probe: int, bits: int) -> np.ndarray:
        x = keys.view(np.uint64) + np.uint64((probe + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(times)
        return (x ^ (x >> np.uint64(31))) % np.uint64(bits)

    @classmethod
    def of(cls, df: DataFrame, key: str, bits: int = 1 << 26) -> "KeyFilter":
        """The filter of df's keys. Tasks set bits, words of 64 are put together before and behind a shuffle; the driver sees bits / 64 rows at most, whatever the table's size."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = batch.column(key).to_numpy()
                bit = np.unique(np.concatenate([cls._bits(keys, i, bits) for i in range(cls.PROBES)]))
                if len(bit):
                    at = bit >> np.uint64(6)
                    new = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                    word = np.bitwise_or.reduceat(np.uint64(1) << (bit & np.uint64(63)), new)
                    yield pa.RecordBatch.from_arrays([pa.array(at[new].astype(np.int64)), pa.array(word.view(np.int64))], names=["at", "word"])

        found = df.select(key).mapInArrow(run, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
        words = np.zeros(bits // 64, np.uint64)
        words[found.column("at").to_numpy()] = found.column("word").to_numpy().view(np.uint64)
        return cls(words)

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for i in range(self.PROBES):
            bit = self._bits(keys, i, 64 * len(self.words))
            out &= (self.words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        return out


def spread(work: DataFrame, each: int = 8) -> DataFrame:
    """A checkpointed table of pieces of work, dealt to tasks that take ``each`` of them or, of few pieces, fewer: a number of tasks that Spark does not merge again."""
    n = work.count()
    return work.repartition(max(1, min(n, max(2 * work.sparkSession.sparkContext.defaultParallelism, -(-n // each)))))


def text_or_empty(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))

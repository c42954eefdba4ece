"""The one streaming job: new landing files, normalised, without what the sink has already, appended."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..cluster import checkpointed
from ..functions import text as X

#: Bits of a file's key filter for each of its keys, and probes of a key: about one file in a hundred is opened in vain.
BITS_A_KEY, PROBES = 10, 7


def append_new(spark: SparkSession, landing: str, schema: str, sink: str, state: str, normalise: Callable[[DataFrame], DataFrame], key: Callable[[], Column], files_per_batch: int = 100, parts: int = 64) -> None:
    """Takes all landing files not taken yet, in batches, and appends rows whose key is new to the sink (Parquet).

    Keys are unbounded, so they are not kept as streaming state but looked up in the sink. A batch writes one folder of the sink, with a file for each of ``parts`` parts of the keys' hashes, sorted by hash, and beside it
    (in ``sink``.index) a row for each of these files: its range of hashes and a Bloom filter of its keys. The next batch opens only files that may hold one of its own keys, and of these only the keys.

    A batch that is run again after a failure replaces its own folders and looks into earlier batches only, so nothing is lost or doubled wherever it was killed.
    """
    rows_of = lambda batch: _with_key(normalise(batch), key, parts)
    kind = rows_of(spark.createDataFrame([], schema)).schema

    def take(batch: DataFrame, batch_id: int) -> None:
        rows = rows_of(batch)
        values = [F.col(c) for c in rows.columns if c not in ("lead_key", "key_hash", "part")]
        first = checkpointed(rows.groupBy("lead_key", "key_hash", "part").agg(F.min(F.struct(*values)).alias("r")).select("r.*", "lead_key", "key_hash", "part"))
        files = files_to_open(spark, sink, first, batch_id)
        new = first
        if files:
            seen = spark.read.schema(T.StructType([f for f in kind if f.name in ("lead_key", "key_hash")])).parquet(*files)
            seen = seen.withColumnsRenamed({"lead_key": "seen_", "key_hash": "seen_hash_"})
            new = first.join(seen, (F.col("key_hash") == F.col("seen_hash_")) & F.col("lead_key").eqNullSafe(F.col("seen_")), "left_anti")
        folder = f"{sink}/batch={batch_id}"
        new.repartition("part").sortWithinPartitions("part", "key_hash").write.partitionBy("part").mode("overwrite").parquet(folder)
        written = spark.read.schema("key_hash long, part int").parquet(folder).select("key_hash", "part", F.col("_metadata.file_path").alias("file"))
        _index(written).write.mode("overwrite").parquet(f"{sink}.index/batch={batch_id}")

    spark.createDataFrame([], T.StructType([f for f in kind if f.name != "part"])).write.mode("overwrite").parquet(f"{sink}/batch=-1/part=0")  # a sink without any new row is a table too
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    files.writeStream.foreachBatch(take).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


def _with_key(rows: DataFrame, key: Callable[[], Column], parts: int) -> DataFrame:
    """rows, ``lead_key``, its hash, and ``part``, which the hash falls into."""
    keyed = rows.withColumn("lead_key", key())
    return keyed.withColumn("key_hash", F.xxhash64("lead_key")).withColumn("part", F.pmod(F.col("key_hash"), F.lit(parts)).cast("int"))


def probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The filter's bits of each hash, a row for each probe."""
    h = hashes.view(np.uint64)
    step = ((h >> np.uint64(32)) | np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return np.stack([(h + step * np.uint64(i)) % np.uint64(bits) for i in range(PROBES)]).astype(np.int64)


def key_filter(hashes: np.ndarray) -> bytes:
    """A Bloom filter of the hashes."""
    bits = max(64, len(hashes) * BITS_A_KEY)
    held = np.zeros(bits, bool)
    held[probes(hashes, bits).ravel()] = True
    return np.packbits(held, bitorder="little").tobytes() + bits.to_bytes(8, "little")


def may_hold(filter_: bytes, hashes: np.ndarray) -> bool:
    """Whether one of the hashes may be in the filter; never false if one is."""
    bits, held = int.from_bytes(filter_[-8:], "little"), np.frombuffer(filter_[:-8], np.uint8)
    at = probes(hashes, bits)
    return bool(((held[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0).any())


def _index(written: DataFrame) -> DataFrame:
    """(part, file, low, high, keys) of each file of a batch. A file has a batch's keys of one part, 8 bytes for each here."""

    def run(rows: pa.Table) -> pa.Table:
        hashes = rows.column("key_hash").to_numpy()
        return pa.table({"part": rows.column("part").slice(0, 1), "file": rows.column("file").slice(0, 1), "low": [hashes.min()], "high": [hashes.max()], "keys": pa.array([key_filter(hashes)], pa.binary())})

    return written.groupBy("file").applyInArrow(run, "part int, file string, low long, high long, keys binary")


def files_to_open(spark: SparkSession, sink: str, rows: DataFrame, batch_id: int) -> list[str]:
    """The files of batches before batch_id that may hold a key of rows. Filters and the batch's hashes meet by part in tasks; only files' names come back, fewer than the sink has files."""
    try:
        index = spark.read.schema("part int, file string, low long, high long, keys binary, batch long").parquet(f"{sink}.index")
    except AnalysisException:  # no batch was written yet
        return []
    index = index.filter(F.col("batch") < batch_id).drop("batch")
    asked = rows.groupBy(F.col("part").alias("part_")).agg(F.sort_array(F.collect_set("key_hash")).alias("hashes"))  # a batch's hashes of a part: 8 bytes for each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = []
            for file, low, high, keys, i in zip(*(batch.column(c).to_pylist() for c in ("file", "low", "high", "keys")), range(batch.num_rows), strict=True):
                hashes = batch.column("hashes")[i].values.to_numpy()
                hashes = hashes[np.searchsorted(hashes, low) : np.searchsorted(hashes, high, "right")]
                if len(hashes) and may_hold(keys, hashes):
                    hits.append(file)
            yield pa.RecordBatch.from_arrays([pa.array(hits, pa.string())], names=["file"])

    found = index.join(asked, F.col("part") == F.col("part_")).mapInArrow(run, "file string")
    return sorted(r.file for r in found.collect())


def sink_table(spark: SparkSession, sink: str, schema: T.StructType | None = None) -> DataFrame:
    """The sink's rows, and the batch and part that each was written in. A sink without any rows needs a schema."""
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(sink)


def user_key():
    """The key of event rows: one lead for each user and kind of event."""
    return X.hash_id(F.col("user_id").cast("string"), F.col("event_type"))

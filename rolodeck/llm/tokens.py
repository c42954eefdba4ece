"""Token counts from flat token files, by scanning for separators.

A token file is nothing but token ids (little-endian, 16 or 32 bits) of documents one after another, each ended by the end-of-document id: no header, no
index. To count a document's tokens the file is cut into blocks of a fixed size. Each block, a task's work of its own, is searched for the separator with
vectorised comparison and yields its separators' places. Lengths need what lies before a block: a prefix scan over the blocks' summaries (how many separators, and
how many tokens after the last one) tells each block the ordinal of its first document and how many tokens of it came before.

``write_tokens`` makes such files of a document table. A task that is run again writes under a new name, and only names returned by the successful attempt
are in the manifest.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .util import binary, checkpointed, filesystem, new_folder, spread, text_slices

#: A vocabulary file is read by the driver and broadcast; larger ones are refused.
MOST_VOCABULARY_BYTES = 64 << 20


class Vocabulary:
    """A byte-pair vocabulary in tiktoken's text form, with one more id for the end of a document."""

    def __init__(self, data: bytes, pattern: str):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}
        self.eod = len(ranks)
        self.dtype = np.dtype("<u2" if self.eod < 1 << 16 else "<u4")
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(text), self.dtype)


def load_vocabulary(path: str) -> bytes:
    files, inner = filesystem(path)
    with files.open_input_file(inner) as f:
        if f.size() > MOST_VOCABULARY_BYTES:
            raise ValueError(f"{path} has {f.size()} bytes; at most {MOST_VOCABULARY_BYTES} are broadcast")
        return f.read()


def write_tokens(docs: DataFrame, vocabulary: bytes, pattern: str, folder: str | None = None, id: str = "doc_id", text: str = "text", file_mb: int = 512) -> DataFrame:
    """Writes docs' tokens to flat files; returns the manifest: path, ordinal (in the file, from 0) and id of each document.

    A null or empty text has no tokens, only its separator. Special tokens' strings in texts are ordinary text. Null ids and repeated rows are documents as
    any other; extra columns are ignored. An empty table writes no file.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "tokens")
    shipped = spark.sparkContext.broadcast(vocabulary)
    most = file_mb << 20

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(shipped.value, pattern)
        end = np.array([words.eod], words.dtype).tobytes()
        files, inner = filesystem(folder)
        files.create_dir(inner, recursive=True)
        out, path, ordinal, size = None, "", 0, 0
        for batch in text_slices(batches, "text"):
            paths, ordinals = [], []
            for t in binary(batch.column("text")):
                if out is None or size >= most:
                    if out is not None:
                        out.close()
                    path, ordinal, size = f"{folder}/{uuid.uuid4().hex}.tok", 0, 0
                    out = filesystem(path)[0].open_output_stream(filesystem(path)[1])
                data = words.encode((t or b"").decode()).tobytes() + end
                out.write(data)
                paths.append(path)
                ordinals.append(ordinal)
                ordinal, size = ordinal + 1, size + len(data)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(ordinals, pa.int64()), batch.column("id")], names=["path", "ordinal", "id"])
        if out is not None:
            out.close()

    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return checkpointed(rows.mapInArrow(run, "path string, ordinal long, id long"))


def separators(tokens: np.ndarray, eod: int) -> np.ndarray:
    """Places of the separator, by one vectorised comparison."""
    return np.flatnonzero(tokens == eod)


def count_tokens(files: DataFrame, eod: int, width: int = 2, block_mb: int = 8) -> DataFrame:
    """(path, ordinal, n_tokens) of each document in the files (column ``path``), separators not counted.

    width: bytes of an id. A last document without a separator counts as a document if it has tokens. A file whose size is no multiple of width is an error.
    """
    if block_mb < 1:
        raise ValueError("block_mb must be 1 at least")
    step = (block_mb << 20) // width * width
    return count_tokens_by(files, eod, width, step)


def count_tokens_by(files: DataFrame, eod: int, width: int, step: int) -> DataFrame:
    """count_tokens with blocks of ``step`` bytes, a multiple of width."""
    dtype = np.dtype({2: "<u2", 4: "<u4"}[width])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, inner = filesystem(path)
                size = store.get_file_info(inner).size
                if size % width:
                    raise ValueError(f"{path} has {size} bytes, no multiple of {width}")
                n = -(-size // step)
                yield pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array(range(n), pa.int64()), pa.array([n] * n, pa.int64())], names=["path", "block", "blocks"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
        for batch in batches:
            for i, (path, block) in enumerate(zip(batch.column("path").to_pylist(), batch.column("block").to_pylist(), strict=True)):
                store, inner = filesystem(path)
                with store.open_input_file(inner) as f:
                    f.seek(block * step)
                    tokens = np.frombuffer(f.read(step), dtype)
                at = separators(tokens, eod)
                found = (len(tokens), len(at), len(tokens) - 1 - int(at[-1]) if len(at) else len(tokens), np.diff(at, prepend=-1) - 1)
                yield pa.RecordBatch.from_arrays([*batch.slice(i, 1).columns, *(pa.array([c], k) for c, k in zip(found, kinds, strict=True))], names=[*batch.schema.names, "n", "seps", "tail", "lengths"])

    every = checkpointed(files.select("path").distinct().mapInArrow(blocks, "path string, block long, blocks long"))
    scanned = checkpointed(spread(every).mapInArrow(scan, "path string, block long, blocks long, n long, seps long, tail long, lengths array<long>"))
    # The prefix scan: a file's blocks are few (its size by the block's), and only their summaries are sorted.
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    tokens = F.coalesce(F.sum("n").over(before), F.lit(0))
    ended = F.coalesce(F.max(F.when(F.col("seps") > 0, F.col("so_far") - F.col("tail"))).over(before), F.lit(0))
    summaries = scanned.select("path", "block", "n", "seps", "tail")
    stitched = summaries.withColumn("so_far", tokens + F.col("n")).select(F.col("path").alias("path_"), F.col("block").alias("block_"), F.coalesce(F.sum("seps").over(before), F.lit(0)).alias("first"), (F.col("so_far") - F.col("n") - ended).alias("carried"))
    lengths = scanned.join(stitched, (F.col("path") == F.col("path_")) & (F.col("block") == F.col("block_")))
    # A block's first document takes in what earlier blocks carried; the file's last block ends the file's last document.
    closed = lengths.select("path", F.posexplode("lengths").alias("k", "length"), "first", "carried").select("path", (F.col("first") + F.col("k")).alias("ordinal"), (F.col("length") + F.when(F.col("k") == 0, F.col("carried")).otherwise(0)).alias("n_tokens"))
    rest = F.col("tail") + F.when(F.col("seps") == 0, F.col("carried")).otherwise(0)
    opened = lengths.filter((F.col("block") == F.col("blocks") - 1) & (rest > 0)).select("path", (F.col("first") + F.col("seps")).alias("ordinal"), rest.alias("n_tokens"))
    return closed.unionByName(opened)


def document_tokens(docs: DataFrame, vocabulary: bytes, pattern: str, id: str = "doc_id", text: str = "text", block_mb: int = 8) -> DataFrame:
    """(id, n_tokens) of each document: its tokens are written to flat files, and these are scanned.

    ids must be whole numbers. The files go once they are scanned, or the job has failed; the scan's result is kept by a reliable checkpoint, so nothing reads them again.
    """
    words, folder = Vocabulary(vocabulary, pattern), new_folder(docs.sparkSession, "tokens")
    try:
        manifest = write_tokens(docs, vocabulary, pattern, folder, id, text)
        counts = count_tokens(manifest, words.eod, words.dtype.itemsize, block_mb).withColumnsRenamed({"path": "path_", "ordinal": "ordinal_"})
    finally:
        files, inner = filesystem(folder)
        files.delete_dir_contents(inner, missing_dir_ok=True)
    return manifest.join(counts, (F.col("path") == F.col("path_")) & (F.col("ordinal") == F.col("ordinal_"))).select(F.col("id").alias(id), "n_tokens")

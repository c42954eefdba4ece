"""Enrichment by a caller's function: select the rows that need it, call it once for each distinct key, write back.

The function gets a key and returns a value, nothing (None), or raises. It may be slow and may fail; a failure becomes a status, never a lost task. Results are checkpointed, so that a later read does not
call it again. Concurrency is the number of partitions, a rate may bound all of them together, and a table of answers keeps what was paid for when a job dies. Calls should not run twice at a time: leave speculative execution off.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..cluster import checkpointed, filesystem, fresh
from .lookup import looked_up as answered, one_row_a_key


class FailFast(Exception):
    """Raised by a caller's function where another try is useless."""


def call_with_retries(fn: Callable[[str], str | None], key: str, tries: int = 3, wait: float = 0.0) -> tuple[str | None, str | None]:
    """(value, error): up to so many tries, waiting twice as long each time."""
    error = None
    for i in range(tries):
        try:
            return fn(key), None
        except FailFast as e:
            return None, f"failed: {e}"
        except Exception as e:  # the caller's function may raise anything
            error = f"{type(e).__name__}: {e}"
            if wait and i + 1 < tries:
                time.sleep(wait * 2**i)
    return None, error


ANSWERS = "key string, value string, error string, at double"


class Pace:
    """At most so many calls a second, in one task."""

    def __init__(self, rate: float | None):
        self.gap, self.next = (1 / rate if rate else 0.0), 0.0

    def wait(self) -> None:
        now = time.monotonic()
        if now < self.next:
            time.sleep(self.next - now)
        self.next = max(now, self.next) + self.gap


def answer(keys: Iterator[str], fn: Callable[[str], str | None], folder: str, tries: int, wait: float, pace: Pace, each: int) -> int:
    """Calls fn for the keys that folder has no answer for, and adds files of ``each`` answers to it; returns the number of calls' keys.

    A file appears whole (it is written under another name first) or not at all, and is never changed. So what a killed attempt had written is there for the next one.
    """
    import pyarrow.parquet as pq
    from pyarrow import fs

    files, inner = filesystem(folder)
    files.create_dir(inner, recursive=True)
    done: set[str] = set()
    for f in files.get_file_info(fs.FileSelector(inner)):
        if f.base_name.endswith(".parquet"):
            done.update(pq.read_table(f.path, columns=["key"], filesystem=files).column("key").to_pylist())
    found: list[tuple] = []
    n = 0

    def flush() -> None:
        name = uuid.uuid4().hex
        columns = list(zip(*found, strict=True))
        table = pa.table({c: pa.array(v, pa.float64() if c == "at" else pa.string()) for c, v in zip(("key", "value", "error", "at"), columns, strict=True)})
        pq.write_table(table, f"{inner}/_{name}", filesystem=files)
        files.move(f"{inner}/_{name}", f"{inner}/{name}.parquet")
        found.clear()

    for key in keys:
        if key in done:
            continue
        pace.wait()
        found.append((key, *call_with_retries(fn, key, tries, wait), time.time()))
        n += 1
        if len(found) >= each:
            flush()
    if found:
        flush()
    return n


def known_answers(spark: SparkSession, answers: str) -> DataFrame:
    """(key, value, error): the last answer of each key in the table; an empty one if there is none yet."""
    files, inner = filesystem(answers)
    files.create_dir(inner, recursive=True)
    every = spark.read.schema(ANSWERS).option("recursiveFileLookup", True).parquet(answers)
    last = one_row_a_key(every, F.col("key"), {"value": F.col("value"), "error": F.col("error")}, ("at",))
    return last.select("key", "value.*")


def looked_up(keys: DataFrame, key: str, fn: Callable[[str], str | None], tries: int = 3, wait: float = 0.0, partitions: int | None = None, rate: float | None = None, answers: str | None = None, each: int = 20) -> DataFrame:
    """(key, value, error) for each distinct key that is not blank.

    partitions: so many tasks call at a time, if the cluster has room for them. rate: calls a second by all of them together; each has an equal share, retries of a call not counted.
    answers: a folder (of the shared kind) that keeps answers. Keys that it has a value, nothing or a final refusal for are not called again, by this call or a later one; those that failed otherwise are. Tasks add to it after
    ``each`` answers, so that an executor that is lost repeats no more calls than that. Without it a task that is lost repeats all of its own.
    """
    spark = keys.sparkSession
    distinct = keys.select(F.col(key).alias("key")).filter(X.nonblank(X.blank_if_null(F.col("key")))).distinct()
    if partitions or rate or answers:
        partitions = partitions or spark.sparkContext.defaultParallelism
    share = rate / partitions if rate else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pace = Pace(share)
        for batch in batches:
            found = []
            for k in batch.column("key").to_pylist():
                pace.wait()
                found.append(call_with_retries(fn, k, tries, wait))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array([v for v, _ in found], pa.string()), pa.array([e for _, e in found], pa.string())], names=["key", "value", "error"])

    if answers is None:
        return checkpointed((distinct.repartition(partitions, "key") if partitions else distinct).mapInArrow(run, "key string, value string, error string"))

    distinct = checkpointed(distinct)
    final = known_answers(spark, answers).filter(F.col("error").isNull() | F.col("error").startswith("failed:")).select(F.col("key").alias("k_"))
    open_ = distinct.join(final, F.col("key") == F.col("k_"), "left_anti").repartition(partitions, "key")
    name = f"{answers.rstrip('/')}/{uuid.uuid4().hex}"

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = f"{name}/{TaskContext.get().partitionId()}"  # the same for each attempt of a task
        n = answer((k for b in batches for k in b.column("key").to_pylist()), fn, own, tries, wait, Pace(share), each)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    open_.mapInArrow(keep, "n long").agg(F.sum("n")).first()
    return checkpointed(known_answers(spark, answers).join(distinct, "key", "left_semi"))


def enriched(df: DataFrame, needs: Column, key: str, into: str, fn: Callable[[str], str | None], by: str, tries: int = 3, fallback: Column | None = None, rate: float | None = None, answers: str | None = None) -> DataFrame:
    """df with ``into`` filled where it is needed and found; beside it ``into_by`` and ``into_error``. Other rows stay as they are.

    fallback: a rule for rows that need a value and got none. rate, answers: see ``looked_up``.
    """
    names = {x: fresh(df.columns, f"_{x}") for x in ("needs", "key", "value", "error")}
    n, k, v, e = (F.col(names[x]) for x in names)
    marked = df.withColumn(names["needs"], F.coalesce(needs, F.lit(False)))
    found = looked_up(marked.filter(n), key, fn, tries, rate=rate, answers=answers).withColumnsRenamed({x: names[x] for x in ("key", "value", "error")})
    joined = marked.join(found, n & (F.col(key) == k), "left")
    old = F.col(into) if into in df.columns else F.lit(None).cast("string")
    rule = fallback if fallback is not None else F.lit(None).cast("string")
    value = F.when(n, F.coalesce(v, rule, old)).otherwise(old)
    source = F.when(v.isNotNull(), F.lit(by)).when(n & rule.isNotNull(), F.lit("fallback"))
    return joined.withColumns({f"{into}_by": source, f"{into}_error": F.when(n & v.isNull(), F.coalesce(e, F.lit("no_value")))}).withColumn(into, value).drop(*names.values())


def prompt(template: str, **columns: Column) -> Column:
    """Text for each row: {name} in the template stands for a column; null is empty."""
    out = F.lit(template)
    for name, c in columns.items():
        out = F.replace(out, F.lit("{" + name + "}"), X.blank_if_null(c.cast("string")))
    return out


def email_status(df: DataFrame, answers: DataFrame, email: str = "email", order: tuple[str, ...] = ()) -> DataFrame:
    """df with ``email_status``: missing without an e-mail, the last answer (email, status; see ``lookup``) if it is there and no error, else verification_failed."""
    said = fresh(df.columns, "_said")
    joined = answered(df, answers, X.key(F.col(email)), X.key(F.col("email")), {"status": F.col("status")}, said, order)
    status = F.when(X.key(F.col(email)) == "", "missing").when(F.coalesce(f"{said}.status", F.lit("error")) == "error", "verification_failed").otherwise(F.col(f"{said}.status"))
    return joined.withColumn("email_status", status).drop(said)

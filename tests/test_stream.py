"""The stream's sink and its index of keys."""

import random
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from rolodeck.streaming import incremental as I

SCHEMA = "n long, who string"


def run(spark, path, key=lambda: F.col("who")):
    I.append_new(spark, f"{path}/landing", SCHEMA, f"{path}/sink", f"{path}/state", lambda d: d, key, 1, parts=8)


def land(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/landing")


def test_filters_lose_nothing():
    rng = np.random.default_rng(1)
    held, other = rng.integers(-(2**63), 2**63, 2000), rng.integers(-(2**63), 2**63, 2000)
    bits = I.key_filter(held)
    assert all(I.may_hold(bits, held[i : i + 1]) for i in range(2000))
    assert sum(I.may_hold(bits, other[i : i + 1]) for i in range(2000)) < 60
    assert I.may_hold(I.key_filter(held[:1]), held[:1])


def test_a_batch_opens_few_files(spark, tmp_path):
    """A thousand new keys against a sink of many files; and old ones, which open just their own."""
    rng = random.Random(2)
    for batch in range(6):
        land(spark, tmp_path, [(i, f"{batch}-{rng.random()}") for i in range(1500)])
    run(spark, tmp_path)
    sink = f"{tmp_path}/sink"
    files = {r[0] for r in I.sink_table(spark, sink).select("_metadata.file_path").distinct().collect()}
    assert len(files) == 48
    kind = spark.createDataFrame([(i, f"new {i}") for i in range(1000)], SCHEMA)
    opened = I.files_to_open(spark, sink, I._with_key(kind, lambda: F.col("who"), 8), 99)
    assert len(opened) < 48 and set(opened) <= files
    one = I.sink_table(spark, sink).select("who", F.col("_metadata.file_path").alias("f")).first()
    opened = I.files_to_open(spark, sink, I._with_key(spark.createDataFrame([(1, one.who)], SCHEMA), lambda: F.col("who"), 8), 99)
    assert one.f in opened and len(opened) <= 3
    assert I.files_to_open(spark, sink, I._with_key(kind, lambda: F.col("who"), 8), 0) == []


@pytest.mark.parametrize("killed", ["before the index", "after the index"])
def test_a_killed_batch_is_repeated(spark, tmp_path, monkeypatch, killed):
    """The second batch fails while or after it writes; run again it replaces what it had written."""
    for rows in ([(1, "a"), (2, "b")], [(3, "b"), (4, "c"), (5, "c"), (6, None)], [(7, "a"), (8, "d"), (9, None)]):
        land(spark, tmp_path, rows)
    real, calls = I._index, []

    def index(written):
        calls.append(1)
        if len(calls) == 2:
            if killed == "after the index":
                real(written).write.mode("overwrite").parquet(f"{tmp_path}/sink.index/batch=1")
            raise RuntimeError("killed")
        return real(written)

    monkeypatch.setattr(I, "_index", index)
    with pytest.raises(Exception, match="killed"):
        run(spark, tmp_path)
    run(spark, tmp_path)
    got = sorted((str(r.who), r.n) for r in I.sink_table(spark, f"{tmp_path}/sink").collect())
    assert len(got) == 5 and {w for w, _ in got} == {"a", "b", "c", "d", "None"}
    shutil.copytree(f"{tmp_path}/sink", f"{tmp_path}/before")
    land(spark, tmp_path, [(10, "a"), (11, "d"), (12, None)])
    run(spark, tmp_path)
    assert I.sink_table(spark, f"{tmp_path}/sink").count() == 5


def test_nothing_landed(spark, tmp_path):
    land(spark, tmp_path, [])
    run(spark, tmp_path)
    assert I.sink_table(spark, f"{tmp_path}/sink").count() == 0

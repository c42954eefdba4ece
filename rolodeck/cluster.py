"""What jobs need of the cluster: a shared folder for checkpoints, and this package on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_shipped: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session may do without; it gets a folder of its own."""
    sc = spark.sparkContext
    try:
        named = spark.conf.get("spark.checkpoint.dir")
    except Exception:  # no such setting in this session
        named = None
    if not sc.getCheckpointDir():
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="rolodeck-"))
    return named or sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """df, cut from its lineage by a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def fresh(columns: Iterable[str], base: str) -> str:
    """A column name that starts with base and clashes with none of columns (names are compared without case)."""
    taken = {c.lower() for c in columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame, order: list[Column], into: str) -> DataFrame:
    """df with the numbers 1, 2, ... of its rows in an order.

    No task sees all rows: the sort deals them to ranges, each range is numbered by itself, and the ranges before it are added.
    """
    part, first, other = (fresh([*df.columns, into], x) for x in ("_part", "_first", "_other"))
    dealt = checkpointed(df.orderBy(*order)).withColumn(part, F.spark_partition_id())
    sizes = dealt.groupBy(F.col(part).alias(other)).agg(F.count(F.lit(1)).alias(first))
    before = sizes.select(other, (F.sum(first).over(Window.orderBy(other)) - F.col(first)).alias(first))  # a row for each range
    inside = F.row_number().over(Window.partitionBy(part).orderBy(*order)).cast("long")
    return dealt.withColumn(into, inside).join(F.broadcast(before), F.col(part) == F.col(other)).withColumn(into, F.col(into) + F.col(first)).drop(part, first, other)


def split_hot(right: DataFrame, weight: str, total: int, heavy: int = 1_000) -> tuple[DataFrame, DataFrame]:
    """right, one row for each key, in two: keys that ``weight`` rows have, over ``heavy`` and over a ten-thousandth of ``total``, marked for a broadcast (fewer than 10,000, whatever the tables' sizes), and all others."""
    most = max(total // 10_000, heavy)
    return F.broadcast(right.filter(F.col(weight) > most)), right.filter(F.col(weight) <= most)


def join_hot(left: DataFrame, right: DataFrame, on: tuple[str, str], weight: str, total: int, heavy: int = 1_000) -> DataFrame:
    """left joined (inner) with right, which has one row for each key, by equality of left's column on[0] and right's on[1].

    weight: right's column with the number of left's rows that have the key; total: at least the sum of all weights. Hot keys (see ``split_hot``) are told to all tasks. All others are joined as
    Spark sees fit, and none of them is much for one task. Both tables are read twice.
    """
    hot, cold = split_hot(right, weight, total, heavy)
    same = F.col(on[0]) == F.col(on[1])
    return left.join(hot, same).unionByName(left.join(hot.select(on[1]), same, "left_anti").join(cold, same))


def without_hot(left: DataFrame, right: DataFrame, on: tuple[str, str], weight: str, total: int, heavy: int = 1_000) -> DataFrame:
    """left without the rows whose key right has (see ``join_hot``)."""
    same = F.col(on[0]) == F.col(on[1])
    for keys in split_hot(right, weight, total, heavy):
        left = left.join(keys.select(on[1]), same, "left_anti")
    return left


def filesystem(uri: str):
    """(pyarrow filesystem, path inside it) of a URI or a plain path; works on executors as on the driver."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


def row_slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 32 << 20) -> Iterator[pa.RecordBatch]:
    """The batches, cut into slices of as many rows as their average size allows in ``most`` bytes of the column; at least one."""
    for batch in batches:
        step = max(1, batch.num_rows * most // max(1, batch.column(column).nbytes)) if batch.num_rows else 1
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
        del batch  # else it stays while the next one is read


def ship(spark: SparkSession) -> None:
    """Puts this package on the Python path of the executors, once for each application; Spark's file server delivers it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="rolodeck-ship-"), "rolodeck.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("rolodeck", os.path.relpath(full, root)))
    sc.addPyFile(path)

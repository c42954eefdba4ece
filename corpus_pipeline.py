"""From raw documents to shuffled shards: reject, deduplicate, decontaminate, mix, shard.

Each stage takes what its predecessor kept, in the columns of documents (whatever they are, doc_id, text, lang and source among them), and
returns what it keeps in the same columns; the last adds shard and slot. A document that the mix takes twice is two rows from there on.

What holds for each stage: other columns of docs, whatever their names and types, stay as they are. Null ids are ids as any other, null texts count as empty. Repeated rows stay (but
for the near-duplicate stage, which keeps one). Texts of any length are taken whole. An empty table gives an empty result. ids must be whole numbers.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolodeck import cluster
from rolodeck.llm import decontaminate, mixing, neardup, quality, sharding
from rolodeck.llm.util import filesystem, free_prefix, fresh, new_folder, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def on_cluster(stage: Stage) -> Stage:
    """stage, after the package was put on the executors' Python path."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        cluster.ship(spark)
        return stage(spark, docs, sf_dir)

    return run


@on_cluster
def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that base rules or certified cutoffs reject. Null and very short texts go; a null lang is a stratum of its own."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


@on_cluster
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more): the one with the smallest doc_id, nulls last. Word-less texts are copies of each other."""
    return neardup.keep_one(docs, words=5, similarity=0.8)


@on_cluster
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold benchmark passages in at least a twentieth of their words. A text without words holds none and stays."""
    prefix = free_prefix(docs.columns, "_d_")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), prefix=prefix)
    return found.filter(~F.col(f"{prefix}contaminated")).select(*docs.columns)


@on_cluster
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: never, once or twice. A text without words is never taken; the null source is one of the sources."""
    times = fresh(docs.columns, "_times")
    mix = mixing.plan_mix(docs, weights=[5, 2, 1], budget=1.5, most=2)
    taken = mix.apply(docs, times).filter(F.col(times) > 0)
    return taken.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).drop(times)


@on_cluster
def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row with its shard (0 to 15) and slot; where docs has such columns already, the new names end in underscores. Repeated rows get slots of their own."""
    return sharding.shard(docs, 16, into=(fresh(docs.columns, "shard"), fresh(docs.columns, "slot")))


STAGES = [
    ("quality rules", reject_low_quality),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("source mixing", mix_sources),
    ("sharding", assign_shards),
]
#: XXH64 fingerprints and hash-ordered row numbers are beyond DuckDB's SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each stage's rows are written to the shared folder and read again by the next, which reads them more than once;
    only what the last stage reads stays there."""
    docs, folder = table(spark, sf_dir, "documents"), new_folder(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        if i:
            files, inner = filesystem(f"{folder}/{i - 1}")
            files.delete_dir(inner)
    return STAGES[-1][1](spark, docs, sf_dir)

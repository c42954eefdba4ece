"""Lookups by key that never add or drop a row, however often a key is answered."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..cluster import checkpointed, fresh

#: With hot=True a key counts as hot from so many rows on, if it has over a ten-thousandth of all rows too.
HEAVY = 100_000


def one_row_a_key(answers: DataFrame, key: Column, values: dict[str, Column], order: Iterable[str] = (), names: tuple[str, str] = ("key", "value")) -> DataFrame:
    """(key, value): of each key that is not null the last answer, a struct of ``values``.

    order: columns of answers that say which of two answers is the later one (null comes first); where they leave it open, or there are none, the larger values win, so that a result never depends on the order of rows.
    Values and order must be of comparable types. The reduction combines before rows of a key meet. To combine records a task sorts them, so they are dealt out first, by their contents: a file read by one task may hold very
    many, and a hot key has no task of its own. Where a share is large (equal records), adaptive execution splits it.
    """
    value = F.struct(*[v.alias(k) for k, v in values.items()])
    pairs = answers.select(key.alias("k_"), F.struct(*[F.col(c) for c in order], value.alias("value_")).alias("last_"))
    dealt = pairs.filter(F.col("k_").isNotNull()).withColumn("dealt_", F.xxhash64("k_", "last_")).hint("rebalance", F.col("dealt_"))
    best = dealt.groupBy("k_").agg(F.max("last_").alias("last_"))
    return best.select(F.col("k_").alias(names[0]), F.col("last_.value_").alias(names[1]))


def looked_up(df: DataFrame, answers: DataFrame, on: Column, key: Column, values: dict[str, Column], into: str, order: Iterable[str] = (), hot: bool = False) -> DataFrame:
    """df, each row once, and ``into``: a struct of the values that the last answer gives to the row's key; null where there is no answer.

    on: df's key; key: the same of answers. The struct is null, and not a struct of nulls, where nothing is found. hot: a few keys may hold a large share of df's rows; they are counted first (df is read twice) and looked
    up in a broadcast, of fewer than 10,000 rows, whatever the table; the others join as Spark sees fit. Without it a skewed key is left to adaptive execution, which splits it where the join sorts.
    """
    of = fresh([*df.columns, into], "_of")
    one = one_row_a_key(answers, key, values, order, (of, into))
    if not hot:
        return df.join(one, on == F.col(of), "left").drop(of)
    asked = fresh([*df.columns, into, of], "_asked")
    rows = df.withColumn(asked, on)
    sizes = checkpointed(rows.groupBy(asked).agg(F.count(F.lit(1)).alias("n_")))
    total = sizes.agg(F.sum("n_")).first()[0] or 0
    heavy = sizes.filter(F.col("n_") > max(HEAVY, total // 10_000)).select(F.col(asked).alias("hot_"))
    same = F.col(asked) == F.col("hot_")
    known = F.broadcast(heavy.filter("hot_ is not null").join(one, F.col("hot_") == F.col(of), "left").drop(of))
    first = rows.join(known, same).drop("hot_")
    rest = rows.join(known.select("hot_"), same, "left_anti").join(one, F.col(asked) == F.col(of), "left").drop(of)
    return first.unionByName(rest).drop(asked)

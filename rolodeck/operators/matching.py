"""Joins that are no equality, by equality: texts that contain words, and ranges that overlap, for tables of any size.

A table of a few rows is told to all tasks and compared directly. Beyond ``FEW`` rows both sides are written as keys that must be equal, joined by them, and confirmed exactly. Both ways give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..cluster import fresh

#: Up to so many rows a table is told to all tasks.
FEW = 10_000
#: Words are found by their first so many characters.
START = 8


def is_few(df: DataFrame) -> bool:
    return df.limit(FEW + 1).count() <= FEW


def containing(df: DataFrame, text: Column, words: DataFrame, word: str) -> DataFrame:
    """Each row of df with each row of words whose ``word`` is part of the row's text; an empty word is part of every text, null of none.

    Beyond FEW words a text's different pieces of up to START characters, of the lengths that words begin with, meet the words' beginnings: some START pieces for each character of a text, whatever the number of words.
    """
    words = words.filter(F.col(word).isNotNull())
    if is_few(words):
        return df.join(F.broadcast(words), F.contains(text, F.col(word)))
    text_, piece, start = (fresh([*df.columns, *words.columns], x) for x in ("_text", "_piece", "_start"))
    begun = words.withColumn(start, F.substring(F.col(word), 1, START))
    lengths = sorted(r.n for r in begun.select(F.length(start).alias("n")).distinct().collect())  # START + 1 numbers at most
    t = F.col(text_)
    of = lambda n: F.transform(F.sequence(F.lit(1), F.length(t) - (n - 1)), lambda i: F.substr(t, i, F.lit(n)))
    pieces = [F.when(F.length(t) >= n, of(n)).otherwise(F.array().cast("array<string>")) if n else F.array(F.lit("")) for n in lengths]
    cut = df.withColumn(text_, text).filter(t.isNotNull()).withColumn(piece, F.explode(F.array_distinct(F.concat(*pieces))))
    return cut.join(begun, F.col(piece) == F.col(start)).filter(F.contains(t, F.col(word))).drop(text_, piece, start)


def _blocks(low: Column, high: Column) -> Column:
    """The fewest blocks (level, block) of 2^level whole numbers, at multiples of it, that make up low .. high - 1."""
    none = F.array().cast("array<struct<level: int, block: bigint>>")
    start = F.struct(low.cast("long").alias("a"), high.cast("long").alias("b"), none.alias("blocks"))

    def step(s: Column, level: Column) -> Column:
        open_ = s["a"] < s["b"]
        left, right = open_ & (F.pmod(s["a"], F.lit(2)) == 1), open_ & (F.pmod(s["b"], F.lit(2)) == 1)
        one = lambda c, block: F.when(c, F.array(F.struct(level.cast("int").alias("level"), block.cast("long").alias("block")))).otherwise(none)
        a, b = s["a"] + left.cast("long"), s["b"] - right.cast("long")
        return F.struct(F.shiftright(a, 1).alias("a"), F.shiftright(b, 1).alias("b"), F.concat(s["blocks"], one(left, s["a"]), one(right & (b >= a), b)).alias("blocks"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), start, step)["blocks"]


def _points_in(points: DataFrame, at: Column, ranges: DataFrame, low: Column, high: Column) -> DataFrame:
    """Each row of points with each row of ranges for which low <= at < high, once: a range is a few blocks, a point lies in one block of each level."""
    names = [fresh([*points.columns, *ranges.columns], x) for x in ("_level", "_block", "_in")]
    level, block, in_ = names
    dealt = ranges.withColumn(in_, F.explode(_blocks(low, high))).withColumns({level: F.col(f"{in_}.level"), block: F.col(f"{in_}.block")}).drop(in_)
    used = sorted(r[0] for r in dealt.select(level).distinct().collect())  # 64 numbers at most
    if not used:
        return points.join(ranges, F.lit(False))
    key = F.explode(F.array(*[F.struct(F.lit(n).alias("l"), F.shiftright(at.cast("long"), n).alias("b")) for n in used]))
    asked = points.withColumn(in_, key)
    return asked.join(dealt, (F.col(f"{in_}.l") == F.col(level)) & (F.col(f"{in_}.b") == F.col(block))).drop(*names)


def overlapping(df: DataFrame, low: Column, high: Column, ranges: DataFrame, low_of: str, high_of: str) -> DataFrame:
    """Each row of df with each row of ranges (low_of, high_of; whole numbers) that begins before ``high`` and ends behind ``low``; nulls meet nothing.

    Of two ranges that overlap, one begins inside the other: beyond FEW ranges these are two joins of points with ranges, which share no pair.
    """
    a, b = F.col(low_of), F.col(high_of)
    hit = (b > low) & (a < high)
    ranges = ranges.filter(a.isNotNull() & b.isNotNull())
    if is_few(ranges):
        return df.join(F.broadcast(ranges), hit)
    l_, h_ = (fresh([*df.columns, *ranges.columns], x) for x in ("_l", "_h"))
    rows = df.withColumns({l_: low.cast("long"), h_: high.cast("long")}).filter(F.col(l_).isNotNull() & F.col(h_).isNotNull())
    columns = [*rows.columns, *ranges.columns]
    inside = _points_in(rows, F.col(l_), ranges, a, b).filter(a < F.col(h_)).select(*columns)
    behind = _points_in(ranges, a, rows, F.col(l_) + 1, F.col(h_)).filter(b > F.col(l_)).select(*columns)
    return inside.unionByName(behind).drop(l_, h_)

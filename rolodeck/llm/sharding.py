"""Shards by a Feistel permutation of global row numbers, in DataFrame functions only.

Each row gets a global number 0 .. n-1, which depends on the rows' contents alone, never on files or partitions. A keyed Feistel network permutes
the numbers; where its domain is larger than n, cycle walking applies it again until the number is below n. The permuted number gives the row's place in the
shuffle: ``place mod shards`` is the shard, ``place div shards`` the slot. Shards' counts differ by one at most and slots have no gaps. Whoever
knows n and the key can compute shard and slot of a row number, and the row number at a slot, without the table (``place_of`` and ``row_at``).

Row numbers without a single task that sees all rows: a hash of the row deals rows to ``buckets`` buckets, an aggregation counts the buckets, running
sums over this table, in two levels, give each bucket's first number, and a window inside each bucket numbers its rows. Rows are dealt by id and content together, so
many rows of one id spread; only rows equal in all that is looked at share a bucket, and they are interchangeable.

Defined results: null ids, null and empty texts are rows as any other (size 1, CRC-32 of nothing: 0). Repeated rows each get a slot of their own. An empty
table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import fresh, text_or_empty

ROUNDS = 6
#: Buckets that are numbered together.
BLOCK = 4096
#: Up to so many buckets' first numbers are told to all tasks (24 bytes each); beyond, rows meet them by bucket.
BROADCAST_BUCKETS = 100_000


def _round(value: Column, key: str, modulus: Column) -> Column:
    return F.pmod(F.xxhash64(value, F.lit(key)), modulus)


def feistel(x: Column, n: Column, key: str, rounds: int = ROUNDS) -> Column:
    """One pass of the network over 0 .. a*b-1, where a = ceil(sqrt(n)) and b = ceil(n/a): fewer than a numbers lie beyond n.

    The halves are the digits of x in the mixed base (a, b); each round adds a hash of one half to the other.
    """
    a = F.greatest(F.ceil(F.sqrt(n.cast("double"))).cast("long"), F.lit(1).cast("long"))
    b = F.greatest(F.floor((n + a - 1) / a).cast("long"), F.lit(1).cast("long"))
    left, right = F.floor(x / b).cast("long"), F.pmod(x, b)
    for i in range(rounds):
        if i % 2 == 0:
            left = F.pmod(left + _round(right, f"{key}/{i}", a), a)
        else:
            right = F.pmod(right + _round(left, f"{key}/{i}", b), b)
    return left * b + right


def with_place(df: DataFrame, row: str, n: str, place: str, key: str, rounds: int = ROUNDS) -> DataFrame:
    """df and ``place``: the permuted row number.

    A walk longer than ``most`` passes is impossible for n up to most**2, for fewer than sqrt(n) numbers lie beyond n; for larger n each pass leaves the range
    with a chance below 1 / most. Should that ever happen most times running, the job fails rather than give a wrong place.
    """
    most = 64
    once = fresh(df.columns, "_once")
    walked = F.aggregate(F.sequence(F.lit(2), F.lit(most)), F.col(once), lambda at, _: F.when(at < F.col(n), at).otherwise(feistel(at, F.col(n), key, rounds)))
    out = df.withColumn(once, feistel(F.col(row), F.col(n), key, rounds))
    out = out.withColumn(place, F.when(F.col(once) < F.col(n), F.col(once)).otherwise(walked)).drop(once)
    return out.withColumn(place, F.when(F.col(place) < F.col(n), F.col(place)).otherwise(F.raise_error(F.lit("cycle walking did not end")).cast("long")))


def bucketed_numbers(df: DataFrame, keys: list[Column], order: list[Column], row: str, n: str, buckets: int, groups: list[str] | None = None) -> DataFrame:
    """df with ``row``, a number from 0 by a hash of ``keys`` and then ``order``, and ``n``, the number of rows.

    df is read twice, once for counts and once for numbers; both see the same rows if df is a table.
    """
    bucket, first, bucket_, count = (fresh([*df.columns, row, n], x) for x in ("_bucket", "_first", "_bucket2", "_count"))
    dealt = df.withColumn(bucket, F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    sizes = dealt.groupBy(F.col(bucket).alias(bucket_)).agg(F.count(F.lit(1)).alias(count))
    # Buckets are numbered in blocks, and only blocks, buckets / BLOCK rows, by one task.
    block, block_, before = (fresh([*df.columns, row, n, bucket_, count], x) for x in ("_block", "_block2", "_before"))
    sizes = sizes.withColumn(block, F.floor(F.col(bucket_) / BLOCK))
    everything = Window.orderBy(block_)
    blocks = sizes.groupBy(F.col(block).alias(block_)).agg(F.sum(count).alias(before))
    blocks = blocks.select(block_, (F.sum(before).over(everything) - F.col(before)).alias(before), F.sum(before).over(everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(n))
    offsets = sizes.withColumn(first, F.sum(count).over(Window.partitionBy(block).orderBy(bucket_)) - F.col(count)).join(F.broadcast(blocks), F.col(block) == F.col(block_))
    offsets = offsets.select(bucket_, (F.col(first) + F.col(before)).alias(first), n)
    if buckets <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    inside = Window.partitionBy(bucket).orderBy(*order)
    return (
        dealt.withColumn(row, F.row_number().over(inside).cast("long") - 1)
        .join(offsets, F.col(bucket) == F.col(bucket_))
        .withColumn(row, F.col(row) + F.col(first))
        .drop(bucket, first, bucket_)
    )


def shard(df: DataFrame, shards: int = 16, id: str = "doc_id", content: Column | None = None, key: str = "rolodeck", buckets: int | None = None, into: tuple[str, str] = ("shard", "slot")) -> DataFrame:
    """df with ``shard`` (int) and ``slot`` (long).

    content: a hash of the rest of the row that matters, by default of the column text; it tells rows of equal ids apart. Rows that are equal in id and content
    get neighbouring numbers, and which of them gets which is left open. A column of df that is named as one of ``into`` is an error; give other names then.
    buckets: of rows that are numbered together, by default as many as leave 100,000 rows to one, so that each is small whatever the table's size.
    """
    if buckets is None:
        buckets = max(1024, df.count() // 100_000)
    clash = {c.lower() for c in df.columns} & {c.lower() for c in into}
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already; choose others with into=")
    hash_, row, n, place = (fresh(df.columns, x) for x in ("_hash", "_row", "_n", "_place"))
    looked = df.withColumn(hash_, F.xxhash64(text_or_empty(F.col("text"))) if content is None else content)
    keys = [F.col(id), F.col(hash_)]
    numbered = bucketed_numbers(looked, [*keys, F.lit(key)], [F.xxhash64(*keys), *keys], row, n, buckets)
    placed = with_place(numbered, row, n, place, key)
    return placed.withColumns({into[0]: F.pmod(F.col(place), F.lit(shards)).cast("int"), into[1]: F.floor(F.col(place) / shards).cast("long")}).drop(hash_, row, n, place)


# --- the same permutation for single numbers, outside Spark


def _bases(n: int) -> tuple[int, int]:
    a = max(1, math.ceil(math.sqrt(n)))
    return a, max(1, -(-n // a))


def _hash(value: int, key: str) -> int:
    """Spark's xxhash64(value, key): the second is hashed with the first's hash as its seed."""
    import struct

    import xxhash

    return xxhash.xxh64_intdigest(key.encode(), xxhash.xxh64_intdigest(struct.pack("<q", value), 42))


def _half(value: int, key: str, modulus: int) -> int:
    h = _hash(value, key)
    return (h - (1 << 64) if h >> 63 else h) % modulus


def place_of(row: int, n: int, key: str = "rolodeck", rounds: int = ROUNDS) -> int:
    """The permuted number of row number ``row`` of n."""
    a, b = _bases(n)
    while True:
        left, right = divmod(row, b)
        for i in range(rounds):
            if i % 2 == 0:
                left = (left + _half(right, f"{key}/{i}", a)) % a
            else:
                right = (right + _half(left, f"{key}/{i}", b)) % b
        row = left * b + right
        if row < n:
            return row


def row_at(place: int, n: int, key: str = "rolodeck", rounds: int = ROUNDS) -> int:
    """The row number whose permuted number is ``place``: place_of backwards."""
    a, b = _bases(n)
    while True:
        left, right = divmod(place, b)
        for i in reversed(range(rounds)):
            if i % 2 == 0:
                left = (left - _half(right, f"{key}/{i}", a)) % a
            else:
                right = (right - _half(left, f"{key}/{i}", b)) % b
        place = left * b + right
        if place < n:
            return place

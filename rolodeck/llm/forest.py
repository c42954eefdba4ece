"""Nearest vectors by cosine, from a forest of hash prefixes.

Each tree has hash strings of ``BITS`` bits: the signs of a vector's products with the tree's own random directions. A tree is the sorted array of all vectors' strings, cut into *buckets* of equal leading bits, so many that a
bucket has about ``most`` vectors; larger ones (near copies share long prefixes) are dealt out in parts. Two vectors at an angle t share a prefix of x bits with probability (1 - t/pi)^x, whatever the data: nothing is fitted.

1. *Descend.* In each of the first few trees a query goes to its own bucket and there, by binary search, to the entries that share the longest prefix with it; it goes up bit by bit until ``start`` entries share what is left. The
   best of these give a first guess of how near its neighbours are.
2. *Ascend synchronously.* From these scores follows the longest prefix x, the same in all trees, at which the chance to have met a neighbour of such a score in some tree, 1 - (1 - p^x)^trees, is on average ``recall`` or more.
   Every entry that shares x bits with the query in any tree is then compared: near copies are found at long prefixes, neighbours that hardly stand out only at short ones. Where x is shorter than a bucket's prefix, all buckets
   below it are looked at; at x = 0 one tree has all there is.

No entry of a reached prefix is left out: there is no cap on candidates. The answer is approximate only in what no tree brought together. Equal vectors are one entry with their smallest ids (k + 1 of them, more can't matter), so
that copies cost nothing; a query takes its own id out at the end. Scores are double precision on the original components: sums of products over the product of the norms, the same for a pair wherever it is compared.

Cost: an entry is shuffled once for each tree, components included; a query once for each bucket that it looks at. On vectors without any structure neighbours hardly stand out and the reached prefixes are short: then much of the
table is compared, in blocks. Tasks hold one part of one bucket (``most`` entries at a time) and read its queries as a stream.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components, and rows without an id take no part; nor do vectors of another length than the query's. Rows equal in id and vector count once; rows of one id
and different vectors are rows of their own, and a query of that id leaves out only its own vector. Ids must be whole numbers. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .util import checkpointed, join_hot

BITS = 62
#: Of what is said about large buckets, up to so many rows are told to tasks by a broadcast (16 bytes each).
BROADCAST_BUCKETS = 100_000


def directions(tree: int, length: int, seed: int) -> np.ndarray:
    """The tree's random directions, BITS rows of so many components."""
    return np.random.default_rng((seed, tree, length)).standard_normal((BITS, length))


def hash_strings(vectors: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """The vectors' hash strings in a tree, the first bit leading, as numbers of BITS bits."""
    signs = vectors @ directions(tree, vectors.shape[1], seed).T > 0
    return signs @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows of a with rows of b; the same for a pair of rows whatever stands beside them."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def reach(scores: np.ndarray, trees: int, recall: float) -> int:
    """The longest prefix at which neighbours with such scores are met with an average chance of ``recall``."""
    if not len(scores):
        return 0
    p = 1 - np.arccos(np.clip(scores, -1, 1)) / math.pi
    for x in range(BITS, 0, -1):
        if 1 << x <= trees:
            break  # the trees' prefixes hold as much as the whole table
        if (1 - (1 - p**x) ** trees).mean() >= recall:
            return x
    return 0


def packed_rows(df: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, vec) of each different row that takes part; vec: the vector's components as bytes."""
    single = isinstance(df.schema[vector].dataType.elementType, T.FloatType)
    numpy, arrow = (np.float32, pa.float32()) if single else (np.float64, pa.float64())
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    rows = df.filter(F.col(id).isNotNull() & F.col(vector).isNotNull()).filter(F.coalesce(finite, F.lit(False))).select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<float>" if single else "array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            flat = lists.flatten().cast(arrow).to_numpy(zero_copy_only=False).astype(numpy) + numpy(0)  # -0 becomes 0
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            size = np.dtype(numpy).itemsize
            offsets = np.append(0, ends * size).astype(np.int64)
            packed = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))])
            yield pa.RecordBatch.from_arrays([batch.column("id"), packed.cast(pa.binary())], names=["id", "vec"])

    return rows.mapInArrow(run, "id long, vec binary").distinct()


def distinct_vectors(rows: DataFrame, most: int) -> DataFrame:
    """(vec, ids) of each different vector; ids: its smallest ones, so many at most."""
    first = rows.withColumn("n", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).filter(F.col("n") <= most)
    return first.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def _matrix(column: pa.ChunkedArray | pa.Array, wide: bool) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.float64 if wide else np.float32).reshape(len(column), -1).astype(np.float64)


class Part:
    """A part of a bucket: its entries in order of their hash strings."""

    def __init__(self, strings: np.ndarray, vectors: np.ndarray, ids: list, keys: list):
        order = np.argsort(strings, kind="stable")
        self.strings, self.vectors = strings[order], vectors[order]
        self.ids, self.keys = [ids[i] for i in order], [keys[i] for i in order]
        self.units = self.vectors / np.sqrt((self.vectors * self.vectors).sum(axis=1))[:, None]

    def shared(self, string: int, bits: int) -> tuple[int, int]:
        """From where to where the entries share so many leading bits with the string."""
        low = (string >> (BITS - bits)) << (BITS - bits)
        return int(np.searchsorted(self.strings, low)), int(np.searchsorted(self.strings, low + (1 << (BITS - bits))))

    def descend(self, string: int, least: int) -> tuple[int, int]:
        """The entries that share the longest prefix that at least so many share."""
        low, high = 0, BITS
        while low < high:  # the number of entries falls with the prefix's length
            bits = (low + high + 1) // 2
            a, b = self.shared(string, bits)
            low, high = (bits, high) if b - a >= least else (low, bits - 1)
        return self.shared(string, low)

    def best(self, query: np.ndarray, at: tuple[int, int], k: int) -> list[tuple[float, int]]:
        """(score, entry) of the k nearest of the entries, nearest first, equal ones by their smallest id."""
        a, b = at
        if a >= b:
            return []
        rough = self.units[a:b] @ (query / math.sqrt(float(query @ query)))
        rows = np.arange(a, b)
        if b - a > k:  # what rounding might put among the first k
            rows = rows[rough >= np.partition(rough, b - a - k)[b - a - k] - 1e-9]
        score = cosines(self.vectors[rows], np.broadcast_to(query, (len(rows), len(query))))
        order = sorted(range(len(rows)), key=lambda i: (-score[i], self.ids[rows[i]][0]))[:k]
        return [(float(score[i]), int(rows[i])) for i in order]


def _searched(work: DataFrame, k: int, least: int | None, seed: int, wide: bool) -> DataFrame:
    """(query, score, ids): for each query, in each part of a bucket that it looks at, the best entries.

    work: rows of entries (kind 0) and queries (kind 1, with the query's key and the length x of the prefix), sorted so that a part's entries come before its queries. least: descend until so many share a prefix; None: take x.
    """
    keys = ("dim", "tree", "top", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, part = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy() for c in (*keys, "kind")]
            new = np.zeros(batch.num_rows, bool)
            new[0] = True
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            cuts = [*np.flatnonzero(new).tolist(), batch.num_rows]
            out: list[tuple] = []
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                key, rows = tuple(int(c[start]) for c in columns[:-1]), batch.slice(start, end - start)
                if key != now:
                    now, held, part = key, [], None
                if columns[-1][start] == 0:
                    held.append(rows)
                    continue
                if not held:
                    continue  # nobody lives here
                vectors = _matrix(rows.column("vec"), wide)
                strings = hash_strings(vectors, key[1], seed).tolist()
                if part is None:
                    entries = pa.Table.from_batches(held)
                    own = _matrix(entries.column("vec"), wide)
                    part = Part(hash_strings(own, key[1], seed), own, entries.column("ids").to_pylist(), entries.column("key").to_pylist())
                for string, vector, query, x in zip(strings, vectors, rows.column("key").to_pylist(), rows.column("x").to_pylist(), strict=True):
                    at = part.descend(string, min(least, len(part.strings))) if least is not None else part.shared(string, x)
                    out += [(query, score, part.ids[i], part.keys[i]) for score, i in part.best(vector, at, k + 1)]
            if out:
                query, score, ids, key_ = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(query, pa.binary()), pa.array(score, pa.float64()), pa.array(ids, pa.list_(pa.int64())), pa.array(key_, pa.binary())], names=["query", "score", "ids", "key"])

    order = (*keys, "kind")
    return work.repartition(*keys).sortWithinPartitions(*order).mapInArrow(run, "query binary, score double, ids array<long>, key binary")


def _best(found: DataFrame, k: int) -> DataFrame:
    """(query, best): the k + 1 nearest different vectors of each query, over all trees and parts."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0], "key")
    once = found.groupBy("query", "key").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
    first = once.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
    return first.groupBy("query").agg(F.collect_list(F.struct("score", "ids", "key")).alias("best"))


def nearest(df: DataFrame, queries: DataFrame, k: int = 5, id: str = "vec_id", vector: str = "embedding", trees: int = 32, first: int = 8, start: int = 256, recall: float = 0.9, most: int = 16_384, seed: int = 1) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of queries the k nearest rows of df, without the row itself.

    queries: rows of df's form that are rows of df too. first: trees to descend in; start: entries to go up to there. recall: the average chance to meet a neighbour that decides how far to go up.
    """
    wide = not isinstance(df.schema[vector].dataType.elementType, T.FloatType)
    key = F.unhex(F.sha2("vec", 256)).alias("key")  # names a vector in results
    dim = F.expr(f"octet_length(vec) div {8 if wide else 4}").cast("int").alias("dim")
    nodes = checkpointed(distinct_vectors(packed_rows(df, id, vector), k + 1).select("vec", "ids", key, dim))
    top = max(0, math.ceil(math.log2(max(1, nodes.count()) / most)))  # leading bits that name a bucket
    who = checkpointed(packed_rows(queries, id, vector).select(F.col("id").alias("query_id"), "vec", key, dim))
    asks = checkpointed(who.select("vec", "key", "dim").distinct())

    def with_buckets(rows: DataFrame, over: int) -> DataFrame:
        """A row for each of the first ``over`` trees (or, where x is 0, for one), with the bucket that the vector lies in."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                dims = batch.column("dim").to_numpy()
                x = batch.column("x").to_numpy()
                for dim in np.unique(dims):
                    rows = batch.filter(pa.array(dims == dim))
                    vectors = _matrix(rows.column("vec"), wide)
                    for tree in range(over):
                        mine = np.ones(rows.num_rows, bool) if tree == 0 else x[dims == dim] != 0
                        if not mine.any():
                            continue
                        strings = hash_strings(vectors[mine], tree, seed)
                        part = rows.filter(pa.array(mine))
                        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(part.num_rows, tree, np.int32)), pa.array(strings >> (BITS - top))], names=[*part.schema.names, "tree", "own"])

        schema = T.StructType([*rows.schema.fields, T.StructField("tree", T.IntegerType()), T.StructField("own", T.LongType())])
        return rows.mapInArrow(run, schema)

    def search(asked: DataFrame, over: int, least: int | None) -> DataFrame:
        """asked: queries with x, the length of the prefix to look at."""
        entries = with_buckets(nodes.withColumn("x", F.lit(BITS)), over).withColumnRenamed("own", "top")
        sizes = entries.groupBy("dim", "tree", "top").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
        large = checkpointed(sizes.select(F.struct("dim", "tree", "top").alias("bucket"), F.ceil(F.col("n") / most).cast("long").alias("parts"), F.col("n").alias("rows")))
        few = large.count() <= BROADCAST_BUCKETS
        looked = with_buckets(asked.withColumn("ids", F.lit(None).cast("array<long>")), over)
        step = F.greatest(F.lit(top) - F.col("x"), F.lit(0))
        below = F.expr("sequence(0L, shiftleft(1L, step) - 1)")  # where x is shorter than a bucket's prefix, all buckets below
        looked = looked.withColumn("step", step).withColumn("add", F.explode(below)).withColumn("top", F.expr("shiftleft(shiftright(own, step), step) + add"))
        columns = ["dim", "tree", "top", "kind", "key", "vec", "ids", "x"]

        def dealt(rows: DataFrame, kind: int) -> DataFrame:
            rows = rows.withColumn("kind", F.lit(kind)).select(*columns, F.struct("dim", "tree", "top").alias("in"))
            told = F.broadcast(large) if few else large
            rows = rows.join(told, F.col("in") == F.col("bucket"), "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
            part = F.array(F.pmod(F.xxhash64("key"), F.col("parts"))) if kind == 0 else F.expr("sequence(0L, parts - 1)")
            return rows.select(*columns, F.explode(part).alias("part"))

        return _searched(dealt(entries, 0).unionByName(dealt(looked, 1)), k, least, seed, wide)

    guess = _best(search(asks.withColumn("x", F.lit(BITS)), min(first, trees), start), k)

    def levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = []
            for best in batch.column("best").to_pylist():
                scores = [s for b in sorted(best, key=lambda b: -b["score"]) for s in [b["score"]] * len(b["ids"])][1 : k + 1]  # without the query itself
                x.append(reach(np.array(scores), trees, recall) if len(scores) == k else 0)
            yield pa.RecordBatch.from_arrays([batch.column("query"), pa.array(x, pa.int32())], names=["query", "x"])

    level = checkpointed(guess.mapInArrow(levels, "query binary, x int"))
    asked = asks.join(level, F.col("key") == F.col("query")).select("vec", "key", "dim", "x")
    found = checkpointed(_best(search(asked, trees, None), k))

    # A vector's k + 1 nearest ids, once for each id that asks; a vector that many ask for is a hot key.
    every = F.flatten(F.transform("best", lambda b: F.transform(b["ids"], lambda i: F.struct((-b["score"]).alias("far"), i.alias("id"), (b["key"] == F.col("query")).alias("own")))))
    near = found.select("query", F.slice(F.array_sort(every), 1, k + 1).alias("near"))
    weights = who.groupBy(F.col("key").alias("key_")).agg(F.count(F.lit(1)).alias("weight"))
    told = checkpointed(near.join(weights, F.col("query") == F.col("key_")).select("query", "near", "weight"))
    answers = join_hot(who.select("query_id", "key"), told, ("key", "query"), "weight", who.count())
    others = F.slice(F.filter("near", lambda n: ~(n["own"] & (n["id"] == F.col("query_id")))), 1, k)
    ranked = answers.select("query_id", F.posexplode(others).alias("rank", "n"))
    return ranked.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("n.id").alias("vec_id"), (-F.col("n.far")).alias("score"))

"""SimHash near-duplicate detection over a Gray-order hierarchical index.

A document's fingerprint has a bit set where over half of its shingles' 64-bit hashes have it set. Two documents
are linked if their fingerprints differ in at most ``max_bits`` bits, and a group is all that links reach.

How links are found, without ever comparing all fingerprints with each other:

1. Equal fingerprints collapse into one *node*. A third of all documents may be copies of one text: they cost one
   node, made by an aggregation that combines before it shuffles.
2. The 64 bits are cut into blocks. Fingerprints within ``max_bits`` agree on at least ``blocks - max_bits`` blocks,
   so each node goes to one *upper group* for each choice of that many blocks, keyed by the masked bit pattern. This
   is the index's top level, and the only one that is shuffled: fingerprints, never text. (``near_copies`` uses the same index over
   wider fingerprints with other masks.)
3. Inside a task, the nodes of an upper group are sorted by Gray rank, so that neighbours share most bits. Each run
   of ``fan`` neighbours becomes an index node that holds the bits that all of them share and its parent does not
   hold yet; runs of runs follow, up to one root. A search starts at the root and adds up the differing bits of the
   shared patterns on its way; a group whose sum exceeds ``max_bits`` is pruned whole. At a leaf the masks of the path
   cover all 64 bits, so the sum is the exact distance.
4. A task returns no pairs: it merges the links of an upper group at once and returns, for each node, the smallest
   fingerprint of its part. Upper groups of more than ``most`` nodes are dealt out as blocks of nodes against blocks, each a
   task's work, exact as well.
5. Components over these star-shaped edges come from alternating large-star and small-star steps, all of them joins
   and aggregations of Spark, with a reliable checkpoint after each.
6. Joins by a fingerprint or a star's centre, which may hold a third of all rows, are ``join_hot``: heavy keys never meet in one task.

Defined results: a null or word-less text has fingerprint zero and is linked like any other. Repeated rows stay,
each with its own row. A null id is a row as any other; ``component`` is the smallest non-null id reachable, null if
there is none. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..cluster import without_hot
from ..operators.graph import components
from .util import binary, checkpointed, extended, fresh, join_hot, text_slices

#: Of a group of nodes that is dealt out in blocks, up to so many blocks are told to tasks by a broadcast (16 bytes each).
BROADCAST_GROUPS = 100_000


def fingerprint(text: bytes | None, words: int, seed: int = 42) -> int:
    """The SimHash of one text, as an unsigned number."""
    import xxhash

    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(1, len(tokens) - words + 1)
    tails = ends[min(words, len(tokens)) - 1 :]
    digest = xxhash.xxh64_intdigest
    bits = np.zeros(64, np.int64)
    for at in range(0, last, 1 << 16):  # so that a very long text takes bounded memory
        spans = zip(starts[at : at + (1 << 16)].tolist(), tails[at : at + (1 << 16)].tolist(), strict=False)
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64)
        bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > last, bitorder="little").view(np.uint64)[0])


def with_fingerprint(df: DataFrame, text: str, name: str, words: int, seed: int = 42) -> DataFrame:
    """df and a column ``name``: the fingerprint's 64 bits as a signed long. Narrow: no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text):
            prints = np.array([fingerprint(t, words, seed) for t in binary(batch.column(text))], np.uint64)
            kept = [i for i, c in enumerate(batch.schema.names) if c != text]
            out = [batch.column(i) for i in kept]
            yield pa.RecordBatch.from_arrays([*out, pa.array(prints.view(np.int64))], names=[*(batch.schema.names[i] for i in kept), name])

    schema = extended(df.drop(text), [T.StructField(name, T.LongType())])
    return df.mapInArrow(run, schema)


def gray_rank(prints: np.ndarray) -> np.ndarray:
    """The place of each bit pattern in Gray order, where neighbours differ in one bit. prints: words (the first one leading) x patterns."""
    rank = prints.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    odd = np.bitwise_xor.accumulate(rank & np.uint64(1), axis=0)  # whether the words so far have an odd number of bits
    rank[1:] ^= np.uint64(0) - odd[:-1]
    return rank


class GrayIndex:
    """Index of many groups of fingerprints at once; a search stays inside its own group.

    ``group`` numbers the rows' groups (0, 1, ..., ascending); prints are words x rows, and rows of a group are sorted by Gray rank.
    """

    def __init__(self, group: np.ndarray, prints: np.ndarray, fan: int = 8):
        levels = [(group, prints, np.full(prints.shape, ~np.uint64(0)))]  # group, shared bits, mask of what is shared
        self.children: list[tuple[np.ndarray, np.ndarray]] = []  # of each node one level up: first child, end
        while len(levels[-1][0]) > (levels[-1][0][-1] + 1 if len(levels[-1][0]) else 0):
            of, bits, mask = levels[-1]
            first = np.concatenate([[True], of[1:] != of[:-1]])
            start = np.flatnonzero(first)
            place = np.arange(len(of)) - start[of]
            cut = np.flatnonzero(place % fan == 0)
            ones, zeros = np.bitwise_and.reduceat(bits & mask, cut, axis=1), np.bitwise_and.reduceat(~bits & mask, cut, axis=1)
            self.children.append((cut, np.append(cut[1:], len(of))))
            levels.append((of[cut], ones, ones | zeros))
        #: From the top down: each node's bits and the part of its mask that its parent has not.
        self.levels = []
        for depth in range(len(levels) - 1, -1, -1):
            _, bits, mask = levels[depth]
            if depth < len(levels) - 1:
                above, (start, end) = levels[depth + 1][2], self.children[depth]
                mask = mask & ~np.repeat(above, end - start, axis=1)
            self.levels.append((bits & mask, mask))
        self.children.reverse()

    def search(self, queries: np.ndarray, roots: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query number, leaf number) at a distance of at most ``most``."""
        query, node, apart = np.arange(queries.shape[1]), roots, np.zeros(queries.shape[1], np.int16)
        for depth, (bits, mask) in enumerate(self.levels):
            if depth:
                start, end = self.children[depth - 1]
                size = end[node] - start[node]
                query, apart = np.repeat(query, size), np.repeat(apart, size)
                node = np.repeat(start[node] - np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else start[node], size) + np.arange(len(query))
            for k in range(len(queries)):  # word by word: what differs too much already is not looked at further
                apart = apart + np.bitwise_count((queries[k][query] ^ bits[k][node]) & mask[k][node])
                if k == len(queries) - 1 or 64 * k > most:
                    keep = apart <= most
                    if not keep.all():
                        query, node, apart = query[keep], node[keep], apart[keep]
        return query, node


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Gives all that the pairs (a, b) connect, beside what label connects already, its smallest number as label."""
    while len(a):
        while True:  # each label points at its root
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up
        a, b = label[a], label[b]
        low, high = np.minimum(a, b), np.maximum(a, b)
        open_ = low < high
        if not open_.any():
            return
        pairs = np.unique(np.stack([low[open_], high[open_]], axis=1), axis=0)
        a, b = pairs[:, 0], pairs[:, 1]
        np.minimum.at(label, b, a)
    return


def group_roots(group: np.ndarray, side: np.ndarray, prints: np.ndarray, most: int, fan: int = 8, work: int = 1 << 20) -> np.ndarray:
    """For each row the smallest row number of its linked part within its group; rows are sorted by group and Gray rank.

    side: 1 or 2 where a group is one block of nodes against another (only links between them matter), else 0.
    """
    label = np.arange(prints.shape[1])
    if not len(label):
        return label
    index = GrayIndex(group, prints, fan)
    size = np.bincount(group)
    asks = np.flatnonzero((side != 2) & (size[group] > 1))
    cost = np.cumsum(size[group[asks]])  # search in portions of bounded work
    at = 0
    while at < len(asks):
        end = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + work, "right")))
        rows = asks[at:end]
        query, leaf = index.search(prints[:, rows], group[rows], most)
        query = rows[query]
        wanted = (leaf > query) | (side[query] != side[leaf])
        merge(label, query[wanted], leaf[wanted])
        at = end
    while not np.array_equal(up := label[label], label):
        label = up
    return label


def masks(max_bits: int, blocks: int) -> list[list[int]]:
    """The masks of the upper groups: all choices of ``blocks - max_bits`` of the blocks of 64 bits. Each has one word."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    return [[sum(choice)] for choice in combinations(parts, blocks - max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def dealt_in_blocks(rows: DataFrame, parts: Column, spread: Column) -> DataFrame:
    """rows and ``low``, ``high``, ``side``: each row once for each of its group's ``parts`` blocks, so that each block meets each other one once.

    spread: a hash that deals a group's rows to its blocks. side: 0 where a block meets itself, else 1 or 2.
    """
    own, other = F.pmod(spread, F.col("parts_")), F.col("other_")
    dealt = rows.withColumn("parts_", parts).withColumn("other_", F.explode(F.expr("sequence(0L, parts_ - 1)")))
    side = F.when(own == other, 0).when(own < other, 1).otherwise(2).cast("int")
    return dealt.withColumns({"low": F.least(own, other), "high": F.greatest(own, other), "side": side}).drop("parts_", "other_")


def in_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], held_rows: int = 200_000, held_bytes: int = 64 << 20) -> Iterator[pa.Table]:
    """Tables of whole groups, of rows that are sorted by keys: many small groups at once, or one large one."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows < held_rows and size < held_bytes:
            continue
        table = pa.Table.from_batches(held)
        last = np.ones(rows, bool)
        for k in keys:
            column = table.column(k).to_numpy()
            last &= column == column[-1]
        cut = int(np.argmax(last))  # all but the last group is whole
        if cut:
            yield table.slice(0, cut)
            rest = table.slice(cut).combine_chunks()
            held, rows, size = rest.to_batches(), rest.num_rows, rest.nbytes
    if rows:
        yield pa.Table.from_batches(held)


def numbered_groups(table: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    """0, 1, ... for the groups of a table sorted by keys."""
    new = np.zeros(table.num_rows, bool)
    for k in keys:
        column = table.column(k).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.cumsum(new)


def star_edges(nodes: DataFrame, words: list[str], masks: list[list[int]], max_bits: int, most: int) -> DataFrame:
    """(node, root) with root < node, for what the upper groups link. nodes: ``node`` (long, distinct) and the fingerprints' words (longs).

    Groups of over ``most`` nodes are split into blocks of about most / 2; each block meets each other one once.
    """
    kinds = F.array(*[F.struct(F.lit(i).alias("i"), *[F.lit(_signed(m)).alias(f"m{k}") for k, m in enumerate(mask)]) for i, mask in enumerate(masks)])
    key = F.xxhash64("mask.i", *[F.col(w).bitwiseAND(F.col(f"mask.m{k}")) for k, w in enumerate(words)])
    keyed = nodes.select("node", *words, F.explode(kinds).alias("mask")).select("node", *words, key.alias("key"))
    parts = F.lit(1).cast("long")
    if (count := nodes.count()) > most:
        sizes = keyed.groupBy(F.col("key").alias("key_")).agg(F.count(F.lit(1)).alias("n_"))
        large = checkpointed(sizes.filter(F.col("n_") > most))
        if n := large.count():
            if n <= BROADCAST_GROUPS:
                keyed = keyed.join(F.broadcast(large), F.col("key") == F.col("key_"), "left")
            else:
                hot = (large, ("key", "key_"), "n_", count * len(masks))
                keyed = join_hot(keyed, *hot).unionByName(without_hot(keyed, *hot), allowMissingColumns=True)
            parts = F.coalesce(F.ceil(F.col("n_") / F.lit(most / 2)).cast("long"), parts)
    dealt = dealt_in_blocks(keyed, parts, F.xxhash64("node", F.lit(7))).select("key", "low", "high", "side", "node", *words)
    keys = ("key", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in in_groups(batches, keys):
            group = numbered_groups(table, keys)
            prints = np.stack([table.column(w).to_numpy().view(np.uint64) for w in words])
            order = np.lexsort((*gray_rank(prints)[::-1], group))
            node, side = table.column("node").to_numpy()[order], table.column("side").to_numpy()[order]
            label = group_roots(group[order], side, prints[:, order], max_bits)
            least = node.copy()  # the smallest of each linked part
            np.minimum.at(least, label, node)
            root = least[label]
            away = root != node
            yield pa.RecordBatch.from_arrays([pa.array(node[away]), pa.array(root[away])], names=["node", "root"])

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "node long, root long").filter("root < node")


def simhash_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 4, max_bits: int = 4, blocks: int = 6, most: int = 20_000, seed: int = 42) -> DataFrame:
    """One row for each document: ``id``, ``fingerprint`` (signed long), ``component`` (smallest id reachable).

    docs may have any other columns. id must be whole numbers. most: nodes of an upper group that one task takes.
    """
    d = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    prints = checkpointed(with_fingerprint(d, "text", "print", words, seed))
    nodes = checkpointed(prints.groupBy(F.col("print").alias("node")).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")))
    found = components(star_edges(nodes.withColumn("print", F.col("node")), ["print"], masks(max_bits, blocks), max_bits, most)).withColumnRenamed("node", "node_")
    placed = checkpointed(nodes.join(found, F.col("node") == F.col("node_"), "left").select("node", "first", "copies", F.coalesce("component", "node").alias("part")))
    least = placed.groupBy(F.col("part").alias("part_")).agg(F.min("first").alias("component"), F.count(F.lit(1)).alias("nodes"))
    total = nodes.agg(F.count(F.lit(1)).alias("nodes"), F.coalesce(F.sum("copies"), F.lit(0)).alias("rows")).first()
    named = checkpointed(join_hot(placed, least, ("part", "part_"), "nodes", total.nodes).select("node", "component", "copies"))
    out = join_hot(prints, named, ("print", "node"), "copies", total.rows)
    return out.select(F.col("id").alias(id), F.col("print").alias("fingerprint"), "component")

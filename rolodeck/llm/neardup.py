"""Near copies by word shingles: SimHash candidates from the Gray-order index, each confirmed by exact Jaccard similarity.

A document's shingles are its runs of ``words`` lower-cased words (a shorter text is one shingle), each taken once, as 64-bit hashes. Two documents
are linked if their sets of shingles have a Jaccard similarity of at least ``similarity``, and a group is all that links reach.

1. Equal sets collapse into one *node*, so exact copies cost one.
2. A node has a SimHash fingerprint of 256 bits. Sets of similarity s have vectors whose cosine is 2s / (1 + s) or more, so each bit differs with a
   probability of at most arccos(2s / (1 + s)) / pi: 0.15 for 0.8. That is 39 bits of 256, and four standard deviations more are searched.
3. Candidates come from ``simhash.star_edges``: upper groups are the patterns under masks of random bits, as many bits as leave about ``fill`` nodes to a
   pattern, and as many masks as let a share ``recall`` of drawn pairs of the wanted similarity have a pattern in common. Inside, the Gray-order index prunes by
   accumulated differences. More similar pairs are found with a probability nearer to 1. This is the search's only approximation.
4. What the candidates connect is a *cluster*. Inside a cluster every two sets are compared exactly, shingle by shingle through an inverted list, never one pair
   at a time; clusters that are too large for a task are dealt out as blocks against blocks. Links are merged at once and leave as stars.

Cost: masks grow as the number of nodes to the power 0.24 (see README); fingerprints and hashes move. Texts move once, for the rows that stay. The sets of clusters of two nodes or more are made where the texts are read: a
Bloom filter of fixed size, made of the rows that the nodes name, picks them out, and of repeated rows a task makes one set.

Defined results: all null or word-less texts are one node. Repeated rows and null ids are rows as any other: one row of each group stays. An empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .simhash import components, dealt_in_blocks, in_groups, merge, numbered_groups, star_edges
from .util import KeyFilter, binary, checkpointed, extended, fresh, join_hot, text_slices

WIDTH = 4  # words of 64 bits in a fingerprint
PRINT = [f"p{k}" for k in range(WIDTH)]
ROUND = 1e-9  # of floating-point products
_TIMES = np.random.default_rng(11).integers(0, 1 << 63, (2, WIDTH), dtype=np.uint64) << np.uint64(1) | np.uint64(1)


class _Codes(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= 1 << 18:  # some 40 MB
            self.clear()
        code = self[word] = xxhash.xxh64_intdigest(word, 42)
        return code


_codes = _Codes()


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """The hashes of a text's distinct shingles, ascending."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(_codes.__getitem__, tokens), np.uint64, len(tokens))
    n = max(1, len(tokens) - words + 1)
    found = np.full(n, min(words, len(tokens)), np.uint64)
    for i in range(min(words, len(tokens))):
        found = (found * np.uint64(0x9E3779B97F4A7C15)) ^ (found >> np.uint64(31))
        found += codes[i : i + n]
    found.sort()
    return found[np.concatenate([[True], found[1:] != found[:-1]])]


def fingerprint(found: np.ndarray) -> np.ndarray:
    """The SimHash of a set of shingles: a bit is set where over half of the shingles' hashes have it set."""
    counts = np.zeros(64 * WIDTH, np.int64)
    for at in range(0, len(found), 255):  # sums of so few bits fit a byte
        part = found[at : at + 255, None]
        mixed = (part ^ (part >> np.uint64(32))) * _TIMES[0]
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _TIMES[1]
        mixed ^= mixed >> np.uint64(32)
        counts += np.unpackbits(mixed.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(found), bitorder="little").view(np.uint64)


def with_prints(df: DataFrame, text: str, words: int) -> DataFrame:
    """df without text, and ``node`` (a hash of the set of shingles), ``size`` (of that set) and the fingerprint's words. Narrow: no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in text_slices(batches, text):
            sets = [shingles(t, words) for t in binary(batch.column(text))]
            nodes = np.array([xxhash.xxh64_intdigest(s.tobytes(), 7) for s in sets], np.uint64).view(np.int64)
            prints = np.stack([fingerprint(s) for s in sets]).view(np.int64)
            kept = [i for i, c in enumerate(batch.schema.names) if c != text]
            columns = [*(batch.column(i) for i in kept), pa.array(nodes), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(prints[:, k]) for k in range(WIDTH))]
            yield pa.RecordBatch.from_arrays(columns, names=[*(batch.schema.names[i] for i in kept), "node", "size", *PRINT])

    return df.mapInArrow(run, extended(df.drop(text), [T.StructField(c, T.LongType()) for c in ("node", "size", *PRINT)]))


def named_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, shingles) of the rows that wanted names. docs: id, text, content; wanted: node, id_, content_, a row for each node."""
    key = lambda *c: F.xxhash64(*c).alias("key")
    told = docs.sparkSession.sparkContext.broadcast(KeyFilter.of(wanted.select(key("id_", "content_")), "key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in text_slices(batches, "text"):
            rows = batch.filter(pa.array(told.value.has(batch.column("key").to_numpy())))
            names = list(zip(rows.column("id").to_pylist(), rows.column("content").to_pylist(), strict=True))
            new = [i for i, n in enumerate(names) if n not in seen and not seen.add(n)]
            rows = rows.take(pa.array(new, pa.int64()))
            sets = [shingles(t, words).tobytes() for t in binary(rows.column("text"))]
            yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("content"), pa.array(sets, pa.binary())], names=["id", "content", "shingles"])

    found = docs.select("id", "content", "text", key("id", "content")).mapInArrow(run, "id long, content long, shingles binary")
    same = F.col("id").eqNullSafe(F.col("id_")) & (F.col("content") == F.col("content_"))
    return found.join(wanted, same).select("node", "shingles").dropDuplicates(["node"])


def bit_odds(similarity: float) -> float:
    """The greatest probability that a bit differs between sets of that similarity."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def search_plan(nodes: int, similarity: float, recall: float, fill: int) -> tuple[list[list[int]], int]:
    """The masks and the distance up to which fingerprints are candidates.

    Masks cut from one shuffle of all bits share none, but later ones do, so that they don't find pairs independently: how many are needed is counted
    on drawn pairs of that similarity.
    """
    odds, width = bit_odds(similarity), 64 * WIDTH
    distance = math.ceil(width * odds + 4 * math.sqrt(width * odds * (1 - odds)))
    bits = max(8, math.ceil(math.log2(max(2, nodes) / fill)))
    rng, chosen, waiting = np.random.default_rng(5), [], []
    apart = rng.random((20_000, width)) < odds
    missed = np.ones(len(apart), bool)
    while missed.mean() > 1 - recall:
        if not waiting:
            shuffled = rng.permutation(width).tolist()
            waiting = [shuffled[at : at + bits] for at in range(0, width - bits + 1, bits)]
        chosen.append(waiting.pop())
        missed &= apart[:, chosen[-1]].any(axis=1)
    return [[sum(1 << b % 64 for b in mask if b // 64 == k) for k in range(WIDTH)] for mask in chosen], distance


def set_roots(sets: list[np.ndarray], side: np.ndarray, similarity: float, work: int = 1 << 22) -> np.ndarray:
    """For each set the smallest number of its linked part. side: 1 or 2 where only links between the two sides matter, else 0."""
    label, sizes = np.arange(len(sets)), np.array([len(s) for s in sets])
    if len(sets) < 2 or not sizes.sum():
        return label
    owner = np.repeat(label, sizes)
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1  # a shingle of one set alone is in no intersection
    kept = shared[column]
    column, owner, counts = (np.cumsum(shared) - 1)[column[kept]], owner[kept], counts[shared]
    # A product of 0/1 matrices costs some 0.1 ns a cell, an inverted list some 15 ns an entry; the first only while numbers are exact.
    dense = len(sets) ** 2 * len(counts) < 150 * (counts.astype(np.float64) ** 2).sum() and sizes.max() < 1 << 24
    for at, both in (_products if dense else _listed)(column, owner, counts, len(sets), work):
        a, b = np.nonzero(both)
        n = both[a, b]
        a = a + at
        linked = (b > a) & ((side[a] == 0) | (side[a] != side[b])) & (n + ROUND >= similarity * (sizes[a] + sizes[b] - n))
        merge(label, a[linked], b[linked])
    while not np.array_equal(up := label[label], label):
        label = up
    return label


def _products(column: np.ndarray, owner: np.ndarray, counts: np.ndarray, n: int, work: int) -> Iterator[tuple[int, np.ndarray]]:
    """The sizes of all intersections, (first set, sizes of it and those after it against all), by matrix products over slices of the shingles."""
    step = max(1, work // n)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((n, n), np.float32)
    for first in range(0, len(counts), step):
        a, b = np.searchsorted(column, [first, first + step])
        cells = np.zeros((n, min(step, len(counts) - first)), np.float32)
        cells[owner[a:b], column[a:b] - first] = 1
        both += cells @ cells.T
    yield 0, both


def _listed(column: np.ndarray, owner: np.ndarray, counts: np.ndarray, n: int, work: int) -> Iterator[tuple[int, np.ndarray]]:
    """The same in portions of sets, by inverted lists."""
    listed = owner[np.argsort(column, kind="stable")]  # the lists, one after another
    start = np.cumsum(counts) - counts
    ends = np.searchsorted(owner, np.arange(n), "right")
    cost = np.cumsum(np.bincount(owner, weights=counts[column], minlength=n) + n)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + work, "right")))
        asked = slice(ends[at - 1] if at else 0, ends[end - 1])
        length, first = counts[column[asked]], start[column[asked]]
        places = np.repeat(first - (np.cumsum(length) - length), length) + np.arange(length.sum())
        yield at, np.bincount((np.repeat(owner[asked], length) - at) * n + listed[places], minlength=(end - at) * n).reshape(end - at, n)
        at = end


def set_links(members: DataFrame, sets: DataFrame, similarity: float, most: int, most_shingles: int) -> DataFrame:
    """(node, root) for the exact links inside clusters. members: node, cluster, size; sets: node, shingles, one row for each node of members.

    A cluster of over 128 nodes is dealt out in up to 16 blocks, so that tasks share it; none has over most / 2 nodes or about most_shingles / 2 shingles.
    """
    clusters = checkpointed(members.groupBy(F.col("cluster").alias("cluster_")).agg(F.count(F.lit(1)).alias("n_"), F.sum("size").alias("size_")))
    n, size = F.col("n_"), F.col("size_")
    parts = F.greatest(F.least(F.ceil(n / 64), F.lit(16)), F.ceil(n / F.lit(most / 2)), F.least(n, F.ceil(size / F.lit(most_shingles / 2)))).cast("long")
    placed = join_hot(members, clusters, ("cluster", "cluster_"), "n_", members.count())
    dealt = dealt_in_blocks(placed, F.when((n <= 128) & (size <= most_shingles), F.lit(1).cast("long")).otherwise(parts), F.xxhash64("node", F.lit(9)))
    dealt = dealt.select("cluster", "low", "high", "side", F.col("node").alias("node_"))
    sets = checkpointed(sets)
    keys = ("cluster", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in in_groups(batches, keys):
            group, node, side = numbered_groups(table, keys), table.column("node").to_numpy(), table.column("side").to_numpy()
            found = table.column("shingles").to_pylist()
            edges = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
            nodes, roots = [], []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                label = set_roots([np.frombuffer(x, np.uint64) for x in found[a:b]], side[a:b], similarity)
                least = node[a:b].copy()
                np.minimum.at(least, label, node[a:b])
                away = least[label] != node[a:b]
                nodes.append(node[a:b][away])
                roots.append(least[label][away])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes)), pa.array(np.concatenate(roots))], names=["node", "root"])

    moved = dealt.join(sets, F.col("node_") == F.col("node")).select(*keys, "side", "node", "shingles")
    return moved.repartition(*keys).sortWithinPartitions(*keys, "node").mapInArrow(run, "node long, root long")


def content_hash(text: str) -> Column:
    """The hash that tells rows of one id apart; null counts as an empty text."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def near_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, similarity: float = 0.8, recall: float = 0.999, fill: int = 128, most: int = 4_000, most_shingles: int = 4 << 20) -> tuple[DataFrame, DataFrame]:
    """The nodes and the links' components.

    (1) node, size and ``first``, the row with the smallest id (struct missing, id, hash; nulls last, ties by a hash of the text);
    (2) node, component: the smallest node that links reach, for nodes that have links.
    """
    d = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"), content_hash(text).alias("content"))
    prints = checkpointed(with_prints(d, "text", words))
    first = F.min(F.struct(F.col("id").isNull().alias("missing"), F.col("id").alias("id"), F.col("content").alias("hash")))
    nodes = checkpointed(prints.groupBy("node").agg(first.alias("first"), *[F.min(c).alias(c) for c in ("size", *PRINT)]))
    plan, distance = search_plan(nodes.count(), similarity, recall, fill)
    clusters = components(star_edges(nodes, PRINT, plan, distance, most=20_000)).withColumnRenamed("node", "node_")
    members = checkpointed(nodes.join(clusters, F.col("node") == F.col("node_")).select("node", "size", "first", F.col("component").alias("cluster")))
    wanted = members.select("node", F.col("first.id").alias("id_"), F.col("first.hash").alias("content_"))
    return nodes.select("node", "size", "first"), components(set_links(members.drop("first"), named_sets(d, wanted, words), similarity, most, most_shingles))


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, similarity: float = 0.8, recall: float = 0.999) -> DataFrame:
    """One row of docs, with all its columns, for each group: the one with the smallest id, nulls last, ties by a hash of the text.

    Of repeated rows one stays, the smallest by all columns. The documents are shuffled once, by id and text hash, so copies of one text do not meet in one task.
    """
    nodes, found = near_copies(docs, id, text, words, similarity, recall)
    found = found.withColumnRenamed("node", "node_")
    part = F.coalesce("component", "node").alias("part")
    grouped = nodes.join(found, F.col("node") == F.col("node_"), "left").select("first", part)
    return one_of_each(docs, grouped.groupBy("part").agg(F.min("first").alias("first")), id, text)


def one_of_each(docs: DataFrame, groups: DataFrame, id: str, text: str) -> DataFrame:
    """The rows of docs that the groups' column ``first`` (struct with missing, id, hash) names; of repeated rows the smallest by all columns."""
    names: list[str] = list(docs.columns)
    own = {}
    for x in ("missing", "id", "hash", "rank", "missing2", "id2", "hash2"):
        names.append(own.setdefault(x, fresh(names, f"_{x}")))
    number = F.col(id).cast("long")
    rows = docs.withColumns({own["missing"]: number.isNull(), own["id"]: F.coalesce(number, F.lit(0)), own["hash"]: content_hash(text)})
    keys = [own["missing"], own["id"], own["hash"]]
    # Ranked before they are joined: repeated rows are cut to one inside each task, ahead of the shuffle, and the join needs no other shuffle of docs.
    ranked = rows.withColumn(own["rank"], F.row_number().over(Window.partitionBy(*keys).orderBy(*_order(docs)))).filter(F.col(own["rank"]) == 1)
    keepers = checkpointed(groups.select(F.col("first.missing").alias(own["missing2"]), F.coalesce("first.id", F.lit(0)).alias(own["id2"]), F.col("first.hash").alias(own["hash2"])))
    same = [F.col(own[a]) == F.col(own[f"{a}2"]) for a in ("missing", "id", "hash")]
    return ranked.join(keepers, same, "left_semi").select(*docs.columns)


def _order(docs: DataFrame) -> list[Column]:
    """All columns, in a form that can be sorted by."""
    whole = lambda t: isinstance(t, T.MapType | T.VariantType) or any(whole(f.dataType) for f in getattr(t, "fields", [])) or hasattr(t, "elementType") and whole(t.elementType)
    return [F.to_json(F.struct(F.col(f.name))) if whole(f.dataType) else F.col(f.name) for f in docs.schema.fields]

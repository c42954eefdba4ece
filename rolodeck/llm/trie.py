"""The trie of all prefixes of conversations that are rebuilt from another conversation's head and their own rest.

A conversation c becomes the first h turns of its base, and then its own turns after the first h. Nobody writes the rebuilt texts down:

1. A sequence of turns has a *fingerprint*: its length and, in four lanes modulo 2^31 - 1, the sum of each turn's number times the lane's base to the power of the turn's place. These form a monoid: (n, G) followed by (m, H) is
   (n + m, G + base^n H). So a prefix of a rebuilt conversation is its base's head product combined with a product of its own turns, each worked out once from numbers of 16 bytes a turn.
2. Prefixes with equal fingerprints are a node. That they are equal as texts is *verified*, not hoped for: each number stands for one (role, text) in the whole table, and all members of a node come from one parent by one number; by
   induction over depth they are equal. A node keeps a reference (conversation, place) to where its last turn is stored. Should a check ever fail, all is done again with other bases.
3. Sums over subtrees need no walk: each node's value goes to the conversation that names it (its smallest member). A conversation's sum from depth d on, added over all members of a node of depth d, is the node's sum.

A conversation may hold a third of all rows and a node a third of all conversations. Turns are dealt by ranges of (conversation, turn), and running sums go range by range; only the few conversations that lie in more than one
range, fewer than ranges, need sums of earlier ranges. Sums from behind go by blocks of ``BLOCK`` turns. Nodes are aggregations that combine before they shuffle; joins by a parent are ``join_hot``. The SHA-256 of a node's ids runs
over packed pieces of them, piece by piece, for it has no parallel form.

Defined results: null roles and texts are empty; null turns come first; rows of one turn go by role and text, repeated rows are turns of their own. Rows without conv_id take no part. conv_id must be whole numbers; of negative
ones the remainder is negative too, as in SQL. An empty table gives an empty result. Rows that agree in conversation, turn, role and the text's first 32 characters are sorted by one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .util import checkpointed, extended, join_hot

PRIME = (1 << 31) - 1
LANES = 4
BLOCK = 4096

_NODE = ("depth", "hi", "lo")


def bases(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1 << 20, PRIME - 1, LANES)


def powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """base to each of the powers, modulo PRIME."""
    out, square, left = np.ones(len(exponents), np.int64), np.int64(base), exponents.copy()
    while left.any():
        out = np.where(left & 1, out * square % PRIME, out)
        square, left = square * square % PRIME, left >> 1
    return out


def terms(a: np.ndarray, b: np.ndarray, exponents: np.ndarray, seed: int) -> list[np.ndarray]:
    """In each lane a turn's number (never 0), from its two hashes, times the base to the power of its place."""
    parts = [x & PRIME for x in (a, a >> 31, b, b >> 31)]
    return [(x % (PRIME - 1) + 1) * powers(int(r), exponents) % PRIME for x, r in zip(parts, bases(seed), strict=True)]


def with_terms(df: DataFrame, exponent: str, seed: int) -> DataFrame:
    """df and t0, t1, ...: the terms of the turns with the hashes a and b at the place ``exponent``."""
    names = [f"t{k}" for k in range(LANES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, e = (batch.column(x).to_numpy() for x in ("a", "b", exponent))
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, terms(a, b, e, seed))], names=[*batch.schema.names, *names])

    return df.mapInArrow(run, extended(df, [T.StructField(x, T.LongType()) for x in names]))


def _sums(columns: list[Column]) -> list[Column]:
    """hi and lo, of lanes."""
    lanes = [F.pmod(c, F.lit(PRIME)) for c in columns]
    return [lanes[0] * (1 << 31) + lanes[1], lanes[2] * (1 << 31) + lanes[3]]


def _turns(conversations: DataFrame, seed: int) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    t = conversations.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("c"), "turn", role.alias("role"), text.alias("text"))
    return t.withColumns({"a": F.xxhash64(F.lit(2 * seed), "role", "text"), "b": F.xxhash64(F.lit(2 * seed + 1), "role", "text"), "chars": F.length("text").cast("long")})


def placed_turns(turns: DataFrame) -> DataFrame:
    """(c, part, local, before, a, b, chars): each turn's place is before + local in its conversation; ``part`` is the range of turns that it lies in. A checkpointed table."""
    order = [F.col("c"), F.asc_nulls_first("turn"), F.col("role")]
    dealt = turns.repartitionByRange(*order, F.substring("text", 1, 32)).sortWithinPartitions(*order, "text").select("c", "a", "b", "chars")
    at = checkpointed(dealt).withColumn("id", F.monotonically_increasing_id())  # the range, and the place in it
    at = at.withColumn("part", F.shiftright("id", 33))
    sizes = at.groupBy("c", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("c").orderBy("part")) - F.col("n")).filter("before > 0")
    # Each range but the first continues one conversation at most: fewer rows than ranges.
    earlier = F.broadcast(earlier.select(F.col("c").alias("c_"), F.col("part").alias("part_"), "before"))
    local = (F.row_number().over(Window.partitionBy("c", "part").orderBy("id")) - 1).cast("long")
    found = at.withColumn("local", local).join(earlier, (F.col("c") == F.col("c_")) & (F.col("part") == F.col("part_")), "left")
    return checkpointed(found.select("c", "part", "local", F.coalesce("before", F.lit(0)).cast("long").alias("before"), "a", "b", "chars"))


def _own_from(c: Column, heads: int) -> Column:
    """How many turns of c its base replaces."""
    return F.crc32(c.cast("string").cast("binary")) % heads


def rebuilt_prefixes(turns: DataFrame, seed: int, heads: int, group: int) -> DataFrame:
    """A row for each prefix of each rebuilt conversation: its fingerprint (depth, hi, lo), that of the prefix before (phi, plo), and the last turn's hashes, characters and reference."""
    at = placed_turns(turns).withColumn("place", F.col("before") + F.col("local"))
    lanes = range(LANES)

    def based(c: Column) -> Column:
        return c - c % group

    first = with_terms(at.filter((F.col("c") % group == 0) & (F.col("place") < heads - 1)).select("c", "place", "a", "b", "chars"), "place", seed)
    so_far = Window.partitionBy("c").orderBy("place")
    first = first.withColumns({f"g{k}": F.sum(f"t{k}").over(so_far) for k in lanes})
    row = F.struct("place", "a", "b", "chars", *[f"t{k}" for k in lanes], *[f"g{k}" for k in lanes])
    head = first.groupBy(F.col("c").alias("base")).agg(F.array_sort(F.collect_list(row)).alias("head"))  # heads - 1 turns at most

    parts = checkpointed(at.groupBy("c", "part").agg(F.count(F.lit(1)).alias("n")))
    of = parts.select("c").distinct().withColumns({"h": _own_from(F.col("c"), heads), "base_": based(F.col("c"))})
    of = of.join(head, F.col("base_") == F.col("base"), "left").drop("base")
    of = of.withColumn("head", F.when(F.col("head").isNotNull() & (F.col("h") > 0), F.slice("head", F.lit(1), F.greatest(F.col("h"), F.lit(1)).cast("int"))))
    of = of.withColumn("given", F.coalesce(F.array_size("head"), F.lit(0)).cast("long"))
    of = checkpointed(of)

    columns = ["c", "depth", "hi", "lo", "phi", "plo", "a", "b", "chars", "ref_conv_id", "ref_place"]
    zero = F.lit(0).cast("long")
    root = of.select("c", *[zero.alias(x) for x in columns[1:9]], F.lit(None).cast("long").alias("ref_conv_id"), F.lit(None).cast("long").alias("ref_place"))

    def prefix(df: DataFrame, depth: Column, total: list[Column], term: list[Column], conv: Column, place: Column) -> DataFrame:
        (hi, lo), (phi, plo) = _sums(total), _sums([x - t for x, t in zip(total, term, strict=True)])
        return df.select("c", depth.alias("depth"), hi.alias("hi"), lo.alias("lo"), phi.alias("phi"), plo.alias("plo"), "a", "b", "chars", conv.alias("ref_conv_id"), place.alias("ref_place"))

    given = of.filter("given > 0").select("c", "base_", F.inline("head"))
    given = prefix(given, F.col("place") + 1, [F.col(f"g{k}") for k in lanes], [F.col(f"t{k}") for k in lanes], F.col("base_"), F.col("place"))

    # What a conversation's turns need to know of its head travels with each range's share of them, so that a long one does not meet in one task.
    last = F.get("head", F.col("given").cast("int") - 1)
    told = parts.select("c", "part").join(of.select(F.col("c").alias("of"), "h", "given", *[F.coalesce(last[f"g{k}"], zero).alias(f"start{k}") for k in lanes]), F.col("c") == F.col("of")).drop("of")
    told = told.withColumnsRenamed({"c": "c_", "part": "part_"})
    own = at.join(told, (F.col("c") == F.col("c_")) & (F.col("part") == F.col("part_"))).filter(F.col("place") >= F.col("h")).drop("c_", "part_")
    own = with_terms(own.withColumn("at", F.col("place") - F.col("h") + F.col("given")), "at", seed)
    so_far = Window.partitionBy("c", "part").orderBy("local")
    own = checkpointed(own.withColumns({f"g{k}": F.sum(f"t{k}").over(so_far) for k in lanes}))
    totals = own.groupBy(F.col("c").alias("c_"), F.col("part").alias("part_")).agg(*[F.sum(f"t{k}").alias(f"s{k}") for k in lanes])
    upto = Window.partitionBy("c_").orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    earlier = totals.withColumns({f"e{k}": F.sum(f"s{k}").over(upto) for k in lanes}).filter("e0 is not null").select("c_", "part_", *[f"e{k}" for k in lanes])
    own = own.join(F.broadcast(earlier), (F.col("c") == F.col("c_")) & (F.col("part") == F.col("part_")), "left")  # again fewer rows than ranges
    total = [F.col(f"start{k}") + F.col(f"g{k}") + F.coalesce(f"e{k}", zero) for k in lanes]
    own = prefix(own, F.col("at") + 1, total, [F.col(f"t{k}") for k in lanes], F.col("c"), F.col("place"))
    return checkpointed(root.unionByName(given).unionByName(own))


def _is_wrong(df: DataFrame) -> bool:
    return bool(df.limit(1).count())


def _ends(prefixes: DataFrame) -> DataFrame:
    """(node_, ends_sha256) of nodes where rebuilt conversations end."""
    last = prefixes.groupBy("c").agg(F.max(F.struct(*_NODE)).alias("node")).select("node.*", "c")
    keys = list(_NODE)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Neighbouring ids of one node as one text."""
        for batch in batches:
            if not batch.num_rows:
                continue
            node = np.stack([batch.column(k).to_numpy() for k in keys])
            new = np.flatnonzero(np.append(True, (node[:, 1:] != node[:, :-1]).any(axis=0)))
            ids, end = batch.column("c").to_pylist(), [*new[1:].tolist(), batch.num_rows]
            packed = [",".join(map(str, ids[i:j])) for i, j in zip(new.tolist(), end, strict=True)]
            yield pa.RecordBatch.from_arrays([*(pa.array(x[new]) for x in node), pa.array([ids[i] for i in new]), pa.array(packed, pa.string())], names=[*keys, "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        node, state = None, None
        for batch in batches:
            out = []
            for *key, ids in zip(*(batch.column(k).to_pylist() for k in [*keys, "ids"]), strict=True):
                if key != node:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=[*keys, "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, state.hexdigest())], names=[*keys, "ends_sha256"])

    kind = "depth long, hi long, lo long"
    packed = last.repartitionByRange(*keys, "c").sortWithinPartitions(*keys, "c").mapInArrow(pack, f"{kind}, first long, ids string")
    found = packed.repartition(*keys).sortWithinPartitions(*keys, "first").mapInArrow(digest, f"{kind}, ends_sha256 string")
    return found.select(F.struct(*keys).alias("node_"), "ends_sha256")


def _subtrees(prefixes: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node_, n_leaves, saved_tokens): sums over the nodes' subtrees."""
    block = F.floor(F.col("depth") / BLOCK).cast("long")
    values = nodes.select(F.col("conv_id").alias("c"), "depth", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    zero = F.lit(0).cast("long")
    rows = prefixes.select("c", "depth", "hi", "lo", zero.alias("leaf"), zero.alias("saved"))
    both = rows.unionByName(values.select("c", "depth", F.lit(None).cast("long").alias("hi"), F.lit(None).cast("long").alias("lo"), "leaf", "saved")).withColumn("block", block)
    below = Window.partitionBy("c", "block").orderBy(F.desc("depth"))  # values of the same depth count too: they are peers
    summed = both.withColumns({x: F.sum(x).over(below) for x in ("leaf", "saved")}).filter("hi is not null")
    totals = values.withColumn("block", block).groupBy(F.col("c").alias("c_"), F.col("block").alias("block_")).agg(F.sum("leaf").alias("leaf_"), F.sum("saved").alias("saved_"))
    lower = totals.select("c_", (F.col("block_") - 1).alias("block_"), "leaf_", "saved_")  # what lies below is added to each block above
    above = Window.partitionBy("c_").orderBy(F.desc("block_"))
    lower = lower.withColumns({x: F.sum(x).over(above) for x in ("leaf_", "saved_")}).withColumn("upto", F.col("block_"))
    # A block without values has the sum of the nearest one below that has some.
    nearest = Window.partitionBy("c_").orderBy("block_")
    lower = lower.withColumn("from_", F.coalesce(F.lag("block_").over(nearest) + 1, zero)).withColumn("block_", F.explode(F.expr("CASE WHEN upto >= from_ THEN sequence(from_, upto) ELSE array() END")))
    joined = summed.join(lower.drop("upto", "from_"), (F.col("c") == F.col("c_")) & (F.col("block") == F.col("block_")), "left")
    total = {x: F.sum(F.col(x) + F.coalesce(f"{x}_", zero)) for x in ("leaf", "saved")}
    return joined.groupBy(F.struct(*_NODE).alias("node_")).agg(total["leaf"].alias("n_leaves"), total["saved"].alias("saved_tokens"))


def prefix_trie(conversations: DataFrame, heads: int = 6, group: int = 100, tries: int = 3) -> DataFrame:
    """A row for each node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and ref_conv_id and ref_place, where its last turn is stored.

    conversations: conv_id, turn, role, text. A conversation takes as many turns of the first conversation of its group of ``group`` ids as the CRC-32 of its decimal id modulo ``heads`` says.
    """
    for seed in range(tries):
        turns = _turns(conversations, seed)
        content = F.struct("role", "text")
        two = turns.groupBy("a", "b").agg(F.min(content).alias("least"), F.max(content).alias("most")).filter("least <> most")
        if _is_wrong(two):
            continue
        prefixes = rebuilt_prefixes(turns, seed, heads, group)
        came = F.struct("phi", "plo", "a", "b")
        nodes = prefixes.groupBy(*_NODE).agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"), F.min(F.struct("ref_conv_id", "ref_place")).alias("ref"), F.min(came).alias("came"), F.max(came).alias("other"))
        nodes = checkpointed(nodes)
        if not _is_wrong(nodes.filter("came <> other")):
            break
    else:
        raise ValueError("fingerprints of different turns or prefixes met again and again")

    key, parent = F.struct(*_NODE), F.struct((F.col("depth") - 1).alias("depth"), F.col("came.phi").alias("hi"), F.col("came.plo").alias("lo"))
    nodes = nodes.select(key.alias("node"), F.when(F.col("depth") > 0, parent).alias("parent"), "depth", "conv_id", "n_convs", "chars", "ref.*")
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("parent_")).agg(F.count(F.lit(1)).alias("children"))
    nodes = checkpointed(nodes.join(children, F.col("node") == F.col("parent_"), "left").withColumn("n_children", F.coalesce("children", F.lit(0)).cast("long")).drop("parent_", "children"))
    above = nodes.filter("n_children > 0").select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("weight"))
    below = join_hot(nodes.filter("parent is not null"), above, ("parent", "above"), "weight", nodes.count()).drop("above", "weight")
    nodes_ = below.unionByName(nodes.filter("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long")))
    sums, ends = _subtrees(prefixes, nodes), _ends(prefixes)
    out = nodes_.join(sums, F.col("node") == sums["node_"]).join(ends, F.col("node") == ends["node_"], "left")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256"), "ref_conv_id", "ref_place")

"""Connected components of large graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import checkpointed, join_hot


def components(edges: DataFrame, heavy: int = 1_000) -> DataFrame:
    """(node, component): the smallest node that each node of the edges (node, root) reaches. Nodes without edges are left out.

    Alternating star contraction: a large-star step ties each larger neighbour to the smallest one, a small-star step each smaller one, until every
    edge points at its component's smallest node. Both steps are joins by a node; where one has over ``heavy`` neighbours they are ``join_hot``.
    """
    state = checkpointed(edges.filter("node <> root").select(F.greatest("node", "root").alias("big"), F.least("node", "root").alias("small")).distinct())
    while True:
        both = state.unionByName(state.select(F.col("small").alias("big"), F.col("big").alias("small")))
        lowest = checkpointed(both.groupBy(F.col("big").alias("u")).agg(F.min("small").alias("m"), F.count(F.lit(1)).alias("n")))
        # Done if each node with a smaller neighbour has no other: then all these are roots.
        now = lowest.agg(F.sum("n").alias("total"), F.max("n").alias("most"), F.max((F.col("m") < F.col("u")) & (F.col("n") > 1)).alias("open")).first()
        if not now.open:
            return lowest.select(F.col("u").alias("node"), F.least("u", "m").alias("component"))

        def by_node(left: DataFrame, right: DataFrame, now=now) -> DataFrame:
            return join_hot(left, right, ("big", "u"), "n", now.total, heavy) if now.most > heavy else left.join(right, F.col("big") == F.col("u"))

        large = by_node(both, lowest).filter("small > big").select(F.col("small").alias("big"), F.least("u", "m").alias("small")).distinct()
        down = large.groupBy(F.col("big").alias("u")).agg(F.min("small").alias("m"), F.count(F.lit(1)).alias("n"))
        small = by_node(large, down).select(F.explode(F.array(F.struct(F.col("small").alias("big"), F.col("m").alias("small")), F.struct("big", F.col("m").alias("small")))).alias("e"))
        state = checkpointed(small.select("e.big", "e.small").filter("big <> small").distinct())

"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Each source's documents are put in a fixed shuffled order and queued once for each pass over the source. A queued document's *virtual finish time* is the
source's cumulative tokens up to and with it, divided by the source's target; the mix is the order of virtual finish times over all sources, cut where the
total budget is reached. Sources thus progress in proportion to their targets, and all are near their targets at the cut.

No task sees a whole source. A source's order is by MD5 of seed and id, and the digest's first digits deal its rows to 4,096 buckets; an aggregation sums
buckets, a running sum over (source, bucket) gives each bucket's start, a window inside (source, bucket) the rest. The cut is found in the same way: virtual
times are range-partitioned into fine ranges and summed, a running sum over ranges names the range in which the budget ends, and only this range is sorted. The cut
is one value (time, source, digest, id, text's hash), so what a document contributes is a comparison of its own values with it.

Defined results: size is the number of words; a null or empty text has size 0 and is taken no times. The null source is a source, last in order. Null ids and
repeated rows are rows as any other; rows equal in source, id and text are queued next to each other, and the cut takes all or none of them. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import WORD, checkpointed, fresh, text_or_empty

#: Virtual time runs from 0 to about 1, in ranges of this width's inverse; later times share the last ranges.
RANGES = 4096
DIGITS = 3


def word_count(text: Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: list[float], budget: float, most: float) -> DataFrame:
    """sizes (source, source_size) with ``target``: the budget shared by weight, none above ``most`` times its size.

    Weights repeat over the sources in order of code points, null last. Sources in the order of most * size / weight reach their caps one after another
    as the common level rises; running sums give the level at which the shares use up the budget. One row per source: a small table.
    """
    by_name, by_cap = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    w = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.withColumn("weight", w).withColumn("cap", F.lit(float(most)) * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    ranked = ranked.withColumns({"caps": F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), "used": F.sum("weight").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), "all": F.sum("weight").over(everything), "total": F.sum("source_size").over(everything)})
    # The level if all sources before this one are capped and the others are not.
    level = (F.lit(float(budget)) * F.col("total") - F.coalesce("caps", F.lit(0.0))) / (F.col("all") - F.coalesce("used", F.lit(0.0)))
    ranked = ranked.withColumn("level", level)
    ranked = ranked.withColumn("final", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", F.col("source").isNull().alias("last"), "source", "level"))).over(everything)["level"])
    target = F.when(F.col("final").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("weight") * F.col("final")))
    return ranked.select("source", "source_size", target.alias("target"))


def _digest(seed: str, id: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit("null"))).cast("binary"))


def _order(time: Column, source: Column, digest: Column, id: Column, hash_: Column) -> Column:
    """What the mix is sorted by, as one value that can be compared."""
    parts = (time, source.isNull(), F.coalesce(source.cast("string"), F.lit("")), digest, id.isNull(), F.coalesce(id.cast("string"), F.lit("")), hash_)
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(parts)])


def _finish(before: Column, source_size: Column, target: Column, passes: int) -> list[Column]:
    """Virtual finish times, pass by pass, of a document up to and with which ``before`` words are queued in a pass."""
    return [F.try_divide((before + F.lit(k) * source_size).cast("double"), target) for k in range(passes)]


@dataclass
class Mix:
    """A decided mix: ``documents``, a checkpointed row for each document's row (source, id, digest, hash, size, source_size, target, times), and the cut."""

    id: str
    source: str
    text: str
    seed: str
    documents: DataFrame
    cut: tuple | None = None  # the place in the order of the last document taken; None: nothing is taken

    def apply(self, docs: DataFrame, times: str, size: str | None = None, source_size: str | None = None, target: str | None = None) -> DataFrame:
        """docs, whatever its columns, and ``times``: how often the mix takes the document; if named, its words, its source's words and target.

        docs must be the table the mix was planned for.

        Words are not counted again: the documents meet the mix's rows by source, id and content, which spreads them evenly.
        """
        wanted = {"times": times} | {k: v for k, v in (("size", size), ("source_size", source_size), ("target", target)) if v}
        names: list[str] = [*docs.columns, *wanted.values()]
        own = {}
        for x in ("digest", "hash", "other", "other_id", "other_digest", "other_hash"):
            names.append(own.setdefault(x, fresh(names, f"_{x}")))
        c = lambda x: F.col(own[x])
        rows = docs.withColumns({own["digest"]: _digest(self.seed, self.id), own["hash"]: F.xxhash64(text_or_empty(F.col(self.text)))})
        # Rows equal in all of these are taken equally often, so that one of them stands for all.
        known = self.documents.select(F.col("source").alias(own["other"]), F.col("id").alias(own["other_id"]), F.col("digest").alias(own["other_digest"]), F.col("hash").alias(own["other_hash"]), *[F.col(k).alias(v) for k, v in wanted.items()]).distinct()
        same = (c("digest") == c("other_digest")) & (c("hash") == c("other_hash")) & F.col(self.source).eqNullSafe(c("other")) & F.col(self.id).eqNullSafe(c("other_id"))
        return rows.join(known, same).select(*docs.columns, *wanted.values())


def plan_mix(docs: DataFrame, weights: list[float] = (5, 2, 1), budget: float = 1.5, most: int = 2, id: str = "doc_id", source: str = "source", text: str = "text", seed: str = "mix-0") -> Mix:
    """Decides a mix of docs: targets by ``weights``, ``budget`` times all words in total, at most ``most`` passes over a source."""
    narrow = checkpointed(docs.select(F.col(source).alias("source"), F.col(id).alias("id"), word_count(F.col(text)).alias("size"), _digest(seed, id).alias("digest"), F.xxhash64(text_or_empty(F.col(text))).alias("hash")).withColumn("bucket", F.substring("digest", 1, DIGITS)))
    sums = checkpointed(narrow.groupBy("source", "bucket").agg(F.sum("size").alias("words")))
    targets = source_targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), list(weights), budget, most).withColumnRenamed("source", "source_")
    starts = sums.withColumn("start", F.sum("words").over(Window.partitionBy("source").orderBy("bucket")) - F.col("words")).drop("words")
    starts = checkpointed(starts.join(targets, F.col("source").eqNullSafe(F.col("source_"))).drop("source_"))
    total = starts.select("source", "source_size", "target").distinct().agg(F.sum("target").alias("targets"), F.sum("source_size").alias("words")).first()

    inside = Window.partitionBy("source", "bucket").orderBy("digest", "id", "hash")
    placed = starts.withColumnsRenamed({"source": "source_", "bucket": "bucket_"})
    queue = narrow.withColumn("before", F.sum("size").over(inside)).join(placed, F.col("source").eqNullSafe(F.col("source_")) & (F.col("bucket") == F.col("bucket_")))
    # Rows equal in all of the order share one sum, so they are queued at one place.
    queue = checkpointed(queue.select("source", "id", "digest", "hash", "size", (F.col("before") + F.col("start")).alias("before"), "source_size", "target"))
    cut = _cut(queue, budget * total.words, total.targets, most) if total.words else None
    times = F.lit(0)
    if cut is not None:
        last = F.struct(*[F.lit(v).alias(f"k{i}") for i, v in enumerate(cut)])
        for time in _finish(F.col("before"), F.col("source_size"), F.col("target"), most):
            times = times + F.when(_order(time, F.col("source"), F.col("digest"), F.col("id"), F.col("hash")) <= last, 1).otherwise(0)
    times = F.when(F.col("size") > 0, times).otherwise(0).cast("int").alias("times")
    return Mix(id, source, text, seed, queue.select("source", "id", "digest", "hash", "size", "source_size", "target", times), cut)


def _cut(queue: DataFrame, budget: float, targets: float, passes: int) -> tuple | None:
    """The place in the order of the last document that the budget takes."""
    limit = min(budget, targets + 0.5)  # the mix's total is the budget, or less if all sources are at their caps
    finish = F.explode(F.array(*_finish(F.col("before"), F.col("source_size"), F.col("target"), passes)))
    times = queue.filter("size > 0").select("source", "id", "digest", "hash", "size", finish.alias("time")).withColumn("range", F.least(F.floor(F.col("time") * RANGES), F.lit(4 * RANGES)).cast("long"))
    times = times.select("range", "size", _order(F.col("time"), F.col("source"), F.col("digest"), F.col("id"), F.col("hash")).alias("key"))
    so_far = F.sum("words").over(Window.orderBy("range"))  # over at most 4 * RANGES + 1 rows
    ranges = times.groupBy("range").agg(F.sum("size").alias("words")).select("range", so_far.alias("so_far"), (so_far - F.col("words")).alias("before"))
    over = ranges.filter(F.col("so_far") > F.lit(limit)).orderBy("range").limit(1).first()
    if over is None:
        last = times.agg(F.max("key").alias("key")).first().key
    else:
        inside = times.filter(F.col("range") == F.lit(over.range)).groupBy("key").agg(F.sum("size").alias("words"))
        inside = inside.withColumn("so_far", F.sum("words").over(Window.orderBy("key")) + F.lit(over.before)).filter(F.col("so_far") <= F.lit(limit))
        last = inside.agg(F.max("key").alias("key")).first().key or times.filter(F.col("range") < F.lit(over.range)).agg(F.max("key").alias("key")).first().key
    return tuple(last) if last is not None else None

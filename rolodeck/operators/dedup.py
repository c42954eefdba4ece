"""Duplicates of leads and places: within a batch, across sources, across campaigns.

The keys are persons and companies. A shared mailbox or a placeholder name may hold many rows; each operator says what one key costs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..cluster import checkpointed, fresh, join_hot, without_hot
from ..schemas import LEAD
from .graph import components


def first_seen(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row of each key; null is a key as any other. Only (key, order) is aggregated, combined before the shuffle, so a hot key costs one row per task.

    ``order`` tells rows of a key apart: rows that are equal in both all stay.
    """
    key_, other, least = (fresh(df.columns, x) for x in ("_key", "_other", "_least"))
    k = df.withColumn(key_, key)
    firsts = k.groupBy(F.col(key_).alias(other)).agg(F.min(order).alias(least))
    return k.join(firsts, F.col(key_).eqNullSafe(F.col(other)) & (F.col(order) == F.col(least)), "left_semi").drop(key_)


def merge_key(order: str) -> Column:
    """E-mail, else name and company, else the row itself."""
    mail, name, org = (X.key(F.col(c)) for c in ("email", "name", "company_name"))
    return F.when(mail != "", F.concat(F.lit("e:"), mail)).when((name != "") & (org != ""), F.concat(F.lit("n:"), name, F.lit("|"), org)).otherwise(F.concat(F.lit("u:"), F.col(order).cast("string")))


def richness(columns: tuple[str, ...] = LEAD) -> Column:
    """How many of the columns are not blank."""
    return reduce(lambda a, b: a + b, [X.nonblank(X.blank_if_null(F.col(c))).cast("int") for c in columns])


def merged_by_email(leads: DataFrame, order: str = "ord", columns: tuple[str, ...] = LEAD, most: int = 1000) -> DataFrame:
    """One row for each merge key: the rows folded in order, the richer one being the base.

    The fold keeps a base record and fills its holes from the next one; the next one becomes the base only if it has strictly more fields than the base has by
    then; ``source`` is the sorted union. Keys with up to ``most`` different records are folded as arrays in one aggregation. A key with more (a shared mailbox may hold a third of all rows)
    is never gathered: a record changes the base only if it is richer or fills a hole, and each change adds a field, so a key changes at most once for each column. Each round finds every
    large key's next changing record by a minimum, which is combined before it is shuffled; as many rounds as columns are enough. Joins by a large key are ``join_hot``.
    """
    record = F.array(*[F.col(c) for c in columns])  # as a list, so that a step of the fold is a few small expressions
    keyed = leads.withColumn("_key", merge_key(order))
    once = checkpointed(keyed.groupBy("_key", *columns).agg(F.min(order).alias("_o"), F.count(F.lit(1)).alias("_n")))
    named = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.filter(F.split("source", ","), lambda x: x != "")))))
    facts = (F.sum("_n").alias("n"), named.alias("sources"))  # how many rows a key has, and of which sources; aggregated with its records, for a table of all keys would be joined by telling it to all tasks
    big = checkpointed(once.groupBy(F.col("_key").alias("k_")).agg(F.count(F.lit(1)).alias("records"), *facts).filter(F.col("records") > most))
    large = bool(big.limit(1).count())
    total = once.count() if large else 0
    hot = big.select("k_", "records")
    small = without_hot(once, hot, ("_key", "k_"), "records", total) if large else once
    lists = small.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("_o", record.alias("r")))).alias("rows"), *facts)
    first = F.element_at("rows", 1)
    later = F.slice("rows", F.lit(2), F.greatest(F.size("rows") - 1, F.lit(0)))
    done = lists.select("_key", first["_o"].alias("_first"), F.aggregate(later, first["r"], lambda base, x: _step(base, x["r"])).alias("base"), "n", "sources")
    if large:
        rows = checkpointed(join_hot(once, hot, ("_key", "k_"), "records", total).select("_key", F.col("_o").alias("o"), record.alias("r"), "records"))
        done = done.unionByName(_folded_in_rounds(rows, total).join(big.drop("records"), F.col("_key") == F.col("k_")).drop("k_"))
    # Every row's source counts, and a merge leaves nothing blank but empty texts; a row that is alone stays as it is.
    value = lambda i: F.when((F.col("n") == 1) | X.nonblank(F.col("base")[i]), F.col("base")[i]).otherwise(F.lit(""))
    source = lambda i: F.when(F.col("n") == 1, F.col("base")[i]).otherwise(F.array_join("sources", ","))
    return done.select(F.col("_first").alias(order), *[(source(i) if c == "source" else value(i)).alias(c) for i, c in enumerate(columns)])


def _filled(record: Column) -> Column:
    return F.size(F.filter(record, X.nonblank))


def _step(base: Column, nxt: Column) -> Column:
    """The base after one more record: the richer of both, its holes filled from the other."""
    over = lambda a, b: F.zip_with(a, b, lambda x, y: F.when(X.nonblank(x), x).otherwise(y))
    return F.when(_filled(nxt) > _filled(base), over(nxt, base)).otherwise(over(base, nxt))


def _folded_in_rounds(rows: DataFrame, total: int) -> DataFrame:
    """(_key, _first, base) of keys with many records; rows: _key, o (order), r (record), and records, how many the key has."""
    first = rows.groupBy("_key").agg(F.min(F.struct("o", "r")).alias("x"), F.max("records").alias("records"))
    state = checkpointed(first.select("_key", F.col("x.o").alias("_first"), F.col("x.o").alias("at"), F.col("x.r").alias("base"), "records"))
    rows = rows.drop("records")
    while True:
        held = state.select(F.col("_key").alias("k_"), "at", "base", "records")
        fills = F.exists(F.zip_with("base", "r", lambda b, n: X.nonblank(n) & ~X.nonblank(X.blank_if_null(b))), lambda x: x)
        changing = join_hot(rows, held, ("_key", "k_"), "records", total).filter((F.col("o") > F.col("at")) & (fills | (_filled(F.col("r")) > _filled(F.col("base")))))
        nxt = checkpointed(changing.groupBy(F.col("_key").alias("n_")).agg(F.min(F.struct("o", "r")).alias("x")))
        if not nxt.limit(1).count():
            return state.select("_key", "_first", "base")
        joined = state.join(nxt, F.col("_key") == F.col("n_"), "left")
        base = F.when(F.col("x").isNull(), F.col("base")).otherwise(_step(F.col("base"), F.col("x")["r"]))
        state = checkpointed(joined.select("_key", "_first", F.coalesce("x.o", "at").alias("at"), base.alias("base"), "records"))


def merged_simple(leads: DataFrame, order: str = "ord", columns: tuple[str, ...] = LEAD) -> DataFrame:
    """By e-mail only: the row with most fields, the first of equals; rows without an e-mail are dropped."""
    key_, rank, other, least = (fresh(leads.columns, x) for x in ("_key", "_rank", "_other", "_least"))
    k = leads.filter(X.nonblank(X.blank_if_null(F.col("email")))).withColumn(key_, X.key(F.col("email"))).withColumn(rank, F.struct((-richness(columns)).alias("less"), F.col(order).alias("o")))
    best = k.groupBy(F.col(key_).alias(other)).agg(F.min(rank).alias(least))
    return k.join(best, (F.col(key_) == F.col(other)) & (F.col(rank) == F.col(least)), "left_semi").drop(key_, rank)


def merge_stats(raw: DataFrame, merged: DataFrame, first: str, second: str) -> DataFrame:
    """raw, duplicates, unique, only the first source, only the second, several sources."""
    s = F.col("source")
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    out = merged.agg(F.count(F.lit(1)).alias("unique_rows"), count(s == first).alias("only_first"), count(s == second).alias("only_second"), count(F.contains(s, F.lit(","))).alias("several"))
    return raw.agg(F.count(F.lit(1)).alias("raw_rows")).withColumn("_k", F.lit(1)).join(out.withColumn("_k", F.lit(1)), "_k").drop("_k").withColumn("duplicates", F.col("raw_rows") - F.col("unique_rows"))


def cross_campaign(leads: DataFrame, rank: str, order: str = "ord", email: str = "email", url: str = "linkedin_url", name: str = "name", org: str = "company_name", rounds: int = 4, most: int = 100_000) -> DataFrame:
    """(order, rank, reason): reason is null for rows that stay, else the first kind of key (email, url, name_org) shared with a kept earlier row.

    Campaigns go by ``rank`` (1: oldest with rows, the baseline, which stays whole); inside one by ``order``. A row stays if no *kept* earlier row shares a key; keys of
    dropped rows count for nothing, so this is no grouping. Rounds decide it: rows sharing a key with a kept earlier row are dropped; of the undecided, those that are first
    on all of their keys stay; and so on. Each round is aggregations by key, which combine before they shuffle (a hot key is one row per task), and a
    join back; it ends in a reliable checkpoint. Keys of persons and companies make short chains of rows that each wait for the one before, and a few rounds decide nearly all. What ``rounds`` rounds leave open is cut into
    connected parts: one of up to ``most`` rows is decided by one task that walks through it in order, whatever its chains. Only larger parts go on in rounds, half as many as their longest chain has rows.
    """
    position = F.struct(F.col(rank).alias("c"), F.col(order).alias("o"))
    mail, profile, n, g = X.key(F.col(email)), X.profile_key(F.col(url)), X.key(F.col(name)), X.key(F.col(org))
    keys = F.array_compact(F.array(F.when(mail != "", F.struct(F.lit(1).alias("kind"), mail.alias("key"))), F.when(profile != "", F.struct(F.lit(2).alias("kind"), profile.alias("key"))), F.when((n != "") & (g != ""), F.struct(F.lit(3).alias("kind"), F.concat(n, F.lit("|"), g).alias("key")))))
    rows = leads.select(position.alias("p"), keys.alias("keys"), F.when((F.col(rank) == 1) | (F.size(keys) == 0), F.lit(1)).otherwise(F.lit(0)).alias("state"))
    rows = checkpointed(rows)  # state: 0 undecided, 1 kept, 2 dropped
    done = 0
    while rows.filter("state = 0").limit(1).count():
        if done == rounds:
            rows = _small_parts_decided(rows, most)
        done += 1
        k = rows.filter("state < 2").select("p", "state", F.explode("keys").alias("k"))
        firsts = k.groupBy("k").agg(F.min(F.when(F.col("state") == 1, F.col("p"))).alias("kept"), F.min(F.when(F.col("state") == 0, F.col("p"))).alias("open"))
        open_ = k.filter("state = 0").join(firsts.withColumnRenamed("k", "k_"), F.col("k") == F.col("k_"))
        verdict = open_.groupBy(F.col("p").alias("p_")).agg(F.max((F.col("kept") < F.col("p")).cast("int")).alias("hit"), F.min((F.col("open") == F.col("p")).cast("int")).alias("first"))
        joined = rows.join(verdict, F.col("p") == F.col("p_"), "left")
        state = F.when(F.col("state") != 0, F.col("state")).when(F.col("hit") == 1, 2).when(F.col("first") == 1, 1).otherwise(0)
        rows = checkpointed(joined.select("p", "keys", state.alias("state")))
    k = rows.select("p", "state", F.explode("keys").alias("k"))
    kept = k.filter("state = 1").groupBy(F.col("k").alias("k_")).agg(F.min("p").alias("kept"))
    hits = k.filter("state = 2").join(kept, (F.col("k") == F.col("k_")) & (F.col("kept") < F.col("p"))).groupBy(F.col("p").alias("p_")).agg(F.min("k.kind").alias("reason"))
    name_of = F.when(F.col("reason") == 1, "email").when(F.col("reason") == 2, "url").when(F.col("reason") == 3, "name_org")
    return rows.join(hits, F.col("p") == F.col("p_"), "left").select(F.col("p.o").alias(order), F.col("p.c").alias(rank), name_of.alias("reason"))


def _small_parts_decided(rows: DataFrame, most: int) -> DataFrame:
    """rows (p, keys, state) with the undecided ones of connected parts of up to ``most`` rows decided.

    First those that share a key with a kept earlier row are dropped; then a part's own rows decide it. Rows and keys are the nodes of a graph, each numbered by a hash; should two hashes meet, parts are joined that need not
    be, which changes no decision.
    """
    k = rows.select("p", "state", F.explode("keys").alias("k"))
    kept = k.filter("state = 1").groupBy(F.col("k").alias("k_")).agg(F.min("p").alias("kept"))
    hit = k.filter("state = 0").join(kept, (F.col("k") == F.col("k_")) & (F.col("kept") < F.col("p"))).select(F.col("p").alias("p_")).distinct()
    dropped = F.when(F.col("p_").isNotNull(), 2).otherwise(F.col("state"))
    rows = checkpointed(rows.join(hit, F.col("p") == F.col("p_"), "left").select("p", "keys", dropped.alias("state")))
    open_ = rows.filter("state = 0").withColumn("node", F.xxhash64("p"))
    edges = open_.select(F.col("node"), F.explode(F.transform("keys", lambda k: F.xxhash64(k))).alias("root"))
    placed = components(edges).withColumnRenamed("node", "node_")
    parts = checkpointed(open_.join(placed, F.col("node") == F.col("node_")).select("p", "keys", F.col("component").alias("part")))
    sizes = parts.groupBy(F.col("part").alias("part_")).agg(F.count(F.lit(1)).alias("n"))
    few = join_hot(parts, sizes.filter(F.col("n") <= most), ("part", "part_"), "n", parts.count())
    walk = few.select("part", "p.c", "p.o", F.transform("keys", lambda k: F.concat_ws(":", k["kind"].cast("string"), k["key"])).alias("ks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, kept = None, set()
        for batch in batches:
            stays = []
            for p, keys in zip(batch.column("part").to_pylist(), batch.column("ks").to_pylist(), strict=True):
                if p != part:
                    part, kept = p, set()
                stays.append(kept.isdisjoint(keys))
                if stays[-1]:
                    kept.update(keys)
            yield pa.RecordBatch.from_arrays([batch.column("c"), batch.column("o"), pa.array([1 if s else 2 for s in stays], pa.int32())], names=["c", "o", "said"])

    kinds = T.StructType([walk.schema["c"], walk.schema["o"], T.StructField("said", T.IntegerType())])
    said = walk.repartition("part").sortWithinPartitions("part", "c", "o").mapInArrow(run, kinds).select(F.struct("c", "o").alias("p_"), "said")
    return checkpointed(rows.join(said, F.col("p") == F.col("p_"), "left").select("p", "keys", F.coalesce("said", "state").alias("state")))


def cross_counts(decided: DataFrame, rank: str) -> DataFrame:
    """Per campaign and in all (rank null): rows, removed by each kind of key, kept, and the removal rate in per cent."""
    count = lambda c: F.sum(c.cast("long"))
    r = F.coalesce("reason", F.lit(""))
    out = decided.rollup(rank).agg(F.count(F.lit(1)).alias("rows"), count(r == "email").alias("by_email"), count(r == "url").alias("by_url"), count(r == "name_org").alias("by_name_org"))
    removed = F.col("by_email") + F.col("by_url") + F.col("by_name_org")
    return out.withColumns({"kept": F.col("rows") - removed, "rate": F.bround(100.0 * removed / F.col("rows"), 1)})


def deduped_places(places: DataFrame, order: str = "ord") -> DataFrame:
    """The first row of each place id, or of each hash of name and address where there is none."""
    return first_seen(places, F.coalesce(F.when(X.blank_if_null(F.col("placeId")) != "", F.col("placeId")), X.hash_id(F.col("title"), F.col("address"))), order)

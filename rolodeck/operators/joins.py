"""Lookups and anti joins of leads, taxonomies and scores.

Person-level keys are joined without hints: statistics and adaptive execution pick the strategy, and skewed keys are split. Configuration tables (taxonomies, id names, scores) are
written by hand and small; they are joined without hints too, so Spark broadcasts them by their size and has a shuffled join beyond its threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..cluster import fresh
from ..functions import text as X
from .lookup import looked_up


def _keys(df: DataFrame, *columns: Column) -> DataFrame:
    """Distinct non-empty keys, as k0, k1, ..."""
    d = df.select(*[X.key(c).alias(f"k{i}") for i, c in enumerate(columns)])
    for i in range(len(columns)):
        d = d.filter(F.col(f"k{i}") != "")
    return d.distinct()


def _all(n: int, *columns: Column) -> Column:
    hit = F.lit(True)
    for i in range(n):
        hit = hit & (X.key(columns[i]) == F.col(f"k{i}"))
    return hit


def new_only(new: DataFrame, old: DataFrame, email: str = "email", name: str = "name", org: str = "company_name") -> DataFrame:
    """Rows of new whose e-mail is not in old, and whose (name, organisation) is not either; empty keys match nothing."""
    by_mail = new.join(_keys(old, F.col(email)), _all(1, F.col(email)), "left_anti")
    return by_mail.join(_keys(old, F.col(name), F.col(org)), _all(2, F.col(name), F.col(org)), "left_anti")


def without_reference(leads: DataFrame, reference: DataFrame, email: str = "email", reference_email: str = "Email") -> DataFrame:
    """Without the rows whose e-mail is on the reference list; rows without an e-mail stay."""
    return leads.join(_keys(reference, F.col(reference_email)), _all(1, F.col(email)), "left_anti")


def kept_or_removed(leads: DataFrame, reviewed: DataFrame) -> DataFrame:
    """leads with ``kept``: the e-mail is on the reviewed list, or, for rows without an e-mail, name and company are."""
    by_mail, by_name, by_org = (fresh(leads.columns, x) for x in ("_mail", "_name", "_org"))
    mails, names = _keys(reviewed, F.col("Email")).withColumnRenamed("k0", by_mail), _keys(reviewed, F.col("Name"), F.col("Company")).withColumnsRenamed({"k0": by_name, "k1": by_org})
    mail = X.key(F.col("email"))
    named = (mail == "") & (X.key(F.col("name")) == F.col(by_name)) & (X.key(F.col("company_name")) == F.col(by_org))
    marked = leads.join(mails, mail == F.col(by_mail), "left").join(names, named, "left")
    return marked.withColumn("kept", F.col(by_mail).isNotNull() | F.col(by_name).isNotNull()).drop(by_mail, by_name, by_org)


def unseen_places(places: DataFrame, exported: DataFrame, in_batch: bool, order: str = "ord") -> DataFrame:
    """places whose id (of name and address, both needed) is not among the exported ones (title, address); in_batch: nor earlier in the batch."""
    has = (X.blank_if_null(F.col("title")) != "") & (X.blank_if_null(F.col("address")) != "")
    ids = exported.filter(has).select(X.hash_id(F.col("title"), F.col("address")).alias("seen_")).distinct()
    rows = places.withColumn("lead_id", F.when(has, X.hash_id(F.col("title"), F.col("address"))))
    left = rows.join(ids, F.col("lead_id") == F.col("seen_"), "left_anti")
    if not in_batch:
        return left
    from .dedup import first_seen

    return first_seen(left, F.coalesce("lead_id", F.concat(F.lit("row:"), F.col(order).cast("string"))), order)


def filled_country(leads: DataFrame, answers: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """leads with company_country filled from the last answer (domain, country; see ``lookup``) of its domain, only where it is blank; ``filled`` says how."""
    said = fresh(leads.columns, "_said")
    blank = ~X.nonblank(X.blank_if_null(F.col("company_country")))
    joined = looked_up(leads, answers, X.key(F.col("company_domain")), X.key(F.col("domain")), {"country": F.col("country")}, said, order)
    country = F.col(f"{said}.country")
    how = F.when(~blank, "had").when(X.key(F.col("company_domain")) == "", "no_domain").when(F.coalesce(country, F.lit("")) == "", "not_found").otherwise("filled")
    return joined.withColumn("filled", how).withColumn("company_country", F.when(how == "filled", country).otherwise(F.col("company_country"))).drop(said)


# --- taxonomies


def to_v1(df: DataFrame, taxonomy: DataFrame, industry: str, into: str = "v1") -> DataFrame:
    """df with its industry in the first taxonomy: by exact name, else in lower case, else unchanged."""
    same, same_best, low, low_best = (fresh(df.columns, x) for x in ("_same", "_same_best", "_low", "_low_best"))
    exact = taxonomy.groupBy(F.col("v2").alias(same)).agg(F.min(F.struct("prio", "v1")).alias(same_best))
    lower = taxonomy.groupBy(F.lower("v2").alias(low)).agg(F.min(F.struct("prio", "v1")).alias(low_best))
    joined = df.join(exact, F.col(industry) == F.col(same), "left").join(lower, F.lower(industry) == F.col(low), "left")
    return joined.withColumn(into, F.coalesce(f"{same_best}.v1", f"{low_best}.v1", industry)).drop(same, same_best, low, low_best)


def spellings(industries: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """One column industry: names of both taxonomies in three spellings: as they are, with & for and, and the reverse, in lower case."""
    v2 = taxonomy.join(industries.withColumnRenamed("industry", "i_"), F.lower("v1") == F.lower("i_")).select(F.col("v2").alias("industry"))
    every = industries.select("industry").unionByName(v2).select(F.lower("industry").alias("x"))
    forms = F.array(F.col("x"), F.replace("x", F.lit(" and "), F.lit(" & ")), F.replace("x", F.lit(" & "), F.lit(" and ")))
    return every.select(F.explode(forms).alias("industry")).distinct()


def resolved_ids(df: DataFrame, key: str, ids: str, names: DataFrame) -> DataFrame:
    """(key, names, unresolved): the ids' names, each once, in order, and the ids without one."""
    d = names.select(F.col("id").alias("id_"), F.col("name").alias("name_"))
    joined = df.select(key, F.posexplode(ids).alias("i", "id")).join(d, F.col("id") == F.col("id_"), "left")
    named = joined.filter("name_ is not null").groupBy(key, "name_").agg(F.min("i").alias("i"))
    found = named.groupBy(F.col(key).alias("k1")).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "name_"))), lambda x: x["name_"]).alias("names"))
    lost = joined.filter("name_ is null").groupBy(F.col(key).alias("k2")).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "id"))), lambda x: x["id"]).alias("unresolved"))
    out = df.select(key).join(found, F.col(key) == F.col("k1"), "left").join(lost, F.col(key) == F.col("k2"), "left")
    return out.select(key, *[F.coalesce(F.array_join(c, "|"), F.lit("")).alias(c) for c in ("names", "unresolved")])


def name_ids(df: DataFrame, name: str, names: DataFrame, order: str = "ord") -> DataFrame:
    """df with ``id`` of its name by normalised key; of names that meet in a key the last id counts. names: id, name and an order."""
    of = fresh(df.columns, "_of")
    last = names.groupBy(X.industry_key(F.col("name")).alias(of)).agg(F.max(F.struct(F.col(order).alias("o"), "id"))["id"].alias("id"))
    return df.join(last, X.industry_key(F.col(name)) == F.col(of), "left").drop(of)


def merged_ids(known: DataFrame, new: DataFrame) -> DataFrame:
    """(id, name, status) of both tables: the known name wins; status: same, conflict, known or new."""
    k, n = known.select(F.col("id").alias("a"), F.col("name").alias("an")), new.select(F.col("id").alias("b"), F.col("name").alias("bn"))
    joined = k.join(n, F.col("a") == F.col("b"), "full_outer")
    status = F.when(F.col("b").isNull(), "known").when(F.col("a").isNull(), "new").when(F.lower("an") == F.lower("bn"), "same").otherwise("conflict")
    return joined.select(F.coalesce("a", "b").alias("id"), F.coalesce("an", "bn").alias("name"), status.alias("status"))


def scored_industries(leads: DataFrame, scores: DataFrame, industry: str = "industry", order: tuple[str, ...] = ()) -> DataFrame:
    """leads with ``score``, the last one of its industry (see ``lookup``) in any case; unknown industries and malformed scores are maybe. Blank industries have none."""
    said = fresh(leads.columns, "_said")
    known = F.when(F.col("score").isin("relevant", "maybe", "irrelevant"), F.col("score")).otherwise("maybe")
    joined = looked_up(leads, scores, F.lower(industry), F.lower("industry"), {"score": known}, said, order)
    score = F.when(X.nonblank(F.col(industry)), F.coalesce(f"{said}.score", F.lit("maybe")))
    return joined.withColumn("score", score).drop(said)

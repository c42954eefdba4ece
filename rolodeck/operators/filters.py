"""Predicates over leads, and chains of them.

A chain never materialises one table per stage: each row gets the name of the first stage it fails, in one pass, and reports are aggregates of that column.
Predicates that need a table (industries, foreign domains, phone codes) get it as a small configuration table, which is joined once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..cluster import fresh
from ..functions import text as X
from ..schemas import INVALID_MARKERS
from .lookup import looked_up, one_row_a_key
from .normalize import is_junk

PHONES = ("phone", "organization_phone", "personal_phone", "company_phone")
#: Titles that are not decision makers, and the exempt ones that the pattern would hit.
TITLE_EXCLUDE = [("intern|trainee|student|assistant|junior", None), ("designer?|design", "design director|head of design")]


def own(df_columns: list[str], names: tuple[str, ...]) -> list[Column]:
    return [F.col(c) for c in names if c in df_columns]


def valid(name: Column, email: Column, markers: tuple[str, ...] = INVALID_MARKERS) -> Column:
    """No status line, and a name or an e-mail; white space counts as one."""
    return ~is_junk(name, markers) & (X.present(X.blank_if_null(name)) | X.present(X.blank_if_null(email)))


def has_email(email: Column) -> Column:
    return F.coalesce(X.present(email), F.lit(False))


def phone_has_code(phones: list[Column], code: str) -> Column:
    """Any phone starts with the code, a plus added if it lacks one."""
    code = code if code.startswith("+") else f"+{code}"
    return F.exists(F.array(*map(X.blank_if_null, phones)), lambda p: X.strip(p).startswith(code))


def title_allowed(title: Column, exclude: list[tuple[str, str | None]] = TITLE_EXCLUDE) -> Column:
    """No excluded pattern hits the lower-cased title, unless its exemption does too; a blank title is allowed."""
    low = X.key(title)
    hits = [low.rlike(p) & (~low.rlike(but) if but else F.lit(True)) for p, but in exclude]
    return (low == "") | ~reduce(lambda a, b: a | b, hits, F.lit(False))


def in_industries(df: DataFrame, industries: list[str], industry: str = "industry") -> Column:
    keys = [k.lower().strip().replace(" and ", " & ") for k in industries]
    return X.industry_key(F.col(industry)).isin(*keys)


def lead_country(columns: list[str]) -> Column:
    return X.first_present(*own(columns, ("country", "company_country")))


def has_website(columns: list[str]) -> Column:
    return X.first_nonblank(*map(X.blank_if_null, own(columns, ("website_url", "company_website", "company_domain")))) != ""


def lead_domain(columns: list[str]) -> Column:
    return X.first_nonblank(*[X.domain_simple(X.key(c)) for c in own(columns, ("company_domain", "company_website", "website_url"))])


def with_country_rules(df: DataFrame, foreign: DataFrame, phones: DataFrame) -> DataFrame:
    """df with ``_foreign`` (the country's foreign endings, null: unknown country) and ``_code`` (its phone code, null: unknown)."""
    f = foreign.groupBy(F.lower("country").alias("f_")).agg(F.collect_set("tld").alias("_foreign"))
    p = phones.select(F.lower("country").alias("p_"), F.col("code").alias("_code"))
    country = F.lower(lead_country(df.columns))
    return df.join(f, country == F.col("f_"), "left").join(p, country == F.col("p_"), "left").drop("f_", "p_")


def not_foreign_tld(columns: list[str], compound: list[str]) -> Column:
    ending = X.tld(lead_domain(columns), compound)
    return ~F.coalesce(F.array_contains("_foreign", ending), F.lit(False))


def phone_of_country(columns: list[str]) -> Column:
    phone = X.first_nonblank(*map(X.blank_if_null, own(columns, PHONES)))
    return F.col("_code").isNull() | (phone == "") | phone.startswith(F.col("_code"))


def tagged(df: DataFrame, stages: list[tuple[str, Column]], into: str = "first_failed") -> DataFrame:
    """df and the name of the first stage whose predicate it fails, null if it passes all."""
    out = F.lit(None).cast("string")
    for name, keeps in reversed(stages):
        out = F.when(~F.coalesce(keeps, F.lit(False)), F.lit(name)).otherwise(out)
    return df.withColumn(into, out)


def stage_report(tags: DataFrame, stages: list[str], column: str = "first_failed") -> DataFrame:
    """stage, position, before, removed, after: one aggregate, and a running sum over the stages."""
    counts = tags.groupBy(F.coalesce(column, F.lit("")).alias("stage")).agg(F.count(F.lit(1)).alias("n"))
    spark = tags.sparkSession
    order = spark.createDataFrame([(s, i) for i, s in enumerate(stages, 1)], "stage string, position int")
    total = F.sum("n").over(Window.partitionBy())
    n = counts.withColumn("total", total)
    # The table has a row for each stage; rows that pass all count in the total only.
    joined = n.join(F.broadcast(order), "stage", "left")
    before = F.col("total") - F.coalesce(F.sum("n").over(Window.partitionBy().orderBy("position").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    failed = joined.filter("position is not null").withColumn("before", before)
    return failed.select("stage", "position", "before", F.col("n").alias("removed"), (F.col("before") - F.col("n")).alias("after"))


def top_removed(tags: DataFrame, values: dict[str, Column], k: int, order: str = "ord", column: str = "first_failed") -> DataFrame:
    """stage, value, n, rank: of each stage the k most frequent values it removed; ties in order of first appearance."""
    value = F.lit("")
    for stage, v in values.items():
        value = F.when(F.col(column) == stage, X.blank_if_null(v)).otherwise(value)
    counts = tags.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("stage"), value.alias("value")).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    rank = F.row_number().over(Window.partitionBy("stage").orderBy(F.desc("n"), "first")).cast("long")
    return counts.withColumn("rank", rank).filter(F.col("rank") <= k).drop("first")


# --- filters after a feed that did not honour them


def contains_any(c: Column, wanted: list[str], blank: bool) -> Column:
    """A lower-cased text holds any of the wanted ones; blank: what a blank text gives."""
    low = X.key(c)
    return F.when(low == "", F.lit(blank)).otherwise(X.any_contains(low, [w.lower() for w in wanted]))


def enforced(df: DataFrame, capabilities: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """df and the first predicate it fails among those that its source dropped but that can be enforced.

    capabilities: source, filter_key, state.
    """
    of, keys = fresh(df.columns, "_of"), fresh(df.columns, "_keys")
    per = capabilities.filter("state = 'enforceable'").groupBy(F.col("source").alias(of)).agg(F.collect_set("filter_key").alias(keys))
    joined = df.join(per, F.col("source") == F.col(of), "left")
    stages = [(k, ~F.coalesce(F.array_contains(keys, k), F.lit(False)) | p) for k, p in predicates.items()]
    return tagged(joined, stages).drop(of, keys)


def by_relevance(df: DataFrame, scores: DataFrame, with_maybe: bool, industry: str = "industry", order: tuple[str, ...] = ()) -> DataFrame:
    """df with ``relevance``, ``reason`` and ``kept``: relevant rows stay, maybe if asked; blank and unscored stay.

    scores: industry, score, reason; looked up exactly first, then in lower case; of several scores of an industry the last counts (see ``lookup``), of several spellings the first by name.
    """
    same, low = fresh(df.columns, "_same"), fresh(df.columns, "_low")
    once = one_row_a_key(scores, F.col("industry"), {"score": F.col("score"), "reason": F.col("reason")}, order)
    lower = once.groupBy(F.lower("key").alias("key")).agg(F.min_by("value", "key").alias("value"))
    joined = looked_up(looked_up(df, once, F.col(industry), F.col("key"), {"hit": F.col("value")}, same), lower, F.lower(industry), F.col("key"), {"hit": F.col("value")}, low)
    hit = F.coalesce(f"{same}.hit", f"{low}.hit")
    keep = F.coalesce(hit["score"].isin("relevant", *["maybe"] * with_maybe), F.lit(True)) | (X.key(F.col(industry)) == "")
    return joined.withColumns({"relevance": hit["score"], "reason": hit["reason"], "kept": keep}).drop(same, low)


# --- what still needs work


def needs_industry(force: bool = False) -> Column:
    return F.lit(force) | ~X.present(X.blank_if_null(F.col("industry")))


def needs_email(archived: bool = False) -> Column:
    bad = ("missing", "invalid", "verification_failed", *["unknown", ""] * archived)
    return ~X.present(X.blank_if_null(F.col("email"))) | X.blank_if_null(F.col("email_status")).isin(*bad)


def needs_profile(bio: str = "bio", force: bool = False) -> Column:
    return X.present(X.blank_if_null(F.col("linkedin_url"))) & (F.lit(force) | F.col(bio).isNull())


def needs_value(value: str, given: Column, force: bool = False) -> Column:
    """The given text is there and the value is not, or it is asked for again."""
    return X.present(X.blank_if_null(given)) & (F.lit(force) | ~X.present(X.blank_if_null(F.col(value))))


# --- how well a sample matches what was asked for


def match_all(df: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """rows, matched, share of rows that meet all groups; a group is met if its column holds any of its words; empty groups are met."""
    hit = reduce(lambda a, b: a & b, [X.any_contains(X.key(F.col(c)), [w.lower() for w in words]) if words else F.lit(True) for c, words in groups.items()], F.lit(True))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(hit.cast("long")), F.lit(0)).alias("matched"), F.coalesce(F.avg(hit.cast("double")), F.lit(0.0)).alias("share"))


def match_any(df: DataFrame, columns: list[str], words: list[str], least: float = 0.8, order: str = "ord", misses: int = 3) -> DataFrame:
    """rows, matched, share, passed, and the first rows that hold none of the words."""
    every = X.key(F.concat_ws(" ", *[X.blank_if_null(F.col(c)) for c in columns]))
    hit = X.any_contains(every, [w.lower() for w in words])
    missed = df.filter(~hit).orderBy(order).limit(misses).agg(F.array_join(F.array_sort(F.collect_list(F.col(order))).cast("array<string>"), ",").alias("sample"))
    total = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(hit.cast("long")).alias("matched"), F.avg(hit.cast("double")).alias("share"))
    return total.withColumn("passed", F.col("share") >= least).withColumn("_k", F.lit(1)).join(missed.withColumn("_k", F.lit(1)), "_k").drop("_k")
